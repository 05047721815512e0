"""Ordered-per-key helpers that stay balanced when one key holds a large share of the rows.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task.  So each helper first
asks for the *hot* keys (more than ``HOT_KEY_ROWS`` rows: one partial aggregate over the key columns
alone, :func:`hot_keys`).  Usually there are none, and the work is one plain window: one exchange,
and consecutive helpers over the same key and order share it.

If there are hot keys, their rows (only theirs) are range-partitioned by (key, order columns) and
written once with the number of their range, their *chunk*.  Ranges hold about equally many rows
whatever the type of the order columns, NULLs included, and because they are read back from files
every branch of a plan and every repeated task sees the same chunks.  Work inside a chunk is a
window on (chunk, key); what crosses a chunk boundary comes from an edge table with one row per
hot key and chunk, shifted by a small window over the chunks of a key and joined back.

Callers that make several passes over one table ask once and hand the answer on as ``hot``.

All helpers need a *total* order within a key (add a tiebreak column) for deterministic results.
NULLs of an order column come first, as in a window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_sm_chunk"
KEY = "_sm_key"

# Keys with more rows than this are split into chunks.
HOT_KEY_ROWS = 1_000_000
# Rows of a chunk, on average.
CHUNK_ROWS = 250_000


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def _key(keys: Sequence[str]) -> Column:
    """The key as one struct: NULL fields compare equal inside it."""
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_cols(keys))]) if keys else F.struct(F.lit(0).alias("k0"))


class HotKeys:
    """The keys of a table with more than ``limit`` rows: ``table`` (column ``KEY``, written) or None."""

    def __init__(self, table: DataFrame | None, rows: int):
        self.table, self.rows = table, rows

    def __bool__(self) -> bool:
        return self.table is not None


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> HotKeys:
    """Count the rows per key (reads the key columns only) and keep the keys above ``limit``.

    Their number is at most rows / limit, so the table is small."""
    from ..session import materialize

    limit = HOT_KEY_ROWS if limit is None else limit
    counts = df.select(_key(keys).alias(KEY)).groupBy(KEY).agg(F.count(F.lit(1)).alias("_sm_cnt"))
    table = materialize(counts.filter(F.col("_sm_cnt") > F.lit(limit)), "hot_keys")
    rows = table.agg(F.sum("_sm_cnt")).first()[0]
    return HotKeys(table.select(KEY), rows) if rows else HotKeys(None, 0)


def _apply(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot: HotKeys | None,
    hot_rows: int | None,
    cold: Callable[[DataFrame], DataFrame],
    split: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``cold`` on the rows of ordinary keys, ``split`` on the written, chunked rows of hot keys."""
    from ..session import materialize

    hot = hot if hot is not None else hot_keys(df, keys, hot_rows)
    if not hot:
        return cold(df)
    d = df.withColumn(KEY, _key(keys))
    chunks = max(2, -(-hot.rows // (CHUNK_ROWS if hot_rows is None else max(1, hot_rows))))
    mine = d.join(hot.table, KEY, "left_semi")
    mine = mine.repartitionByRange(int(chunks), F.col(KEY), *_cols(order)).withColumn(CHUNK, F.spark_partition_id())
    done = split(materialize(mine, "hot_rows")).drop(CHUNK, KEY)
    rest = cold(d.join(hot.table, KEY, "left_anti").drop(KEY))
    return rest.unionByName(done)


def _inside(order: Sequence[str]) -> Window:
    return Window.partitionBy(CHUNK, KEY).orderBy(*_cols(order))


def _with_edges(rows: DataFrame, edges: DataFrame) -> DataFrame:
    return rows.join(edges, [CHUNK, KEY], "left")


def with_neighbors(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    prev: str | None = None,
    next: str | None = None,
    hot: HotKeys | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``prev`` / ``next`` = struct(values) of the previous / next row of the same key.

    NULL for the first (last) row of a key.  Equivalent to ``lag``/``lead`` over
    ``Window.partitionBy(keys).orderBy(order)`` without putting a whole hot key into one task.
    """
    if not prev and not next:
        raise ValueError("ask for prev and/or next")
    payload = F.struct(*_cols(values))

    def cold(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
        found = {out: fn(payload).over(w) for out, fn in ((prev, F.lag), (next, F.lead)) if out}
        return d.select("*", *[c.alias(out) for out, c in found.items()])

    def split(d: DataFrame) -> DataFrame:
        ordering, w, wc = F.struct(*_cols(order)), _inside(order), Window.partitionBy(KEY).orderBy(CHUNK)
        d = d.select("*", F.lag(payload).over(w).alias("_sm_in_p"), F.lead(payload).over(w).alias("_sm_in_n"))
        edges = d.groupBy(CHUNK, KEY).agg(F.max_by(payload, ordering).alias("_sm_last"), F.min_by(payload, ordering).alias("_sm_first"))
        edges = edges.select(CHUNK, KEY, F.lag("_sm_last").over(wc).alias("_sm_carry_p"), F.lead("_sm_first").over(wc).alias("_sm_carry_n"))
        d = _with_edges(d, edges)
        outs = [F.coalesce(f"_sm_in_{k}", f"_sm_carry_{k}").alias(out) for k, out in (("p", prev), ("n", next)) if out]
        return d.select(*df.columns, CHUNK, KEY, *outs)

    return _apply(df, keys, order, hot, hot_rows, cold, split)


def with_neighbor(df, keys, order, values, out, direction="prev", hot=None, hot_rows=None) -> DataFrame:
    """One-sided :func:`with_neighbors`."""
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    return with_neighbors(df, keys, order, values, **{direction: out}, hot=hot, hot_rows=hot_rows)


def with_forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    hot: HotKeys | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``out`` = last non-NULL ``value`` at or before each row within its key.

    Wrap several attributes in one struct column first, or a NULL attribute would be filled from
    an older row.
    """
    v = F.col(value)

    def cold(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return d.withColumn(out, F.last(v, ignorenulls=True).over(w))

    def split(d: DataFrame) -> DataFrame:
        so_far = _inside(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn("_sm_in", F.last(v, ignorenulls=True).over(so_far))
        edges = d.groupBy(CHUNK, KEY).agg(F.max_by(v, F.when(v.isNotNull(), F.struct(*_cols(order)))).alias("_sm_edge"))
        before = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        d = _with_edges(d, edges.select(CHUNK, KEY, F.last("_sm_edge", ignorenulls=True).over(before).alias("_sm_carry")))
        return d.select(*df.columns, CHUNK, KEY, F.coalesce("_sm_in", "_sm_carry").alias(out))

    return _apply(df, keys, order, hot, hot_rows, cold, split)


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, hot: HotKeys | None = None,
                  hot_rows: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of the row within its key in ``order`` (= row_number - 1)."""

    def cold(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
        return d.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))

    def split(d: DataFrame) -> DataFrame:
        d = d.withColumn("_sm_rn", F.row_number().over(_inside(order)))
        counts = d.groupBy(CHUNK, KEY).agg(F.count(F.lit(1)).alias("_sm_n"))
        before = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        d = _with_edges(d, counts.select(CHUNK, KEY, F.coalesce(F.sum("_sm_n").over(before), F.lit(0)).alias("_sm_off")))
        return d.select(*df.columns, CHUNK, KEY, (F.col("_sm_off") + F.col("_sm_rn") - 1).cast("bigint").alias(out))

    return _apply(df, keys, order, hot, hot_rows, cold, split)


def dense_ids(df: DataFrame, order: Sequence[str], id_col: str, chunks: int | None = None) -> DataFrame:
    """Distinct values of ``order`` numbered 1..n in sort order (= ``dense_rank``).

    One path for any number of values: they are range-partitioned and written once with the number
    of their range, numbered inside each range, and shifted by the row counts of the earlier ranges
    (one row per range).  Rows and counts are read from the same files, so the ranges agree whatever
    Spark reuses, and no task sees more than a range."""
    from ..session import materialize

    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    d = df.select(*order).distinct().repartitionByRange(n, *_cols(order)).withColumn(CHUNK, F.spark_partition_id())
    d = materialize(d, "dense_ids")
    r = d.withColumn("_sm_rn", F.row_number().over(Window.partitionBy(CHUNK).orderBy(*_cols(order))))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = d.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_sm_n"))
    offsets = offsets.select(CHUNK, F.coalesce(F.sum("_sm_n").over(before), F.lit(0)).alias("_sm_off"))
    return r.join(F.broadcast(offsets), CHUNK).select(*order, (F.col("_sm_off") + F.col("_sm_rn")).cast("bigint").alias(id_col))
