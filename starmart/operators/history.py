"""Change history: latest per key, collapse of unchanged versions, SCD type 2 build and merge
(O-4, O-32, O-34, O-35)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from .sequence import HotKeys, hot_keys, with_neighbor

# Fixed value: end of the validity interval of a current version.
OPEN_END = "9999-12-31 23:59:59"
GRAIN_COL = "_dedupe_grain_id"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def open_end():
    return F.lit(OPEN_END).cast("timestamp_ntz")


def _order(ts: str, tiebreak: Sequence[str] | str | None) -> list[str]:
    if tiebreak is None:
        return [ts]
    return [ts, tiebreak] if isinstance(tiebreak, str) else [ts, *tiebreak]


def latest_per_key(df: DataFrame, key: Sequence[str] | str, cursor: str, tiebreak: Sequence[str] | str | None = None) -> DataFrame:
    """Newest row per key by (cursor, tiebreak).

    An aggregate (``max_by`` over a struct) that combines map-side, so a hot key sends one partial row
    per task instead of all of its rows.  Spark plans it as a sort aggregate: each task sorts its own
    rows by key on either side of the exchange.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    best = F.max_by(F.struct(*cols), F.struct(*_order(cursor, tiebreak)))
    return df.groupBy(*keys).agg(best.alias("_sm_row")).select("_sm_row.*")


def dedupe_changes(
    df: DataFrame,
    key: str,
    ts: str,
    hash_cols: Sequence[str],
    tiebreak: Sequence[str] | str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Keep a row only when an attribute differs from the previous row of the same key.

    Attributes are compared as they are (null-safe, every bit of a number), not through a hash.  The
    first row of a key is always kept; A -> B -> A keeps all three.  The timestamp is not compared.
    Output: input columns + ``_dedupe_grain_id``, the published hash of the attributes.
    """
    cols = list(hash_cols)
    marked = with_neighbor(df, [key], _order(ts, tiebreak), cols, "_sm_prev", "prev", hot)
    same = F.struct(*[F.col(f"_sm_prev.`{c}`") for c in cols]).eqNullSafe(F.struct(*cols))
    kept = marked.filter(F.col("_sm_prev").isNull() | ~same).drop("_sm_prev")
    return kept.withColumn(GRAIN_COL, surrogate_key(df, cols))


def scd2_from_history(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str] | str | None = None,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Half-open validity ``[valid_from, valid_to)`` from a version history: a version is valid from
    its own timestamp until the next version's; the current one until the open end.

    Versions sharing a timestamp would be empty intervals; only the last by tiebreak is kept.
    """
    nxt = with_neighbor(df, [key], _order(ts, tiebreak), [ts], "_sm_next", "next", hot)
    out = nxt.withColumn(valid_from, F.col(ts)).withColumn(
        valid_to, F.coalesce(F.col(f"_sm_next.{ts}"), open_end())
    )
    return out.filter(F.col(valid_to) > F.col(valid_from)).drop("_sm_next")


def scd2_from_raw(df: DataFrame, key: str, ts: str, hash_cols: Sequence[str], tiebreak: Sequence[str] | str | None = None,
                  hot: HotKeys | None = None) -> DataFrame:
    """Change dedupe and validity in one go: both windows share one exchange and sort by (key, order),
    and hot keys are looked for once, on the raw rows."""
    hot = hot if hot is not None else hot_keys(df, [key])
    return scd2_from_history(dedupe_changes(df, key, ts, hash_cols, tiebreak, hot), key, ts, tiebreak, hot=hot)


def scd2_merge(
    current: DataFrame,
    batch: DataFrame,
    key: str,
    ts: str,
    hash_cols: Sequence[str],
    tiebreak: Sequence[str] | str | None = None,
    late: str = "ignore",
) -> DataFrame:
    """Merge a batch of raw versions into an SCD-2 table (timestamp strategy).

    The current version and the newer batch rows of a key are collapsed and chained again, so several
    versions per key per batch are fine and an unchanged row opens no new version; keys without
    batch rows come out as they were.  Late batch rows, not newer than the key's current version, are

    * ``late="ignore"``: left out, as the timestamp strategy does.  Merging the parts of a history in
      time order then equals :func:`scd2_from_raw` over all of it;
    * ``late="rewrite"``: put in their place: all stored versions of such a key are rebuilt with them.
      The stored table has changes only, so an unchanged sighting (A@1, A@5) that a late row falls
      before (B@3) is not known any more and A is not reopened at 5.
    """
    if late not in ("ignore", "rewrite"):
        raise ValueError("late must be 'ignore' or 'rewrite'")
    meta = {GRAIN_COL, VALID_FROM, VALID_TO}
    raw_cols = [c for c in current.columns if c not in meta]
    is_open = F.col(VALID_TO) == open_end()
    heads = current.filter(is_open).select(F.col(key).alias("_sm_k"), F.col(VALID_FROM).alias("_sm_from"))
    placed = batch.select(*raw_cols).join(heads, F.col(key).eqNullSafe(F.col("_sm_k")), "left")
    is_fresh = F.col("_sm_from").isNull() | (F.col(ts) > F.col("_sm_from"))
    closed = current.filter(~is_open)
    if late == "ignore":
        work = current.filter(is_open).select(*raw_cols).unionByName(placed.filter(is_fresh).select(*raw_cols))
    else:
        rewritten = placed.filter(~is_fresh).select(F.col(key).alias("_sm_late")).distinct()
        again = F.col(key).eqNullSafe(F.col("_sm_late"))
        reopened = closed.join(rewritten, again, "left_semi").select(*raw_cols)
        closed = closed.join(rewritten, again, "left_anti")
        work = current.filter(is_open).select(*raw_cols).unionByName(reopened).unionByName(placed.select(*raw_cols))
    rebuilt = scd2_from_raw(work, key, ts, hash_cols, tiebreak)
    return closed.unionByName(rebuilt.select(*current.columns))
