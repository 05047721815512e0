"""Incremental fact maintenance: look-back window, upsert, clustered writes (O-7, O-8, O-15, O-44)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import date_from_key
from .history import latest_per_key
from .membership import add_to_summary, candidate_partitions, has_summary


def lookback_window(
    new_rows: DataFrame,
    target: DataFrame | None,
    at: str,
    target_key: str = "OrderDateKey",
    days: int = 7,
    newest: int | None = None,
) -> DataFrame:
    """Rows of ``new_rows`` whose ``at`` date is at most ``days`` before the newest date in the target.

    Date arithmetic on the parsed key (not ``key - 7``, which stops at the month start).  An empty
    or missing target means a full load; rows without a date are never in a window.  The bound is an
    uncorrelated scalar subquery (the largest key, parsed once), and the predicate compares the raw
    timestamp column, so it rejects NULLs, turns an outer join below it into an inner one and
    reaches the Parquet scan.  ``newest``: the target's largest key where it is known already
    (:func:`stored_high_water_mark`); the bound is a literal then, and the target isn't read.
    """
    if target is None and newest is None:
        return new_rows
    mark = target.agg(F.max(target_key)).scalar() if newest is None else F.lit(newest)
    bound = F.coalesce(F.date_sub(date_from_key(mark), days).cast("timestamp_ntz"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    return new_rows.filter(F.col(at) >= bound)


def stored_high_water_mark(spark, path: str, partition_col: str, column: str) -> int | None:
    """The largest value of a column that grows with the partitions (a date key in monthly partitions): the
    newest partition by the folders' names, then one aggregate over that partition alone.  Partitions without
    a value are passed over; None for an empty table."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = [f.getPath().getName().split("=", 1)[1] for f in found]
    for value in sorted((int(n) for n in names if n.isdigit()), reverse=True):
        folder = f"{path.rstrip('/')}/{partition_col}={value}"
        try:
            mark = spark.read.parquet(folder).agg(F.max(column)).first()[0]
        except AnalysisException as e:  # a folder without files
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            continue
        if mark is not None:
            return mark
    return None


def arrived_orders(new_rows: DataFrame, arrival: str, since: Column, order_key: str = "SalesOrderID") -> DataFrame:
    """All rows of the orders that have a row which arrived at or after ``since``.

    An order date says nothing about when a row arrives, so a look-back by order date loses rows that
    come later than its window; the arrival cursor loses none.  Whole orders are taken because the
    upsert replaces rows by order and product."""
    touched = new_rows.filter(F.col(arrival) >= since).select(F.col(order_key).alias("_sm_arrived")).distinct()
    return new_rows.join(touched, F.col(order_key) == F.col("_sm_arrived"), "left_semi")


class DuplicateKeyError(ValueError):
    pass


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "replace",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """New table state: target rows whose key is not in the batch, plus the batch.

    ``on_duplicate`` decides what happens when one key occurs several times in the batch:

    * ``"replace"`` (default): all batch rows of a key replace all target rows of that key
      (delete + insert), so no row is lost and re-running the same batch changes nothing;
    * ``"latest"``: keep one batch row per key, the greatest by ``order``;
    * ``"error"``: raise :class:`DuplicateKeyError` (one aggregate action over the batch).
    """
    keys = list(keys)
    if on_duplicate == "error":
        dups = batch.groupBy(*keys).count().filter(F.col("count") > 1)
        if not dups.isEmpty():
            raise DuplicateKeyError(f"batch has duplicate keys on {keys}")
    elif on_duplicate == "latest":
        if not order:
            raise ValueError("on_duplicate='latest' needs order columns")
        batch = latest_per_key(batch, keys, order[0], list(order[1:]) or None)
    elif on_duplicate != "replace":
        raise ValueError("on_duplicate must be 'replace', 'latest' or 'error'")
    touched = batch.select(*keys).distinct()
    kept = target.join(touched, keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def month_partition(col: str) -> Column:
    """Partition column (first day of the month) used to bound upsert rewrites."""
    return F.date_trunc("month", F.col(col)).cast("date")


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write range-clustered by ``cluster_by`` so Parquet min/max statistics skip row groups on
    those keys (the Parquet counterpart of a clustered table)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    out = df.repartitionByRange(parts, *partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _rank_number(df: DataFrame, column: str) -> Column:
    """A double that orders rows as the column does (strings by their first six bytes)."""
    if isinstance(df.schema[column].dataType, T.StringType):
        head = F.rpad(F.substring(F.hex(F.encode(column, "UTF-8")), 1, 12), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def _quantiles(df: DataFrame, columns: Sequence[str], bits: int) -> list[list[float]]:
    n = 1 << bits
    shares = [i / n for i in range(1, n)]
    row = df.agg(*[F.percentile_approx(_rank_number(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [row[i] or [] for i in range(len(columns))]


def _interleaved(ranks: Sequence[Column], quantiles: Sequence[list[float]], bits: int) -> Column:
    """The sum over the columns of a search tree that has, for each cell, its bits at their places."""

    def search(x: Column, cuts: list[float], places: list[int]) -> Column:
        if not cuts:
            return F.lit(places[0]).cast("bigint")
        half = len(cuts) // 2
        above = search(x, cuts[half + 1 :], places[half + 1 :])
        return F.when(F.lit(float(cuts[half])) <= x, above).otherwise(search(x, cuts[:half], places[: half + 1]))

    z = F.lit(0).cast("bigint")
    for i, (x, cuts) in enumerate(zip(ranks, quantiles, strict=True)):
        places = [sum((cell >> b & 1) << (b * len(ranks) + i) for b in range(bits)) for cell in range(len(cuts) + 1)]
        z = z + search(x, cuts, places)
    return z


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """A number whose neighbours are near each other in every one of the columns: each column's rank, as
    ``bits`` bits of its quantiles, with the bits of all columns taken in turn.  NULLs come first.

    The quantiles of all columns are one aggregate, 2 ** ``bits`` - 1 numbers for each on the driver."""
    return _interleaved([_rank_number(df, c) for c in columns], _quantiles(df, columns, bits), bits)


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6, mode: str = "overwrite") -> None:
    """Write in the interleaved order of several keys, so that the Parquet statistics of files and row groups
    leave out most of them for a predicate on any one of the keys.  (Under :func:`write_clustered` only the
    first key's ranges are narrow.)"""
    z, ranks = "_sm_z", [f"_sm_x{i}" for i in range(len(columns))]
    out = df.withColumns({x: _rank_number(df, c) for x, c in zip(ranks, columns, strict=True)})
    out = out.withColumn(z, _interleaved([F.col(x) for x in ranks], _quantiles(df, columns, bits), bits)).drop(*ranks)
    out.repartitionByRange(files, z).sortWithinPartitions(z).drop(z).write.mode(mode).parquet(path)


def upsert_to_path(
    spark,
    target_path: str,
    batch: DataFrame,
    keys: Sequence[str],
    new_path: str,
    partition_col: str | None = None,
    on_duplicate: str = "replace",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert into a Parquet table, copy-on-write: the whole new state goes to ``new_path`` (never the
    path being read).  :func:`upsert_partitions` rewrites the touched partitions only."""
    target = spark.read.parquet(target_path)
    state = upsert(target, batch, keys, on_duplicate, order)
    if partition_col is None:
        state.write.mode("overwrite").parquet(new_path)
    else:
        state.write.mode("overwrite").partitionBy(partition_col).parquet(new_path)
    return spark.read.parquet(new_path)


def upsert_partitions(
    spark,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    on_duplicate: str = "replace",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert into a partitioned Parquet table in place, rewriting touched partitions only.

    Touched are the partitions of the batch and those that hold rows with the batch's keys, so a row
    that moves to another partition leaves its old one; where the table has a key summary
    (:mod:`membership`) only partitions that it names are searched for them.  Their new state takes their place by
    dynamic partition overwrite, written once; a partition that ends up empty is deleted.  All
    other partitions keep their files.  The partition values of one batch (months) are few and are
    the only thing that reaches the driver."""
    from ..session import materialize

    batch = materialize(batch, "upsert_batch")
    if has_summary(spark, path):
        target = spark.read.schema(batch.schema).parquet(path)
        target = target.filter(F.col(partition_col).isin(candidate_partitions(spark, path, batch, keys, partition_col)))
    else:
        target = spark.read.parquet(path)
        if not target.columns:
            raise ValueError(f"no table at {path}")
    moved = target.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(partition_col)
    touched = [r[0] for r in batch.select(partition_col).union(moved).distinct().collect()]
    state = spark.read.schema(batch.schema).parquet(path).filter(F.col(partition_col).isin(touched))
    state = upsert(state, batch.select(*state.columns), keys, on_duplicate, order)
    return swap_partitions(spark, path, state, partition_col, touched, keys, batch)


def _files_by_partition(spark, path: str, partition_col: str) -> dict[str, set[str]]:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}=*/[!_.]*")
    found: dict[str, set[str]] = {}
    for f in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        found.setdefault(f.getPath().getParent().getName(), set()).add(f.getPath().getName())
    return found


def swap_partitions(spark, path: str, state: DataFrame, partition_col: str, touched: Sequence, keys: Sequence[str], added: DataFrame) -> DataFrame:
    """Puts ``state`` in the place of the ``touched`` partitions of a Parquet table and returns the table.

    The state, which may read the table, is written once: Spark keeps the new files apart until all are there,
    then moves them in for the old ones.  A touched partition without rows keeps its old files there and is
    deleted.  These are two steps: in between a reader can see a row that moved to another partition twice.
    ``added``: the rows of ``state`` that are not in the table, whose keys its summary gets."""
    if has_summary(spark, path):
        add_to_summary(added, path, keys, partition_col, touched)
    before = _files_by_partition(spark, path, partition_col)
    writer = state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    writer.parquet(path)
    after = _files_by_partition(spark, path, partition_col)
    for value in set(touched):
        name = f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
        if name in before and before[name] & after.get(name, set()):
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.parquet(path)
