"""Readers and writers (O-2, O-3, O-5, O-6, O-9).

Incremental extraction is a predicate on the cursor column written against the raw column, so it
reaches the Parquet row-group statistics or, for JDBC, the database's WHERE clause.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def cursor_increment(df: DataFrame, cursor: str, high_water_mark: Column | None) -> DataFrame:
    """Rows strictly past the last-seen cursor value (all rows when there is no mark yet)."""
    if high_water_mark is None:
        return df
    return df.filter(F.col(cursor) > high_water_mark)


def next_high_water_mark(increment: DataFrame, cursor: str, previous: Column | None = None) -> DataFrame:
    """One-row frame with the cursor value to store for the next run (aggregate, no collect)."""
    new = F.max(F.col(cursor))
    if previous is not None:
        new = F.greatest(new, previous)
    return increment.agg(new.alias("high_water_mark"))


def read_jdbc_increment(
    spark: SparkSession,
    url: str,
    table: str,
    cursor: str,
    high_water_mark: str | None,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Incremental read of a relational source: the cursor predicate goes into the database query,
    the read is split into ``num_partitions`` parallel range scans of ``partition_column``."""
    where = f" WHERE {cursor} > '{high_water_mark}'" if high_water_mark is not None else ""
    query = f"(SELECT * FROM {table}{where}) AS src"
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", query)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower_bound))
        .option("upperBound", str(upper_bound))
        .option("numPartitions", str(num_partitions))
    )
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def raw_table_path(base: str, source_schema: str, table: str) -> str:
    """Destination of a replicated table: ``<base>/raw_<schema>/<table>``."""
    return f"{base.rstrip('/')}/raw_{source_schema}/{table}"


def write_raw(df: DataFrame, base: str, source_schema: str, table: str, mode: str = "overwrite") -> str:
    """Staged load with namespace mapping (O-5)."""
    path = raw_table_path(base, source_schema, table)
    df.write.mode(mode).parquet(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full rebuild of a table (dimension sink, O-6)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append sink (mined rules, O-9)."""
    df.write.mode("append").parquet(path)
