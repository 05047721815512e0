"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session

#: Word separators used everywhere here: blank, tab, newline, vertical tab, form feed, carriage return.
SEPARATORS = "\\x20\\x09-\\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; every path goes through Spark's readers, so any store that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus


def word_array(text: Column) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SEPARATORS}]+"), lambda w: w != "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as ``df`` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` (a written table of ids or hashes) marked for broadcast if it has at most ``rows`` rows;
    a larger one is left to a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def written_in_buckets(df: DataFrame, name: str, buckets: int, key: str) -> DataFrame:
    """``df`` as a table in the shared folder, in buckets by ``key``: joins on it move their other side only."""
    spark, name = df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}"
    path = session.scratch_path(spark, f"tables/{name}")
    session._WRITTEN.append((spark.sparkContext.applicationId, path))
    df.write.bucketBy(buckets, key).sortBy(key).option("compression", "zstd").option("path", path).saveAsTable(name)
    return spark.table(name)
