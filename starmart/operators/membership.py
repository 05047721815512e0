"""Which partitions of a stored table may hold a batch's keys, without reading the table's keys (O-7).

Beside the table, under ``_keys`` (readers skip folders with a leading underscore), lies a summary per
partition: a key sets eight bits of one 64-bit word, both drawn from its hash.  Rows are (partition,
word, bits), so a partition's summary grows with its keys, by some four bytes for each, up to
``words`` rows.  A key whose bits aren't all set in a partition isn't there.  The other way round a
partition may be named for nothing, which costs reading it: with half as many words as keys about once
in fifty thousand keys.

A summary only gains bits: before a partition gets a new state, the bits of that state are added, so a
run that ends in between leaves no key without its bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

SUMMARY = "_keys"
#: Bits of a word that a key sets.
KEY_BITS = 8


def _place(keys: Sequence[str], words: Column) -> tuple[Column, Column]:
    """Word and bits of a key; a NULL is a value like others."""
    cols = [F.struct(k) for k in keys]
    mask = None
    seed = F.xxhash64(F.lit("bits"), *cols)
    for i in range(KEY_BITS):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(seed, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return F.pmod(F.xxhash64(F.lit("word"), *cols), words).alias("word"), mask.alias("bits")


def _path(path: str) -> str:
    return f"{path.rstrip('/')}/{SUMMARY}"


def has_summary(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(_path(path))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _summarised(rows: DataFrame, keys: Sequence[str], partition_col: str, words: Column) -> DataFrame:
    return rows.select(partition_col, words.alias("words"), *_place(keys, words)).groupBy(partition_col, "words", "word").agg(F.bit_or("bits").alias("bits"))


def write_summary(rows: DataFrame, path: str, keys: Sequence[str], partition_col: str, words: int | None = None) -> None:
    """The summary of a table's rows; ``words``: by default half as many as the largest partition has rows."""
    if words is None:
        words = max(64, (rows.groupBy(partition_col).count().agg(F.max("count")).first()[0] or 0) // 2)
    out = _summarised(rows, keys, partition_col, F.lit(words).cast("bigint"))
    out.repartition(partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(_path(path))


def add_to_summary(rows: DataFrame, path: str, keys: Sequence[str], partition_col: str, touched: Sequence) -> None:
    """Adds the bits of ``rows``, which lie in the ``touched`` partitions; the summaries of others keep their files."""
    spark = rows.sparkSession
    now = spark.read.parquet(_path(path))
    words = now.select("words").first()
    if words is None:
        return write_summary(rows, path, keys, partition_col)
    now = now.filter(F.col(partition_col).isin(list(touched))).select(partition_col, "words", "word", "bits")
    both = now.unionByName(_summarised(rows, keys, partition_col, F.lit(words[0]).cast("bigint")))
    both = materialize(both.groupBy(partition_col, "words", "word").agg(F.bit_or("bits").alias("bits")), "key_summary")
    both.repartition(partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(_path(path))


def candidate_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_col: str) -> list:
    """The partitions that may hold one of the batch's keys; a few months reach the driver."""
    now = spark.read.parquet(_path(path))
    words = now.select("words").first()
    if words is None:
        return []
    wanted = batch.select(*keys).distinct().select(*_place(keys, F.lit(words[0]).cast("bigint"))).withColumnRenamed("bits", "asked").distinct()
    hits = now.join(wanted, "word").filter(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked"))
    return [r[0] for r in hits.select(partition_col).distinct().collect()]
