"""Incremental ingest as a Structured Streaming job (O-43).

A file source picks up new Parquet files of a replicated table (the file source's own log plays
the role of the sync cursor), ``trigger(availableNow=True)`` processes everything that has
arrived and stops, and ``foreachBatch`` merges each micro-batch into a latest-per-key state table.

The state is a Parquet table partitioned by key bucket and micro-batch id.  A batch reads the newest
earlier version of the buckets that it touches, merges, and writes a new version of these buckets
only.  A replayed batch (after a failure before the checkpoint commit) starts from the same earlier
versions and overwrites its own, so the result stays exactly-once.  Of each bucket the newest
version and the one before it (which a replay needs) are kept, older ones are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import latest_per_key

EPOCH, BUCKET = "_epoch", "_bucket"
BUCKETS = 64
#: Bytes of state that a bucket should hold: small enough to rewrite, large enough for files of a good size.
BUCKET_BYTES = 128 << 20


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def buckets_for(spark: SparkSession, path: str) -> int:
    """Buckets for a state of about the size of the files under ``path``."""
    fs, folder = _hadoop(spark, path)
    return max(1, -(-fs.getContentSummary(folder).getLength() // BUCKET_BYTES)) if fs.exists(folder) else 1


def _versions(spark: SparkSession, root: str) -> dict[int, list[int]]:
    """The versions of each bucket, oldest first, by listing the folders; no state row is read."""
    fs, pattern = _hadoop(spark, f"{root}/{BUCKET}=*/{EPOCH}=*")
    found: dict[int, list[int]] = {}
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        bucket, epoch = (int(x.getName().split("=")[1]) for x in (folder.getParent(), folder))
        found.setdefault(bucket, []).append(epoch)
    return {b: sorted(e) for b, e in found.items()}


def _read(spark: SparkSession, root: str, versions: dict[int, int]) -> DataFrame:
    folders = [f"{root}/{BUCKET}={b}/{EPOCH}={e}" for b, e in sorted(versions.items())]
    return spark.read.option("basePath", root).parquet(*folders)


def read_state(spark: SparkSession, state_root: str) -> DataFrame:
    """Newest version of each bucket."""
    root = state_root.rstrip("/")
    return _read(spark, root, {b: e[-1] for b, e in _versions(spark, root).items()}).drop(BUCKET, EPOCH)


def merge_batch(batch: DataFrame, epoch_id: int, key: str, cursor: str, tiebreak: str | None, state_root: str, buckets: int = BUCKETS) -> None:
    """Merge one micro-batch into the touched buckets of the state and drop versions that no replay needs.

    A state keeps the number of buckets that it began with."""
    from ..session import materialize

    spark, root = batch.sparkSession, state_root.rstrip("/")
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    combined = materialize(latest_per_key(batch, key, cursor, tiebreak).withColumn(BUCKET, bucket), "stream_batch")
    touched = [r[0] for r in combined.select(BUCKET).distinct().collect()]
    if not touched:
        return
    earlier = {b: [e for e in epochs if e < epoch_id] for b, epochs in _versions(spark, root).items() if b in touched}
    newest = {b: epochs[-1] for b, epochs in earlier.items() if epochs}
    if newest:
        combined = combined.unionByName(_read(spark, root, newest).drop(EPOCH))
    merged = latest_per_key(combined, [BUCKET, key], cursor, tiebreak).withColumn(EPOCH, F.lit(epoch_id))
    writer = merged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, EPOCH)
    writer.parquet(root)
    for b, epochs in earlier.items():
        for e in epochs[:-1]:
            fs, folder = _hadoop(spark, f"{root}/{BUCKET}={b}/{EPOCH}={e}")
            fs.delete(folder, True)


def ingest_latest_per_key(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    key: str,
    cursor: str,
    tiebreak: str | None,
    state_root: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Run the ingest stream to completion and return the resulting state table."""
    stream = spark.readStream.schema(schema)
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", str(max_files_per_trigger))
    source = stream.parquet(source_path)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        merge_batch(batch, epoch_id, key, cursor, tiebreak, state_root, buckets)

    query = (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_state(spark, state_root)
