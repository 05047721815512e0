"""Session helpers.

The library never creates a session on its own inside an operator; these helpers are for
scripts, tests and the bench.  Cluster settings (shuffle partitions, checkpoint dir, memory)
belong to whoever launches the job, so every helper only fills in what is still unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starmart") -> SparkSession:
    """A local-mode session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it.  Where it is unset
    (local tests) a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local"):
            configured = tempfile.mkdtemp(prefix="starmart-ckpt-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


# (application, path) of the intermediate tables written so far.
_WRITTEN: list[tuple[str, str]] = []


#: Rows of a file, about, where it is known how many rows a table to be written gets at most.
FILE_ROWS = 20_000


def few_files(df, rows: int):
    """``df`` in a partition for each :data:`FILE_ROWS` rows, but one for each core at least; more than it has it does not get.

    For tables to be written of which it is known about how many rows come at most: a small one is then
    written by a task for each core, not by one for each shuffle partition (on a local store every file
    makes the executor start two processes that set modes).  Only where the last stage reads about as few rows."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    Used where the reference keeps a table (snapshots, dimensions, the miner's input) and where a
    multi-pass algorithm reads its input several times: the upstream plan runs once, lineage is
    cut (a lost executor re-reads the files instead of recomputing the pipeline), and later scans
    get column pruning and filter pushdown."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    _WRITTEN.append((spark.sparkContext.applicationId, path))
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release_scratch(spark) -> int:
    """Delete the intermediate tables that this application has written so far and return their number.

    Call it when a run's results are stored; results are lazy, so their inputs must stay until then.
    Tables that are kept for later runs of the session (the part ids) are written again when needed."""
    from .sources import catalog

    mine = [p for app, p in _WRITTEN if app == spark.sparkContext.applicationId]
    for path in mine:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _WRITTEN[:] = [(app, p) for app, p in _WRITTEN if app != spark.sparkContext.applicationId]
    catalog.forget_ids()
    return len(mine)


def cluster_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions are sized so one partition holds about ``partition_bytes`` (at least two
    waves of the cluster's cores); AQE coalesces small ones and splits skewed join partitions; the
    runtime broadcast threshold bounds every broadcast by measured size.  Apply with
    ``SparkSession.builder.config(map=...)`` before the session starts."""
    partitions = max(2 * total_cores, -(-input_bytes // partition_bytes))
    mb = partition_bytes >> 20
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.session.timeZone": "UTC",
    }
