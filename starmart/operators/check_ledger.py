"""Checks of a stored, partitioned table that read changed partitions only (O-52).

A row-local check's failures add up over partitions.  A ledger beside the table keeps, per partition
and check, the number of failures together with a fingerprint of the partition's files (names, sizes,
times) and of the check itself.  A run reads the partitions whose files have changed, all their checks
in one aggregate, and a new or changed check reads all; the summary is the sum over the ledger.

The ledger is a small Parquet table in numbered versions; a version counts once its ``_SUCCESS`` file
is there, so a run that ends halfway leaves the one before.  Partitions that are gone leave the ledger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import LOCAL_KINDS, CheckSpec, fails

LEDGER = "part string, fingerprint string, check_name string, definition string, n_failed long"


def _list(spark: SparkSession, pattern: str) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or [])


def partition_fingerprints(spark: SparkSession, path: str, partition_col: str) -> dict[str, str]:
    """Partition folder -> digest of its files' names, sizes and times (one listing)."""
    files: dict[str, list[str]] = {s.getPath().getName(): [] for s in _list(spark, f"{path.rstrip('/')}/{partition_col}=*")}
    for s in _list(spark, f"{path.rstrip('/')}/{partition_col}=*/[!_.]*"):
        files[s.getPath().getParent().getName()].append(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}")
    return {part: hashlib.md5("|".join(sorted(names)).encode()).hexdigest() for part, names in files.items()}


def _definition(spec: CheckSpec) -> str:
    return hashlib.md5(repr((spec.kind, spec.column, sorted(spec.args.items()))).encode()).hexdigest()


def _newest(spark: SparkSession, ledger: str) -> int:
    return max((int(s.getPath().getParent().getName()[1:]) for s in _list(spark, f"{ledger.rstrip('/')}/v*/_SUCCESS")), default=0)


def run_changed(spark: SparkSession, path: str, partition_col: str, specs: Sequence[CheckSpec], ledger: str) -> DataFrame:
    """One row per check, as :func:`checks.run_suite` gives it, from the ledger brought up to date."""
    other = [s.name for s in specs if s.kind not in LOCAL_KINDS]
    if other:
        raise ValueError(f"only row-local checks add up over partitions: {other}")
    now, version = partition_fingerprints(spark, path, partition_col), _newest(spark, ledger)
    have = spark.read.schema(LEDGER).parquet(f"{ledger}/v{version}") if version else spark.createDataFrame([], LEDGER)
    # Months times checks: a few thousand rows.
    known = {(r["part"], r["check_name"]): r for r in have.collect()}
    definitions = {s.name: _definition(s) for s in specs}

    def current(part: str, name: str) -> bool:
        r = known.get((part, name))
        return r is not None and r["fingerprint"] == now[part] and r["definition"] == definitions[name]

    changed = sorted(part for part in now if not all(current(part, s.name) for s in specs))
    counts = {}
    if changed:
        rows = spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{part}" for part in changed])
        failed = [F.count_if(fails(s)).cast("bigint").alias(f"_sm_c{i}") for i, s in enumerate(specs)]
        for r in rows.groupBy(F.concat(F.lit(f"{partition_col}="), F.col(partition_col).cast("string")).alias("part")).agg(*failed).collect():
            counts |= {(r["part"], s.name): r[f"_sm_c{i}"] for i, s in enumerate(specs)}
    redone = set(changed)
    state = [(part, now[part], s.name, definitions[s.name], counts.get((part, s.name), 0) if part in redone else known[part, s.name]["n_failed"]) for part in now for s in specs]
    # Checks that this run does not ask for stay, as long as their partition is as it was.
    state += [tuple(r) for (part, name), r in known.items() if name not in definitions and now.get(part) == r["fingerprint"]]
    if changed or len(state) != len(known):
        spark.createDataFrame(state, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/v{version + 1}")
    total = {s.name: sum(x[4] for x in state if x[2] == s.name) for s in specs}
    return spark.createDataFrame([(s.name, s.table, s.kind, total[s.name]) for s in specs], "check_name string, table_name string, kind string, n_failed long")
