"""A stored SCD-2 table that merges in place of being rebuilt (O-35).

Layout under ``path``:

* ``data/<version>-<run>/open/bucket=<b>/``: open versions, one folder for each bucket of keys;
* ``data/<version>-<run>/closed/month=<yyyymm>/``: closed versions by the month in which they end;
* ``manifest/<version>.json``: which folder is the current one of each bucket, which folders make up
  each month, and the batches merged so far.

A merge reads the open versions of the buckets that its batch touches and nothing else: with the
timestamp strategy a closed version never changes, it only gains neighbours.  It writes the buckets
in which a version was opened and the months in which one was closed, each to a folder of its own,
and then the next manifest, which is the commit: readers follow the newest manifest, files that none
names are leftovers of a merge that didn't end.  A manifest that exists already means that another
merge was faster (:class:`ConcurrentMergeError`).  Merging a batch again changes nothing, by its name
if it has one, and else because none of its rows is newer than the open versions.

What reaches the driver is the manifest: buckets, months and folder names, no keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .history import GRAIN_COL, VALID_FROM, VALID_TO, open_end, scd2_merge


class ConcurrentMergeError(RuntimeError):
    pass


@dataclass
class Manifest:
    version: int
    buckets: int
    schema: str
    open: dict[str, str] = field(default_factory=dict)
    closed: dict[str, list[str]] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)


class Scd2Store:
    """One stored table.  ``key``, ``ts``, ``hash_cols`` and ``tiebreak`` as in :func:`scd2_merge`."""

    def __init__(self, spark: SparkSession, path: str, key: str, ts: str, hash_cols: Sequence[str], tiebreak: Sequence[str] | str | None = None, buckets: int = 16):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.ts, self.hash_cols, self.tiebreak, self.buckets = key, ts, list(hash_cols), tiebreak, buckets

    # --- manifest ---------------------------------------------------------------------------

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def manifest(self) -> Manifest | None:
        """The newest one, by its number."""
        fs, folder = self._hadoop(f"{self.path}/manifest")
        if not fs.exists(folder):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
        if not versions:
            return None
        text = self.spark.read.text(f"{self.path}/manifest/{max(versions)}.json", wholetext=True).first()[0]
        return Manifest(**json.loads(text))

    def _commit(self, m: Manifest) -> None:
        fs, draft = self._hadoop(f"{self.path}/manifest/_{m.version}-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(m.__dict__, sort_keys=True).encode()))
        out.close()
        _, final = self._hadoop(f"{self.path}/manifest/{m.version}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise ConcurrentMergeError(f"version {m.version} was committed by another merge")

    # --- reading ----------------------------------------------------------------------------

    def _folders(self, m: Manifest, folders: Sequence[str], columns: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], m.schema).select(*columns)
        return self.spark.read.schema(m.schema).parquet(*[f"{self.path}/{f}" for f in folders]).select(*columns)

    def _columns(self, m: Manifest) -> list[str]:
        return self.spark.createDataFrame([], m.schema).columns

    def open_versions(self, m: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        wanted = [f for b, f in m.open.items() if buckets is None or int(b) in set(buckets)]
        return self._folders(m, wanted, self._columns(m))

    def read(self, since: int | None = None) -> DataFrame:
        """All versions or, with ``since`` (yyyymm), those that are open or end in that month or later; other months aren't read."""
        m = self.manifest()
        if m is None:
            raise ValueError(f"no table at {self.path}")
        months = [f for month, fs in sorted(m.closed.items()) if since is None or int(month) >= since for f in fs]
        return self.open_versions(m).unionByName(self._folders(m, months, self._columns(m)))

    # --- merging ----------------------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def merge(self, batch: DataFrame, batch_id: str | None = None) -> Manifest:
        """Merges a batch of raw versions; those that aren't newer than their key's open version are left out."""
        m = self.manifest()
        if m is not None and batch_id is not None and batch_id in m.batches:
            return m
        raw = [c for c in batch.columns if c not in (GRAIN_COL, VALID_FROM, VALID_TO)]
        batch = materialize(batch.select(*raw), "scd2_batch")
        if m is None:
            fields = [*batch.schema.fields, *batch.select(F.lit("").alias(GRAIN_COL), F.col(self.ts).alias(VALID_FROM), open_end().alias(VALID_TO)).schema.fields]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            m = Manifest(0, self.buckets, columns)
        elif m.buckets != self.buckets:
            raise ValueError(f"the table has {m.buckets} buckets")
        touched = [r[0] for r in batch.select(self.bucket()).distinct().collect()]
        before = self.open_versions(m, touched)
        # A row's number of the batch tells a version that was opened now from one that was stored.
        marked = scd2_merge(before.withColumn("_sm_new", F.lit(False)), batch.withColumn("_sm_new", F.lit(True)), self.key, self.ts, self.hash_cols, self.tiebreak)
        closes = F.col(VALID_TO) != open_end()
        month = F.when(closes, F.date_format(VALID_TO, "yyyyMM").cast("int"))
        state = materialize(marked.select("*", self.bucket().alias("bucket"), month.alias("month")), "scd2_state")

        changed = state.groupBy("bucket", "month").agg(F.max("_sm_new").alias("new")).filter(F.col("new") | F.col("month").isNotNull()).collect()
        buckets = sorted({r["bucket"] for r in changed})
        months = sorted({r["month"] for r in changed if r["month"] is not None})
        if not buckets and batch_id is None:
            return m
        nxt = Manifest(m.version + 1, self.buckets, m.schema, dict(m.open), {k: list(v) for k, v in m.closed.items()}, [*m.batches, *([batch_id] if batch_id else [])])
        folder, columns = f"data/{nxt.version}-{uuid.uuid4().hex[:12]}", self._columns(m)
        if buckets:
            rows = state.filter(F.col("month").isNull() & F.col("bucket").isin(buckets)).select(*columns, "bucket")
            rows.repartition(len(buckets), "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}/open")
            nxt.open |= {str(b): f"{folder}/open/bucket={b}" for b in buckets}
        if months:
            rows = state.filter(F.col("month").isNotNull()).select(*columns, "month")
            rows.repartitionByRange(len(months), "month", self.key).write.partitionBy("month").parquet(f"{self.path}/{folder}/closed")
            for x in months:
                nxt.closed.setdefault(str(x), []).append(f"{folder}/closed/month={x}")
        self._commit(nxt)
        return nxt
