"""Layout for several keys, and the high-water mark from the partitions' names."""

import glob
import hashlib
import os
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from starmart.operators.upsert import lookback_window, stored_high_water_mark, write_clustered, write_interleaved

KEYS = ["ProductKey", "SalesOrderID", "OrderDateKey"]


def _read_share(path, column, value):
    """Share of the row groups whose statistics don't leave out the value."""
    hit = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = next(c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == column)
            hit, total = hit + (stats.min <= value <= stats.max), total + 1
    return hit / total


def test_interleaved_layout_skips_for_every_key(spark, tmp_path):
    rng = random.Random(1)
    products = [hashlib.md5(str(i).encode()).hexdigest() for i in range(300)]
    rows = [(rng.choice(products), o, 20240000 + 100 * rng.randint(1, 12) + rng.randint(1, 28), o) for o in range(20_000)] + [(None, None, None, -1)]
    df = spark.createDataFrame(rows, "ProductKey string, SalesOrderID long, OrderDateKey long, v long").repartition(8)
    z, c = str(tmp_path / "z"), str(tmp_path / "c")
    write_interleaved(df, z, KEYS, files=64)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 64)
        write_clustered(df, c, KEYS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for path in (z, c):
        assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == sorted(r[3] for r in rows)
    probes = rng.sample(rows[:-1], 20)
    share = {(name, k): sum(_read_share(path, col, r[k]) for r in probes) / len(probes) for name, path in (("z", z), ("c", c)) for k, col in enumerate(KEYS)}
    # about a third of 64 files for each key (two bits of each, and ranges that don't begin on cells); by the first key alone the others stay open
    assert all(share["z", k] < 0.5 for k in range(3)) and sum(share["z", k] for k in range(3)) < 1.2, share
    assert share["c", 1] > 0.9 and share["c", 2] > 0.9, share


def test_high_water_mark_reads_the_newest_month_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert stored_high_water_mark(spark, path, "OrderMonth", "OrderDateKey") is None
    rows = [(20240000 + 100 * m + d, 202400 + m) for m in range(1, 7) for d in (1, 9)]
    spark.createDataFrame(rows, "OrderDateKey long, OrderMonth int").write.partitionBy("OrderMonth").parquet(path)
    for f in glob.glob(f"{path}/OrderMonth=20240[1-5]/*.parquet"):
        with open(f, "wb") as g:
            g.write(b"not a table")
    assert stored_high_water_mark(spark, path, "OrderMonth", "OrderDateKey") == 20240609
    # an empty newest month, and one with rows without a date, are passed over
    os.makedirs(f"{path}/OrderMonth=202408")
    spark.createDataFrame([(None,)], "OrderDateKey long").write.parquet(f"{path}/OrderMonth=202407")
    assert stored_high_water_mark(spark, path, "OrderMonth", "OrderDateKey") == 20240609

    orders = spark.createDataFrame([(1, "2024-06-01 23:00:00"), (2, "2024-06-02 00:00:00"), (3, None)], "id long, at string").select("id", F.col("at").cast("timestamp_ntz").alias("OrderDate"))
    orders.write.parquet(str(tmp_path / "o"))
    out = lookback_window(spark.read.parquet(str(tmp_path / "o")), None, "OrderDate", newest=20240609)
    assert [r["id"] for r in out.collect()] == [2]
    assert "GreaterThanOrEqual(OrderDate,2024-06-02T00:00)" in out._jdf.queryExecution().executedPlan().toString()
