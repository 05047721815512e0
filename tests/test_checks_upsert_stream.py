import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starmart.operators import checks as C
from starmart.operators.history import latest_per_key
from starmart.operators.upsert import DuplicateKeyError, lookback_window, upsert
from starmart.streaming.ingest import ingest_latest_per_key


def test_checks_seeded_violations(spark):
    df = spark.createDataFrame([(1, 1.0), (1, -2.0), (None, 5.0), (None, None)], "id long, price double")
    parent = spark.createDataFrame([(2,)], "id long")
    assert C.not_null(df, "id").count() == 2
    assert [tuple(r) for r in C.unique(df, "id").collect()] == [(1, 2)]      # NULL ids not checked
    assert C.relationships(df, "id", parent, "id").count() == 2              # both id=1 rows; NULL passes
    assert [r.price for r in C.accepted_range(df, "price", min_value=0).collect()] == [-2.0]  # NULL passes
    assert C.accepted_range(df, "price", 0, 1, inclusive=False).count() == 3
    specs = [C.CheckSpec("nn", "t", "not_null", "id"), C.CheckSpec("u", "t", "unique", "id"),
             C.CheckSpec("fk", "t", "relationships", "id", args={"to": "p", "field": "id"}),
             C.CheckSpec("rng", "t", "accepted_range", "price", ("value",), {"min_value": 0})]
    summary = {r.check_name: r.n_failed for r in C.run_suite(specs, {"t": df, "p": parent}).collect()}
    assert summary == {"nn": 2, "u": 1, "fk": 2, "rng": 1}
    assert [s.name for s in C.select_checks(specs, ["value"])] == ["rng"]


def test_scd_overlaps_and_time_range(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    snap = spark.createDataFrame([(1, "a", t(1), t(5)), (1, "b", t(4), t(9))], "k long, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert C.scd_overlaps(snap, "k").count() == 1
    hist = spark.createDataFrame([(1, "a", t(2), t(4)), (1, "a", t(4), t(6))], "k long, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    bad = C.scd_time_range(hist, snap, [("k", "k"), ("name", "name")]).collect()
    assert [r.valid_from for r in bad] == [t(4)]


def _fact(spark, rows):
    return spark.createDataFrame(rows, "ProductKey string, SalesOrderID long, OrderDate timestamp_ntz, v long")


def test_lookback_window(spark):
    target = spark.createDataFrame([(20010803,), (20010101,)], "OrderDateKey long")
    new = spark.createDataFrame([(dt.datetime(2001, 7, 28),), (dt.datetime(2001, 7, 26),)], "OrderDate timestamp_ntz")
    assert [r.OrderDate.day for r in lookback_window(new, target, "OrderDate").collect()] == [28]
    empty = target.filter("false")
    assert lookback_window(new, empty, "OrderDate").count() == 2


def test_upsert_modes(spark):
    d = dt.datetime(2001, 1, 1)
    target = _fact(spark, [("p1", 1, d, 1), ("p2", 1, d, 1)])
    batch = _fact(spark, [("p1", 1, d, 2), ("p1", 1, d, 3), ("p3", 2, d, 1)])
    with pytest.raises(DuplicateKeyError):
        upsert(target, batch, ["ProductKey", "SalesOrderID"], on_duplicate="error")
    rep = upsert(target, batch, ["ProductKey", "SalesOrderID"])
    assert sorted((r.ProductKey, r.v) for r in rep.collect()) == [("p1", 2), ("p1", 3), ("p2", 1), ("p3", 1)]
    again = upsert(rep, batch, ["ProductKey", "SalesOrderID"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rep.collect()))   # idempotent
    lat = upsert(target, batch, ["ProductKey", "SalesOrderID"], on_duplicate="latest", order=["OrderDate", "v"])
    assert sorted((r.ProductKey, r.v) for r in lat.collect()) == [("p1", 3), ("p2", 1), ("p3", 1)]


def test_stream_ingest_equals_latest_per_key(spark):
    base = tempfile.mkdtemp(prefix="starmart-stream-")
    rows = [(i, dt.datetime(2024, 1, 1 + i % 20, i % 24), i % 7, f"e{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    df.withColumn("part", F.col("event_id") % 5).write.partitionBy("part").parquet(os.path.join(base, "landing"))
    state = ingest_latest_per_key(spark, os.path.join(base, "landing", "*", "*.parquet"), df.schema, "user_id", "ts", "event_id",
                                  os.path.join(base, "state"), os.path.join(base, "ckpt"), max_files_per_trigger=1)
    exp = latest_per_key(df, "user_id", "ts", "event_id")
    assert sorted(map(tuple, state.select(*df.columns).collect())) == sorted(map(tuple, exp.collect()))
    versions = spark.read.parquet(os.path.join(base, "state")).groupBy("_bucket").agg(F.countDistinct("_epoch").alias("n"))
    assert versions.agg(F.max("n")).first()[0] <= 2


def test_stream_state_replay_and_untouched_buckets(spark):
    from starmart.streaming.ingest import merge_batch, read_state

    root = os.path.join(tempfile.mkdtemp(prefix="starmart-state-"), "state")

    def batch(rows):
        return spark.createDataFrame([(k, dt.datetime(2024, 1, d), v) for k, d, v in rows], "k long, ts timestamp_ntz, v string")

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}

    def state():
        return sorted((r.k, r.ts.day, r.v) for r in read_state(spark, root).collect())

    merge_batch(batch([(k, 1, "a") for k in range(40)]), 0, "k", "ts", None, root, 8)
    before = files()
    one = [(3, 2, "b"), (3, 1, "z")]
    merge_batch(batch(one), 1, "k", "ts", None, root, 8)
    assert before < files() and len({f.split("_bucket=")[1].split("/")[0] for f in files() - before}) == 1
    want = sorted([(k, 1, "a") for k in range(40) if k != 3] + [(3, 2, "b")])
    assert state() == want
    merge_batch(batch(one), 1, "k", "ts", None, root, 8)  # the batch is replayed after a restart
    assert state() == want
    merge_batch(batch([(3, 3, "c")]), 2, "k", "ts", None, root, 8)
    assert (3, 3, "c") in state() and len(state()) == 40
    assert spark.read.parquet(root).groupBy("_bucket").agg(F.countDistinct("_epoch").alias("n")).filter("n > 2").count() == 0


def test_upsert_rewrites_touched_months_only(spark):
    from starmart.operators.upsert import upsert_partitions

    root = os.path.join(tempfile.mkdtemp(prefix="starmart-months-"), "fact")
    rows = [("p1", 1, 1, 10), ("p2", 1, 1, 11), ("p1", 2, 2, 12), ("p3", 3, 3, 13), ("p4", 4, 4, 14)]
    spark.createDataFrame(rows, "ProductKey string, SalesOrderID long, m int, v long").write.partitionBy("m").parquet(root)

    def files(m):
        return sorted(f for f in os.listdir(os.path.join(root, f"m={m}")) if f.endswith(".parquet"))

    kept = files(1), files(4)
    # one row changes, one moves from month 3 (which is empty then) to month 2
    batch = spark.createDataFrame([("p1", 2, 2, 99), ("p3", 3, 2, 98)], "ProductKey string, SalesOrderID long, m int, v long")
    for _ in range(2):  # the same batch again changes nothing
        out = upsert_partitions(spark, root, batch, ["ProductKey", "SalesOrderID"], "m")
        assert sorted((r.ProductKey, r.m, r.v) for r in out.collect()) == [("p1", 1, 10), ("p1", 2, 99), ("p2", 1, 11), ("p3", 2, 98), ("p4", 4, 14)]
    assert (files(1), files(4)) == kept and not os.path.exists(os.path.join(root, "m=3"))


def test_lookback_is_pushed_to_the_scan(spark):
    root = tempfile.mkdtemp(prefix="starmart-lookback-")
    spark.createDataFrame([(1, dt.datetime(2001, 8, 1)), (2, None), (3, dt.datetime(1999, 1, 1))], "id long, OrderDate timestamp_ntz").write.parquet(root + "/o")
    spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "oid long, v long").write.parquet(root + "/l")
    o, li = spark.read.parquet(root + "/o"), spark.read.parquet(root + "/l")
    joined = li.join(o, li.oid == o.id, "left")
    out = lookback_window(joined, spark.createDataFrame([(20010803,)], "OrderDateKey long"), "OrderDate")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and [r.id for r in out.collect()] == [1]


def test_sinks_roundtrip(spark):
    from starmart.operators.upsert import month_partition, upsert_to_path, write_clustered
    from starmart.sources.io import append_table, raw_table_path, write_raw, write_table

    base = tempfile.mkdtemp(prefix="starmart-sink-")
    d = dt.datetime(2001, 1, 1)
    df = _fact(spark, [("p1", 1, d, 1), ("p2", 2, dt.datetime(2001, 2, 3), 1)])
    path = write_raw(df, base, "Sales", "SalesOrderDetail")
    assert path == raw_table_path(base, "Sales", "SalesOrderDetail") and path.endswith("raw_Sales/SalesOrderDetail")
    write_table(df, os.path.join(base, "dim"))
    append_table(df, os.path.join(base, "rules"))
    append_table(df, os.path.join(base, "rules"))
    assert spark.read.parquet(os.path.join(base, "rules")).count() == 4
    write_clustered(df.withColumn("m", month_partition("OrderDate")), os.path.join(base, "fact"), ["ProductKey", "SalesOrderID"], ["m"])
    state = upsert_to_path(spark, os.path.join(base, "fact"), _fact(spark, [("p1", 1, d, 9)]).withColumn("m", month_partition("OrderDate")),
                           ["ProductKey", "SalesOrderID"], os.path.join(base, "fact_v2"), partition_col="m")
    assert sorted((r.ProductKey, r.v) for r in state.collect()) == [("p1", 9), ("p2", 1)]


def test_cursor_increment_and_next_mark(spark):
    from starmart.sources.io import cursor_increment, next_high_water_mark

    d = lambda n: dt.datetime(2024, 1, n)
    df = spark.createDataFrame([(1, d(1)), (2, d(5)), (3, d(9))], "id long, ts timestamp_ntz")
    inc = cursor_increment(df, "ts", F.lit(d(5)).cast("timestamp_ntz"))
    assert [r.id for r in inc.collect()] == [3]                        # strictly past the mark
    assert cursor_increment(df, "ts", None).count() == 3               # no mark yet: everything
    assert next_high_water_mark(inc, "ts").first().high_water_mark == d(9)
    empty = inc.filter("false")
    assert next_high_water_mark(empty, "ts", F.lit(d(5)).cast("timestamp_ntz")).first().high_water_mark == d(5)
