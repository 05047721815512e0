"""The stored SCD-2 table, interval differences and re-keyed facts."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators.history import scd2_from_raw
from starmart.operators.scd2_store import ConcurrentMergeError, Scd2Store
from starmart.operators.temporal import interval_difference
from starmart.plans import mart

from conftest import ts

SCHEMA = "k long, at timestamp_ntz, no long, a string, b double"


def _rows(rng, n, keys, first_day, days):
    return [(rng.choice(keys), ts("2024-01-01").replace(month=1 + (first_day + d) // 28, day=1 + (first_day + d) % 28, hour=i % 24), i, rng.choice("xyz"), rng.choice([1.0, None]))
            for i, d in enumerate(sorted(rng.randrange(days) for _ in range(n)))]


def _files(path):
    return set(glob.glob(f"{path}/data/**/*.parquet", recursive=True))


def _same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def test_stored_merge_equals_rebuild_and_rewrites_little(spark, tmp_path):
    rng, path = random.Random(1), str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    store = Scd2Store(spark, path, "k", "at", ["k", "a", "b"], "no", buckets=8)
    keys = [None, *range(40)]
    parts = [_rows(rng, 300, keys, 0, 60), _rows(rng, 200, keys, 60, 60), _rows(rng, 40, [3, 4], 120, 30)]
    with pytest.raises(ValueError):
        store.read()
    for i, rows in enumerate(parts):
        store.merge(frame(rows), f"b{i}")
    whole = scd2_from_raw(frame(sum(parts, [])), "k", "at", ["k", "a", "b"], "no")
    _same(store.read(), whole)

    files, version = _files(path), store.manifest().version
    assert store.merge(frame(parts[2]), "b2").version == version        # the same batch by its name
    assert store.merge(frame(parts[1])).version == version              # and by its rows
    assert store.merge(frame([])).version == version
    assert _files(path) == files

    # one key in one bucket: its bucket and the month in which its open version ends get a file, the others keep theirs
    before = store.manifest()
    late = ts("2024-11-05 00:00:00")
    after = store.merge(frame([(3, late, 1, "new", 2.0)]), "b3")
    new = _files(path) - files
    [bucket] = [r[0] for r in frame([(3, late, 1, "", 0.0)]).select(store.bucket()).collect()]
    assert {os.path.dirname(f).split("/")[-1] for f in new} == {f"bucket={bucket}", "month=202411"}
    assert {b: f for b, f in after.open.items() if b != str(bucket)} == {b: f for b, f in before.open.items() if b != str(bucket)}
    assert {m: f for m, f in after.closed.items() if m != "202411"} == before.closed
    _same(store.read(), scd2_from_raw(frame(sum(parts, []) + [(3, late, 1, "new", 2.0)]), "k", "at", ["k", "a", "b"], "no"))
    # readers leave out months that ended before
    recent = store.read(since=202411)
    assert recent.filter(F.col("valid_to") < F.lit("2024-11-01").cast("timestamp_ntz")).count() == 0
    assert set(recent.inputFiles()) < set(store.read().inputFiles())


def test_unfinished_and_competing_merges(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    store = Scd2Store(spark, str(tmp_path / "t"), "k", "at", ["k", "a", "b"], "no", buckets=4)
    store.merge(frame([(1, ts("2024-01-01 00:00:00"), 1, "x", 1.0)]), "first")
    seen = store.manifest()
    # files of a merge that didn't commit are not read
    frame([(9, ts("2024-01-01 00:00:00"), 1, "x", 1.0)]).write.parquet(str(tmp_path / "t/data/2-lost/open/bucket=0"))
    assert store.read().count() == 1
    # two merges that saw the same version: the second one to commit fails and leaves the table as it is
    other = Scd2Store(spark, store.path, "k", "at", ["k", "a", "b"], "no", buckets=4)
    other.manifest = lambda: seen
    store.merge(frame([(1, ts("2024-02-01 00:00:00"), 2, "y", 1.0)]), "second")
    with pytest.raises(ConcurrentMergeError):
        other.merge(frame([(1, ts("2024-03-01 00:00:00"), 3, "z", 1.0)]), "third")
    assert store.manifest().batches == ["first", "second"] and store.read().count() == 2
    with pytest.raises(ValueError):
        Scd2Store(spark, store.path, "k", "at", ["k"], buckets=5).merge(frame([(1, ts("2024-04-01 00:00:00"), 2, "y", 1.0)]))


def test_interval_difference_against_brute_force(spark):
    rng = random.Random(2)
    day = lambda d: ts("2024-01-01").replace(day=d)

    def history():
        rows = []
        for k in range(12):
            at = 1
            while at < 25 and rng.random() < 0.85:
                at += rng.choice([0, 0, 1, 3])
                end = at + rng.randint(1, 6)
                rows.append((k, rng.choice(["p", "q", None]), day(min(at, 30)), day(min(end, 31))))
                at = end
        return rows

    def at(rows, k, t):
        return next((("in", v) for kk, v, a, b in rows if kk == k and a <= t < b), None)

    for _ in range(3):
        old, new = history(), history()
        schema = "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"
        got = interval_difference(spark.createDataFrame(old + [(None, "n", day(1), day(5))], schema), spark.createDataFrame(new, schema), "k", "v").collect()
        value = lambda x: x and x[1]
        seen = {}
        for r in got:
            for d in range(r["valid_from"].day, r["valid_to"].day):
                assert (r["k"], d) not in seen
                seen[(r["k"], d)] = (r["old_value"], r["new_value"])
        want = {(k, d): (value(at(old, k, day(d))), value(at(new, k, day(d)))) for k in range(12) for d in range(1, 31)}
        assert seen == {p: v for p, v in want.items() if v[0] != v[1]}


def test_rekeyed_fact_leaves_other_months(spark, tmp_path):
    dim = "ProductID long, ProductKey string, ValidFrom timestamp_ntz, ValidTo timestamp_ntz"
    end = ts("9999-12-31 23:59:59")
    new = [(1, "1a", ts("2024-01-01"), ts("2024-03-10 12:00:00")), (1, "1b", ts("2024-03-10 12:00:00"), end), (2, "2a", ts("2024-01-01"), end), (3, "3a", ts("2024-02-01"), end), (4, "4b", ts("2024-02-15"), end)]
    old = [(1, "1a", ts("2024-01-01"), end), (2, "2a", ts("2024-01-01"), end), (4, "4a", ts("2024-01-01"), end)]
    new_dim, old_dim = spark.createDataFrame(new, dim), spark.createDataFrame(old, dim)
    terr = spark.createDataFrame([(1, 10)], "TerritoryID long, TerritoryKey long")
    lines = [(o, p, 1, ts(f"2024-{o % 5 + 1:02d}-10 {6 + o % 13:02d}:00:00"), q) for o in range(60) for p in (1, 2, 3, 4) if (o + p) % 3 for q in (1, 2)]
    sales = spark.createDataFrame(lines, "SalesOrderID long, ProductID long, TerritoryID long, OrderDate timestamp_ntz, OrderQty long")
    load = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    path = str(tmp_path / "fact")
    mart.load_fact(spark, path, sales, old_dim, terr, load_ts=load)
    months = lambda: {m: sorted(os.listdir(f"{path}/{m}")) for m in os.listdir(path) if "=" in m}
    before = months()
    got = mart.rekey_fact(spark, path, sales, old_dim, new_dim, terr, load)
    _same(got.drop(mart.FACT_PARTITION), mart.fact_sales(sales, new_dim, terr, load))
    # version 4a ends where nothing follows before 15 February, so January changes too; only what no stretch touches stays
    after = months()
    assert set(after) == set(before)
    again = mart.rekey_fact(spark, path, sales, new_dim, new_dim, terr, load)
    _same(again.drop(mart.FACT_PARTITION), mart.fact_sales(sales, new_dim, terr, load))
    assert months() == after
    # a version that only changes from May on
    last = new_dim.filter("ProductKey <> '2a'").union(spark.createDataFrame([(2, "2a", ts("2024-01-01"), ts("2024-05-01")), (2, "2b", ts("2024-05-01"), end)], dim))
    got = mart.rekey_fact(spark, path, sales, new_dim, last, terr, load)
    _same(got.drop(mart.FACT_PARTITION), mart.fact_sales(sales, last, terr, load))
    assert {m for m in after if months()[m] != after[m]} == {"OrderMonth=202405"}


def test_upsert_reads_only_months_that_may_hold_its_keys(spark, tmp_path):
    from starmart.operators import membership
    from starmart.operators.upsert import upsert_partitions

    path, rng = str(tmp_path / "t"), random.Random(5)
    rows = [(k, rng.choice(["a", None]), 202401 + k % 8, k * 10) for k in range(800)] + [(None, "a", 202403, 1)]
    table = spark.createDataFrame(rows, "id long, part string, OrderMonth int, v long")
    table.repartition("OrderMonth").write.partitionBy("OrderMonth").parquet(path)
    membership.write_summary(table, path, ["id", "part"], "OrderMonth")
    for r in rows[::37] + rows[-1:]:  # no key is missed
        one = spark.createDataFrame([r], table.schema)
        assert r[2] in membership.candidate_partitions(spark, path, one, ["id", "part"], "OrderMonth")

    # a key that moves from January to May, and one that is new in May; no other month may be read
    moving = next(r for r in rows if r[2] == 202401 and r[1])  # a key with a NULL replaces nothing
    batch = spark.createDataFrame([(moving[0], moving[1], 202405, -1), (5000, "a", 202405, -2)], table.schema)
    assert set(membership.candidate_partitions(spark, path, batch, ["id", "part"], "OrderMonth")) == {202401}
    saved = {}
    for f in glob.glob(f"{path}/OrderMonth=*/*.parquet"):
        if "202401" not in f and "202405" not in f:
            with open(f, "rb") as g:
                saved[f] = g.read()
            with open(f, "wb") as g:
                g.write(b"not a table")
    upsert_partitions(spark, path, batch, ["id", "part"], "OrderMonth")
    for f, content in saved.items():
        with open(f, "wb") as g:
            g.write(content)
        crc = f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc"
        assert os.path.exists(f) and (not os.path.exists(crc) or os.path.getsize(crc))
    want = [r for r in rows if r != moving] + [(moving[0], moving[1], 202405, -1), (5000, "a", 202405, -2)]
    _same(spark.read.parquet(path).select("id", "part", "OrderMonth", "v"), spark.createDataFrame(want, table.schema))
    # the summary has followed: the new key is found where it is
    assert 202405 in membership.candidate_partitions(spark, path, batch, ["id", "part"], "OrderMonth")
    upsert_partitions(spark, path, batch, ["id", "part"], "OrderMonth")
    _same(spark.read.parquet(path).select("id", "part", "OrderMonth", "v"), spark.createDataFrame(want, table.schema))
