"""Hot keys are split by rows; both paths must agree whatever the order column holds."""

import random

import pytest
from conftest import ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import sequence
from starmart.operators.history import dedupe_changes, scd2_from_raw, scd2_merge
from starmart.operators.sequence import dense_ids, hot_keys, with_forward_fill, with_neighbors, with_position


@pytest.mark.parametrize("kind", ["long", "double", "string", "timestamp_ntz"])
def test_split_equals_plain_window(spark, monkeypatch, kind):
    monkeypatch.setattr(sequence, "CHUNK_ROWS", 60)
    random.seed(5)
    rows = [(0 if random.random() < 0.7 else random.choice([1, None]), None if random.random() < 0.1 else random.randint(0, 50), i, i if i % 5 == 0 else None)
            for i in range(700)]
    df = spark.createDataFrame(rows, "k long, o long, id long, v long")
    order = {"long": F.col("o"), "double": F.col("o") / 7, "string": F.col("o").cast("string"),
             "timestamp_ntz": F.when(F.col("o").isNotNull(), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))}[kind]  # one instant
    df = df.withColumn("o", order.cast(kind))
    w = Window.partitionBy("k").orderBy("o", "id")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.lag("id").over(w), F.lead("id").over(w), F.last("v", ignorenulls=True).over(so_far), F.row_number().over(w) - 1)
    hot = hot_keys(df, ["k"], 100)
    assert hot.table.count() >= 1
    a = with_neighbors(df, ["k"], ["o", "id"], ["id"], prev="p", next="n", hot=hot).select("id", "p.id", "n.id").toDF("id", "p", "n")
    b = with_forward_fill(df, ["k"], ["o", "id"], "v", "f", hot=hot).select("id", "f")
    c = with_position(df, ["k"], ["o", "id"], "at", hot=hot).select("id", "at")
    got = a.join(b, "id").join(c, "id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF("id", "p", "n", "f", "at").collect()))


def test_cold_history_reads_once_and_shuffles_once(spark, tmp_path):
    spark.range(2000).select((F.col("id") % 50).alias("k"), F.col("id").alias("o"), (F.col("id") % 3).alias("v"),
                             F.lit("2024-01-01").cast("timestamp_ntz").alias("t")).write.parquet(str(tmp_path / "h"))
    df = spark.read.parquet(str(tmp_path / "h"))
    plan = scd2_from_raw(df, "k", "t", ["k", "v"], "o")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1


def test_dense_ids_without_exchange_reuse(spark):
    df = spark.range(4000).select(F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(3000)).cast("string")).alias("s"))
    want = sorted({r.s for r in df.collect()})
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r.s: r.i for r in dense_ids(df, ["s"], "i", chunks=7).collect()}
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert got == {s: i + 1 for i, s in enumerate(want)}


def test_small_changes_are_changes(spark):
    rows = [(1, 1, 1.0), (1, 2, 1.0000004), (1, 3, 2.0), (1, 4, float("nan")), (1, 5, float("nan")), (1, 6, float("inf")), (1, 7, 1e300), (1, 8, None), (1, 9, None)]
    df = spark.createDataFrame(rows, "k long, t long, v double")
    assert sorted(r.t for r in dedupe_changes(df, "k", "t", ["k", "v"]).collect()) == [1, 2, 3, 4, 6, 7, 8]


def test_late_rows(spark):
    def table(rows):
        return spark.createDataFrame([(k, ts(f"2024-01-{d:02d}"), v) for k, d, v in rows], "k long, t timestamp_ntz, v string")

    stored = scd2_from_raw(table([(1, 1, "A"), (1, 5, "C"), (2, 1, "X")]), "k", "t", ["k", "v"])
    batch = table([(1, 3, "B"), (2, 2, "Y"), (3, 4, "N"), (1, 9, "D")])

    def spans(df):
        return sorted((r.k, r.valid_from.day, r.valid_to.day if r.valid_to.year < 9000 else None, r.v) for r in df.collect())

    assert spans(scd2_merge(stored, batch, "k", "t", ["k", "v"])) == [(1, 1, 5, "A"), (1, 5, 9, "C"), (1, 9, None, "D"), (2, 1, 2, "X"), (2, 2, None, "Y"), (3, 4, None, "N")]
    whole = scd2_from_raw(table([(1, 1, "A"), (1, 5, "C"), (2, 1, "X")]).unionByName(batch), "k", "t", ["k", "v"])
    assert spans(scd2_merge(stored, batch, "k", "t", ["k", "v"], late="rewrite")) == spans(whole)
    # an unchanged sighting is not stored, so a late row before it is not undone by it
    once = scd2_from_raw(table([(1, 1, "A"), (1, 5, "A")]), "k", "t", ["k", "v"])
    assert spans(scd2_merge(once, table([(1, 3, "B")]), "k", "t", ["k", "v"], late="rewrite")) == [(1, 1, 3, "A"), (1, 3, None, "B")]
