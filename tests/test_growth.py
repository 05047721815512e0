"""Steps that read, exchange or write a table more often than once cost too much on large tables."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from starmart import session
from starmart.operators import baskets as B
from starmart.operators import rules as RU
from starmart.operators import upsert as U
from starmart.plans import mart


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _plan(df):
    return df._jdf.queryExecution().toString()


def _written(since):
    return [path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for _, path in session._WRITTEN[since:]]


def _baskets(seed=4):
    rng = random.Random(seed)
    return {(s, b): rng.sample("abcdefghij", rng.randint(1, 9)) for s in (-1, 7) for b in range(30)}


def _items(spark, baskets):
    return spark.createDataFrame([(s, b, i) for (s, b), items in baskets.items() for i in items], "scope long, basket long, item string")


@pytest.mark.parametrize("cell_items", [4, 256])
def test_pairs_are_counted_where_baskets_lie(spark, small_batches, cell_items):
    baskets = _baskets()
    want = Counter((s, *pair) for (s, _), items in baskets.items() for pair in combinations(sorted(items), 2))
    pairs = RU.item_pairs(_items(spark, baskets), cell_items)
    assert {(r.scope, r.a, r.b): r.pair_count for r in pairs.collect()} == want
    assert "MapInArrow" in _plan(pairs)  # not a join that makes a row of each pair


def test_many_held_pairs_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(RU, "HELD_PAIRS", 5)
    import numpy as np

    code, basket = np.array([1, 2, 2, 5, 9, 1, 5, 9]), np.array([0, 0, 0, 0, 0, 1, 1, 1])
    got = Counter()
    for batch in RU._pairs_of_whole_baskets(basket, code):
        for a, b, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[a, b] += n
    assert got == {(1, 2): 2, (1, 5): 2, (1, 9): 2, (2, 5): 2, (2, 9): 2, (5, 9): 2}


def test_bitmaps_hold_each_basket_once(spark, small_batches):
    baskets = _baskets()
    before = len(session._WRITTEN)
    words = RU.basket_words(_items(spark, baskets)).collect()
    assert "numbered_baskets" not in _written(before)  # the baskets aren't written for their numbers
    size = Counter()
    for r in words:
        size[r.scope, r.item] += (r.bits & (1 << 64) - 1).bit_count()
    assert size == Counter((s, i) for (s, _), items in baskets.items() for i in items)
    both = Counter()
    for x, y in combinations(words, 2):
        if (x.scope, x.word) == (y.scope, y.word):
            both[x.scope, *sorted((x.item, y.item))] += (x.bits & y.bits & (1 << 64) - 1).bit_count()
    assert +both == Counter((s, *pair) for (s, _), items in baskets.items() for pair in combinations(sorted(items), 2))


def test_lines_are_exchanged_once_for_all_scopes(spark):
    lines = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (1, 5, "a"), (None, 6, "b"), (1, None, "c"), (1, 7, None)], "t long, b long, i string")
    items = B.scoped_items(lines, "b", "i", "t")
    assert sorted(map(tuple, items.collect())) == [(-1, 5, "a"), (-1, 6, "b"), (1, 5, "a"), (2, 5, "a")]
    physical = items._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert physical.count("Exchange hashpartitioning") == 1 and physical.index("Generate") < physical.index("Exchange")


def test_new_state_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.createDataFrame([(1, 1, 10), (2, 1, 20), (3, 2, 30), (4, 3, 40)], "k long, m int, v long")
    table.write.partitionBy("m").parquet(path)
    before = len(session._WRITTEN)
    out = U.upsert_partitions(spark, path, spark.createDataFrame([(1, 1, 11), (3, 1, 31)], table.schema), ["k"], "m")
    assert sorted((r.k, r.m, r.v) for r in out.collect()) == [(1, 1, 11), (2, 1, 20), (3, 1, 31), (4, 3, 40)]
    assert _written(before) == ["upsert_batch"]
    assert not (tmp_path / "t" / "m=2").exists()


def test_incremental_batch_is_built_once(spark):
    sales = spark.createDataFrame([(1, 1, "2001-01-02", "2001-01-01", 1), (2, 1, "2001-03-02", "2001-03-01", 1)],
                                  "SalesOrderID long, ProductID long, ModifiedDate string, OrderDate string, TerritoryID long")
    sales = sales.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ModifiedDate", "OrderDate")})
    dim = spark.sql("SELECT 'p' AS ProductKey, 1L AS ProductID, TIMESTAMP_NTZ '1990-01-01' AS ValidFrom, TIMESTAMP_NTZ '9999-01-01' AS ValidTo")
    territory = spark.createDataFrame([(1, 1)], "TerritoryID long, TerritoryKey long")
    load, cut = F.lit("2002-01-01").cast("timestamp_ntz"), F.lit("2001-02-01").cast("timestamp_ntz")
    target = mart.fact_sales(sales.filter(F.col("ModifiedDate") < cut), dim, territory, load)
    before = len(session._WRITTEN)
    out = mart.fact_incremental(sales, target, dim, territory, load_ts=load, arrived_since=cut)
    assert sorted(r.SalesOrderID for r in out.collect()) == [1, 2] and _written(before) == ["upsert_batch"]


def test_interleaved_order_without_a_loop_per_row(spark):
    rows = [(None if i % 50 == 0 else i * 37 % 101, float("nan") if i % 60 == 0 else i * 11 % 7 / 2, None if i % 9 == 0 else f"k{i * 53 % 997:03d}") for i in range(600)]
    df = spark.createDataFrame(rows, "a long, b double, c string")
    columns, bits = ["a", "b", "c"], 3
    quantiles = U._quantiles(df, columns, bits)
    got = df.select(U.interleaved(df, columns, bits).alias("z"), *[U._rank_number(df, c).alias(c) for c in columns])
    for r in got.collect():
        cells = [0 if r[c] is None else sum(q <= r[c] or r[c] != r[c] for q in quantiles[i]) for i, c in enumerate(columns)]
        assert r.z == sum((cell >> b & 1) << (b * 3 + i) for i, cell in enumerate(cells) for b in range(bits))
    assert "lambdafunction" not in _plan(got)
