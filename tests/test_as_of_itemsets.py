"""Supports for many as-of dates, itemsets by bitmaps, and plans that exchange nothing by scope alone."""

import datetime as dt
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from starmart.operators import as_of as A
from starmart.operators import baskets as B
from starmart.operators import rules as RU

DATES, WINDOW = [20240301, 20240310, 20240315, 20240401, 20250101], 30


def _lines(rng, n):
    """Baskets with one date each; null items, repeated lines and unknown territories."""
    rows = []
    for basket in range(n):
        day = dt.date(2024, 1, 25) + dt.timedelta(days=rng.randrange(75))
        terr = rng.choice([1, 2, 3, None])
        for _ in range(rng.randint(1, 6)):
            rows.append((basket if rng.random() > 0.02 else None, rng.choice("abcdefg") if rng.random() > 0.05 else None, terr, int(day.strftime("%Y%m%d"))))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "SalesOrderID long, item string, TerritoryID long, OrderDateKey long").repartition(5)


@pytest.mark.parametrize("window", [WINDOW, None])
def test_as_of_supports_equal_one_filter_per_date(spark, window):
    rows = _lines(random.Random(1), 200)
    got = {(r["scope"], r["as_of"], r["a"], r["b"]): (r["n"], r["n_baskets"], r["support"]) for r in A.as_of_supports(_frame(spark, rows), "SalesOrderID", "item", DATES, window).collect()}
    want = {}
    for d in DATES:
        end = B.parse_date_key(d)
        start = None if window is None else int((end - dt.timedelta(days=window)).strftime("%Y%m%d"))
        sets = {}
        for basket, item, terr, day in rows:
            if basket is not None and item is not None and day < d and (start is None or day > start):
                for scope in (terr, B.ALL_SCOPE):
                    if scope is not None:
                        sets.setdefault((scope, basket), set()).add(item)
        n = Counter(s for s, _ in sets)
        count = Counter()
        for (scope, _), items in sets.items():
            count.update((scope, d, a, None) for a in items)
            count.update((scope, d, a, b) for a, b in combinations(sorted(items), 2))
        want |= {k: (c, n[k[0]], c / n[k[0]]) for k, c in count.items()}
    assert got == want and any(b for _, _, _, b in want)


def test_as_of_reads_once_whatever_the_dates(spark, tmp_path):
    _frame(spark, _lines(random.Random(2), 50)).write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))

    def scans(dates):
        counts = A.as_of_counts(lines, ["TerritoryID", "item"], "OrderDateKey", dates, WINDOW)
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Expand" not in plan
        return len(re.findall(r"FileScan parquet", plan)), len(re.findall(r"Exchange ", plan))

    assert scans(DATES[:1]) == scans(DATES) == scans([20240101 + k for k in range(28)])
    with pytest.raises(ValueError):
        A.as_of_counts(lines, ["item"], "OrderDateKey", [20240231], WINDOW)
    assert A.as_of_supports(lines.limit(0), "SalesOrderID", "item", DATES, WINDOW).count() == 0


def test_bitmap_itemsets_equal_enumeration(spark):
    rng = random.Random(3)
    sets = [(scope, b, {x for x in "abcdefgh" if rng.random() < (0.7 if x < "d" else 0.2)}) for scope in (1, 2, B.ALL_SCOPE) for b in range({1: 30, 2: 300, B.ALL_SCOPE: 331}[scope])]
    rows = [(s, f"k{b}", x) for s, b, items in sets for x in items] * 2  # repeated rows count once
    items = spark.createDataFrame(rows, "scope long, basket string, item string").repartition(7)
    support = {1: 0.5, 2: 0.1, B.ALL_SCOPE: 0.05}
    for given in (0.08, support):
        want = {}
        for scope in support:
            mine = [x for s, _, x in sets if s == scope and x]
            need = max(1, -(-(given if isinstance(given, float) else given[scope]) * len(mine) // 1))
            count = Counter(c for x in mine for k in range(1, len(x) + 1) for c in combinations(sorted(x), k))
            want |= {(scope, c): (n, len(c), len(mine)) for c, n in count.items() if n >= need}
        got = {(r["scope"], tuple(r["items"])): (r["freq"], r["size"], r["n_baskets"]) for r in RU.frequent_itemsets(items, given).collect()}
        assert got == want and max(len(c) for _, c in want) >= 4
    assert RU.frequent_itemsets(items.limit(0), 0.1).count() == 0


def test_no_exchange_by_scope_alone(spark):
    rows = _lines(random.Random(4), 120)
    items = B.scoped_items(_frame(spark, rows), "SalesOrderID", "item", "TerritoryID")
    by_scope = re.compile(r"hashpartitioning\(scope#\d+L?, \d+\)")
    for made in (B.item_support(items), RU.pair_rules(items, 0.05, 0.1)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert not by_scope.search(plan) and "hashpartitioning" in plan
    # the adaptive rules' top-k is the one thing that is sorted within a scope; its rows passed the thresholds before
    plan = RU.adaptive_rules(items, min_confidence=0.1)._jdf.queryExecution().executedPlan().toString()
    assert len(by_scope.findall(plan)) <= 1
    many = spark.range(5).select(F.col("id").alias("scope"), F.lit(1).alias("n_baskets"))
    try:
        B.MAX_SCOPES = 3
        assert B.with_scope_figures(items.select("scope"), many).count() == B.with_scope_figures(items.select("scope"), many.limit(5)).count()
    finally:
        B.MAX_SCOPES = 10_000
