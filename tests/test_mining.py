import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import baskets as B
from starmart.operators import rules as RU
from starmart.functions.rules import rule_hash, rule_id


def _lines(spark, rows):
    return spark.createDataFrame(rows, "TerritoryID long, basket long, item string, OrderDateKey long")


def _random_lines(seed=1, n_baskets=120, hot_basket_items=12):
    random.seed(seed)
    vocab = [f"i{j:02d}" for j in range(14)]
    rows = []
    for b in range(n_baskets):
        terr = b % 3 + 1
        k = hot_basket_items if b == 0 else random.randint(1, 6)
        # correlated items so that confident rules exist
        pool = vocab[:6] if (random.random() < 0.6 and b != 0) else vocab
        items = set(random.sample(pool, min(k, len(pool))))
        if "i00" in items:
            items.add("i01")
        for it in items:
            rows.append((terr, b, it, 20200101))
    return rows


def _scope_baskets(rows):
    """Baskets as item sets, per territory and (None) over all."""
    out = {}
    for territory, basket, item, _ in rows:
        for scope in (territory, None):
            out.setdefault(scope, {}).setdefault(basket, set()).add(item)
    return {scope: list(b.values()) for scope, b in out.items()}


def _level_table(baskets, floor=0.01):
    """The supports a scope may use: five of them, each three quarters of the one before, from the
    statistic of the specification down to the floor; the floor alone if that lies below it."""
    n, pairs = len(baskets), sum(map(len, baskets))
    items = set().union(*baskets)
    biggest = max(sum(i in b for b in baskets) for i in items) / n
    start = biggest * (1 - (2.0 ** len(items) - 1) ** (-0.5 * len(items) / pairs)) if len(items) > 1 else 0.0
    return [s for s in (max(start, floor) * 0.75**k for k in range(5)) if s >= floor] or [floor]


def _all_rules(baskets, largest, least_count, min_confidence=0.65):
    """{(antecedent, consequent): (itemset count, lift)} by enumeration of item subsets."""
    n = len(baskets)
    count = {}
    for size in range(1, largest + 1):
        for s in itertools.combinations(sorted(set().union(*baskets)), size):
            c = sum(b.issuperset(s) for b in baskets)
            if c >= least_count:
                count[s] = c
    found = {}
    for s, c in count.items():
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                rest = tuple(x for x in s if x not in a)
                confidence = (c / n) / (count[a] / n)
                if confidence >= min_confidence:
                    found[a, rest] = (c, confidence / (count[rest] / n))
    return found


def _expected_rules(rows, max_rules, largest=2):
    out = {}
    for scope, baskets in _scope_baskets(rows).items():
        needs = [math.ceil(s * len(baskets)) for s in _level_table(baskets)]
        rules = _all_rules(baskets, largest, needs[-1])
        by_level = [[r for r, (c, _) in rules.items() if c >= need] for need in needs]
        full = [q for q in by_level if min(len(q), max_rules) > int(0.8 * max_rules)]
        chosen = full[0] if full else by_level[-1]
        out[scope] = sorted(sorted(chosen, key=lambda r: (-rules[r][0], -rules[r][1], r))[:max_rules])
    return {scope: r for scope, r in out.items() if r}


def test_adaptive_rules_by_level_table(spark):
    for seed in (1, 2):
        rows = _random_lines(seed)
        items = B.scoped_items(_lines(spark, rows), "basket", "item", "TerritoryID")
        for max_rules in (35, 6):
            got = {}
            for r in RU.adaptive_rules(items, max_rules=max_rules, cell_items=3).select(B.output_scope(), "antecedent", "consequent").collect():
                got.setdefault(r.territory_id, []).append(((r.antecedent,), (r.consequent,)))
            assert {k: sorted(v) for k, v in got.items()} == _expected_rules(rows, max_rules), (seed, max_rules)


def test_adaptive_multi_item_rules_by_level_table(spark):
    rows = [r for r in _random_lines(4, n_baskets=60, hot_basket_items=7) if r[2] < "i09"]
    items = B.scoped_items(_lines(spark, rows), "basket", "item", "TerritoryID")
    got = {}
    for r in RU.adaptive_multi_item_rules(items, max_rules=20).select(B.output_scope(), "antecedents", "consequents").collect():
        got.setdefault(r.territory_id, []).append((tuple(r.antecedents), tuple(r.consequents)))
    want = _expected_rules(rows, 20, largest=9)
    assert {k: sorted(v) for k, v in got.items()} == want and any(len(a) + len(c) > 2 for r in want.values() for a, c in r)


def test_itemsets_of_more_than_twelve_items(spark):
    rows = [(1, b, f"i{j:02d}", 1) for b in range(4) for j in range(13)] + [(1, 4, "i00", 1)]
    items = B.scoped_items(_lines(spark, rows), "basket", "item", None)
    sets = RU.frequent_itemsets(items, 0.5)
    assert sets.count() == 2**13 - 1
    rules = RU.multi_item_rules(sets.filter("size in (1, 12, 13)"), 0.9)
    whole = rules.filter(F.size("antecedents") + F.size("consequents") == 13)
    assert whole.filter(F.size("antecedents") == 12).count() == 13 and whole.filter("confidence < 0.9").count() == 0


def test_item_pairs_hot_basket_cells(spark):
    rows = _random_lines(5, n_baskets=30, hot_basket_items=14)
    items = B.scoped_items(_lines(spark, rows), "basket", "item", "TerritoryID")
    small = {(r.scope, r.a, r.b): r.pair_count for r in RU.item_pairs(items, cell_items=2).collect()}
    one = {(r.scope, r.a, r.b): r.pair_count for r in RU.item_pairs(items, cell_items=10_000).collect()}
    assert small == one and len(one) > 0


def test_pair_rules_match_fpgrowth(spark):
    from pyspark.ml.fpm import FPGrowth

    rows = _random_lines(9)
    items = B.scoped_items(_lines(spark, rows), "basket", "item", None)
    ours = {(r.antecedent, r.consequent): round(r.confidence, 9) for r in RU.pair_rules(items, 0.05).collect()}
    tx = items.groupBy("basket").agg(F.collect_list("item").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.65).fit(tx)
    theirs = {(r.antecedent[0], r.consequent[0]): round(r.confidence, 9)
              for r in model.associationRules.filter(F.size("antecedent") == 1).collect()}
    assert ours == theirs and ours


def test_adaptive_min_support_edges(spark):
    one = B.scoped_items(_lines(spark, [(1, 1, "x", 1), (1, 2, "x", 1)]), "basket", "item", None)
    st = B.adaptive_min_support(B.scope_stats(one)).first()
    assert st.min_support == 0.0
    lvl = RU.scope_levels(one).first()
    assert lvl.levels[0].level_support == RU.SUPPORT_FLOOR and [l.valid for l in lvl.levels] == [True, False, False, False, False]
    big = [(1, b, f"p{i}", 1) for b in range(3) for i in range(2000)]
    st = B.adaptive_min_support(B.scope_stats(B.scoped_items(_lines(spark, big), "basket", "item", None))).first()
    assert math.isfinite(st.min_support)


def test_rule_hash_collision_and_id(spark):
    df = spark.createDataFrame([(["1"], ["23"]), (["12"], ["3"])], "a array<string>, c array<string>")
    r = df.select(rule_hash("a", "c").alias("h"), rule_id("a", "c").alias("i")).collect()
    assert r[0].h == r[1].h and r[0].i != r[1].i


def test_scope_filter_bounds_and_errors(spark):
    rows = [(1, 1, "a", 20000101), (1, 2, "a", 19990101), (1, 3, "a", 19990615), (2, 4, "a", 19990615)]
    df = _lines(spark, rows)
    got = sorted(r.basket for r in B.scope_filter(df, territory_id=1, date_filter=20000101, window=365).collect())
    assert got == [3]
    with pytest.raises(ValueError):
        B.scope_filter(df, window=30)
    with pytest.raises(ValueError):
        B.scope_filter(df, date_filter=20251332)


def test_empty_input_gives_empty_frame(spark):
    empty = _lines(spark, [])
    out = RU.mine_rules(empty.withColumnRenamed("basket", "CustomerID"), "CustomerID", "item")
    assert out.count() == 0
    assert {"antecedents", "consequents", "support", "confidence", "lift", "rule_hash", "territory_id"} <= set(out.columns)


def _survey_lines(spark, item):
    from starmart.sources.catalog import table

    root = "/root/testdata/sf0.01"
    o, c, n = table(spark, root, "orders"), table(spark, root, "customer"), table(spark, root, "nation")
    li, p = table(spark, root, "lineitem"), table(spark, root, "part")
    lines = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey).join(p, li.l_partkey == p.p_partkey))
    return lines.select(F.col("o_custkey").alias("basket"), F.col(item).alias("item"), F.col("n_regionkey").cast("bigint").alias("TerritoryID"))


@pytest.mark.parametrize("item,expected", [
    # FIXTURES.md §3: (initial min support, levels used, rules) for the overall scope and regions 0..4
    ("p_name", {None: (0.01893, 3, 1), 0: (0.08994, 5, 11), 1: (0.09328, 1, 35), 2: (0.08470, 5, 7),
                3: (0.08508, 5, 6), 4: (0.09088, 5, 12)}),
    ("p_brand", {None: (0.00628, 1, 35), 0: (0.03347, 1, 35), 1: (0.03063, 1, 35), 2: (0.03009, 1, 35),
                 3: (0.03109, 1, 35), 4: (0.03172, 1, 35)}),
])
def test_adaptive_rules_match_survey_probe(spark, item, expected):
    items = B.scoped_items(_survey_lines(spark, item), "basket", "item", "TerritoryID")
    sup = {r.territory_id: r.min_support for r in
           B.adaptive_min_support(B.scope_stats(items)).select(B.output_scope(), "min_support").collect()}
    rules = RU.adaptive_rules(items).select(B.output_scope(), "chosen_level").collect()
    got = {}
    for r in rules:
        got.setdefault(r.territory_id, []).append(r.chosen_level)
    for scope, (m0, levels, n_rules) in expected.items():
        assert round(sup[scope], 5) == m0, scope
        assert len(got[scope]) == n_rules, scope
        assert got[scope][0] + 1 == levels, scope
