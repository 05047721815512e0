"""Association rules (O-24, O-36, O-46a .. O-46h).

Single-item rules a -> b come from pair co-occurrence counts; every scope and every support level
is evaluated in one pass, and the retry loop of the original miner (lower the support by 25% until
enough rules are found, at most 5 tries, never below the floor) is replaced by a closed form: each
rule knows the first level at which it qualifies, so the number of rules per level is a cumulative
count and the chosen level is a per-scope aggregate.  No driver loop, nothing collected.
"""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import rule_hash, rule_id
from ..session import materialize
from .baskets import BASKET, ITEM, MAX_SCOPES, SCOPE, adaptive_min_support, item_counts, output_scope, scope_stats, with_scope_figures
from .sequence import dense_ids

# Fixed miner settings (defaults of the published job).
MIN_CONFIDENCE = 0.65
SUPPORT_FLOOR = 0.01
MAX_TRIES = 5
DECAY = 0.75
MAX_RULES = 35
MAX_RULES_WINDOW = 20
ENOUGH_FRACTION = 0.8

# A basket with more frequent items than this is split into hash cells so that no task has to
# produce all of its pairs.
CELL_ITEMS = 256


def local_figures(figures: DataFrame) -> DataFrame:
    """Figures per scope, computed once, as a local table (written, if there are too many scopes for that)."""
    rows = figures.limit(MAX_SCOPES + 1).collect()
    return materialize(figures, "scope_figures") if len(rows) > MAX_SCOPES else figures.sparkSession.createDataFrame(rows, figures.schema)


def level_supports(m0: Column, floor: float = SUPPORT_FLOOR, tries: int = MAX_TRIES, decay: float = DECAY) -> list[Column]:
    """Support of level k = m0 * decay * ... * decay (k times, multiplied step by step)."""
    out, m = [], m0
    for _ in range(tries):
        out.append(m)
        m = m * F.lit(decay)
    return out


def scope_levels(items: DataFrame, floor: float = SUPPORT_FLOOR, tries: int = MAX_TRIES, decay: float = DECAY) -> DataFrame:
    """Per scope: statistics, the initial min support, and the support of each level it may try.

    A level is tried while its support is >= the floor.  An initial value below the floor (which
    would leave the original loop without any result) is clamped to the floor: one level."""
    st = adaptive_min_support(scope_stats(items))
    m0 = F.when(F.col("min_support") >= F.lit(floor), F.col("min_support")).otherwise(F.lit(floor))
    sups = level_supports(m0, floor, tries, decay)
    levels = F.array(*[
        F.struct(F.lit(k).alias("level"), s.alias("level_support"),
                 F.ceil(s * F.col("n_baskets")).cast("bigint").alias("min_count"), (s >= F.lit(floor)).alias("valid"))
        for k, s in enumerate(sups)
    ])
    return st.withColumn("levels", levels)


def pair_rows(items: DataFrame, cell_items: int = CELL_ITEMS) -> DataFrame:
    """(scope, basket, a, b) with a < b: the pairs of each basket.

    A basket with k items is cut into C = ceil(k / cell_items) hash chunks of its items; cell
    (lo, hi), lo <= hi, pairs chunk lo with chunk hi.  Each item row is replicated into the C cells
    of its chunk and the pairs come from an equi-join on (scope, basket, lo, hi): a basket's pairs
    are produced by C(C+1)/2 independent join keys of at most 2 * cell_items rows, spread over
    tasks, instead of by one task holding the whole basket.  Ordinary baskets have one cell."""
    sizes = items.groupBy(SCOPE, BASKET).agg(F.count(F.lit(1)).alias("_sm_k"))
    x = items.join(sizes, [SCOPE, BASKET])
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("_sm_k") / F.lit(cell_items))).cast("int")
    x = x.withColumn("_sm_c", F.pmod(F.xxhash64(ITEM), n_chunks).cast("int"))
    x = x.withColumn("_sm_t", F.explode(F.sequence(F.lit(0), n_chunks - 1)))
    x = x.select(SCOPE, BASKET, ITEM, "_sm_c",
                 F.least("_sm_c", "_sm_t").alias("_sm_lo"), F.greatest("_sm_c", "_sm_t").alias("_sm_hi"))
    cell = [SCOPE, BASKET, "_sm_lo", "_sm_hi"]
    left = x.filter(F.col("_sm_c") == F.col("_sm_lo")).select(*cell, F.col(ITEM).alias("_sm_a"))
    right = x.filter(F.col("_sm_c") == F.col("_sm_hi")).select(*cell, F.col(ITEM).alias("_sm_b"))
    pairs = left.join(right, cell).filter((F.col("_sm_lo") != F.col("_sm_hi")) | (F.col("_sm_a") < F.col("_sm_b")))
    return pairs.select(SCOPE, BASKET, F.least("_sm_a", "_sm_b").alias("a"), F.greatest("_sm_a", "_sm_b").alias("b"))


#: Pairs that a task holds before it counts them.
HELD_PAIRS = 4_000_000


def _baskets_begin(rows: pa.Table) -> np.ndarray:
    """For each row but the first, whether its (scope, basket) differs from that of the row before."""
    n = rows.num_rows
    differ = [pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy() for c in (rows[SCOPE], rows[BASKET])]
    return np.logical_or(*differ)


def _counted(first: np.ndarray, second: np.ndarray) -> pa.RecordBatch:
    keys, n = np.unique((first << 32) | second, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(n.astype(np.int64))], ["a", "b", "n"])


def _pairs_of_whole_baskets(basket: np.ndarray, code: np.ndarray):
    """Counts of the pairs a < b of each basket; rows lie by basket and code, so a row's partners follow it."""
    item, no = np.unique(code, return_inverse=True)
    square = len(item) ** 2 <= HELD_PAIRS
    counts = np.zeros(len(item) ** 2 if square else 0, np.int64)
    held, at, step = [], np.arange(len(code)), 0
    while True:
        step += 1
        at = at[at + step < len(code)]
        at = at[basket[at + step] == basket[at]]
        if not len(at):
            break
        held.append((at, at + step))
        if sum(len(x) for x, _ in held) >= HELD_PAIRS:
            yield from _flush(held, no, code, len(item), counts, square)
    yield from _flush(held, no, code, len(item), counts, square)
    if square and counts.any():
        keys = np.flatnonzero(counts)
        a, b = item[keys // len(item)], item[keys % len(item)]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(counts[keys])], ["a", "b", "n"])


def _flush(held: list, no: np.ndarray, code: np.ndarray, n: int, counts: np.ndarray, square: bool):
    if not held:
        return
    first, second = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    other = code[first] != code[second]
    first, second = first[other], second[other]
    if square:
        counts += np.bincount(no[first] * n + no[second], minlength=n * n)
    elif len(first):
        yield _counted(code[first], code[second])


def _count_pairs(batches):
    """(a, b, n) of rows (scope, basket, code) that lie by all three; the last basket of a batch waits for the next."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        if rows.num_rows < 2:
            rest = rows
            continue
        basket = np.concatenate([[0], np.cumsum(_baskets_begin(rows))])
        whole = int(np.searchsorted(basket, basket[-1]))
        yield from _pairs_of_whole_baskets(basket[:whole], rows["code"].to_numpy()[:whole])
        rest = rows.slice(whole)
    if rest is not None:
        yield from _pairs_of_whole_baskets(np.zeros(rest.num_rows, np.int64), rest["code"].to_numpy())


def item_pairs(items: DataFrame, cell_items: int = CELL_ITEMS, known: DataFrame | None = None) -> DataFrame:
    """Co-occurrence counts (scope, a, b, pair_count) with a < b.

    Items become numbers, one exchange brings the items of a basket together, and each task counts the pairs of
    its baskets before they are exchanged.  Where a scope has more than ``cell_items`` items, baskets of more
    than that are paired by :func:`pair_rows`.  ``known``: the (scope, item) of ``items``, if at hand."""
    items = items.select(SCOPE, BASKET, ITEM).dropna()
    codes = materialize(dense_ids(items if known is None else known, [SCOPE, ITEM], "code"), "item_codes")
    widest = codes.groupBy(SCOPE).count().agg(F.max("count")).first()[0] or 0
    ordinary, large = items, None
    if widest > cell_items:
        large = items.groupBy(SCOPE, BASKET).count().filter(F.col("count") > cell_items).select(SCOPE, BASKET)
        large = materialize(large, "large_baskets")
        ordinary = items.join(large, [SCOPE, BASKET], "left_anti")
    rows = ordinary.join(codes, [SCOPE, ITEM]).select(SCOPE, BASKET, "code").repartition(SCOPE, BASKET).sortWithinPartitions(SCOPE, BASKET, "code")
    counted = rows.mapInArrow(_count_pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("pair_count"))
    first = codes.select(SCOPE, F.col(ITEM).alias("_sm_a"), F.col("code").alias("a"))
    second = codes.select(F.col(ITEM).alias("_sm_b"), F.col("code").alias("b"))
    pairs = counted.join(first, "a").join(second, "b").select(SCOPE, F.col("_sm_a").alias("a"), F.col("_sm_b").alias("b"), "pair_count")
    if large is None:
        return pairs
    wide = pair_rows(items.join(large, [SCOPE, BASKET], "left_semi"), cell_items).groupBy(SCOPE, "a", "b").agg(F.count(F.lit(1)).alias("pair_count"))
    return pairs.unionByName(wide).groupBy(SCOPE, "a", "b").agg(F.sum("pair_count").alias("pair_count"))


def _rules_from_pairs(pairs: DataFrame, counts: DataFrame, n_baskets: DataFrame, min_confidence: float) -> DataFrame:
    """Both directions of every pair with the rule metrics (fractions computed like the original:
    confidence = support(AC) / support(A), lift = confidence / support(C))."""
    ca = counts.select(SCOPE, F.col(ITEM).alias("a"), F.col("item_count").alias("count_a"))
    cb = counts.select(SCOPE, F.col(ITEM).alias("b"), F.col("item_count").alias("count_b"))
    p = with_scope_figures(pairs.join(ca, [SCOPE, "a"]).join(cb, [SCOPE, "b"]), n_baskets)
    both = p.select(
        SCOPE, "pair_count", "n_baskets",
        F.explode(F.array(
            F.struct(F.col("a").alias("ante"), F.col("b").alias("cons"), F.col("count_a").alias("ca"), F.col("count_b").alias("cc")),
            F.struct(F.col("b").alias("ante"), F.col("a").alias("cons"), F.col("count_b").alias("ca"), F.col("count_a").alias("cc")),
        )).alias("_sm_r"),
    )
    n = F.col("n_baskets")
    support = F.col("pair_count") / n
    ante_sup = F.col("_sm_r.ca") / n
    cons_sup = F.col("_sm_r.cc") / n
    conf = support / ante_sup
    rules = both.select(
        SCOPE,
        F.col("_sm_r.ante").alias("antecedent"),
        F.col("_sm_r.cons").alias("consequent"),
        ante_sup.alias("antecedent_support"),
        cons_sup.alias("consequent_support"),
        support.alias("support"),
        conf.alias("confidence"),
        (conf / cons_sup).alias("lift"),
        "pair_count",
        "n_baskets",
    )
    return rules.filter(F.col("confidence") >= F.lit(min_confidence))


def pair_rules(items: DataFrame, min_support: float, min_confidence: float = MIN_CONFIDENCE, cell_items: int = CELL_ITEMS) -> DataFrame:
    """All single-item rules per scope with support >= ``min_support`` (itemset count >=
    ceil(min_support * baskets)) and confidence >= ``min_confidence``."""
    counts = materialize(item_counts(items), "item_counts")
    n = items.groupBy(SCOPE).agg(F.countDistinct(BASKET).alias("n_baskets"))
    need = F.ceil(F.lit(min_support) * F.col("n_baskets")).cast("bigint")
    n = local_figures(n)
    frequent = with_scope_figures(counts, n).filter(F.col("item_count") >= need).select(SCOPE, ITEM)
    pairs = item_pairs(items.join(frequent, [SCOPE, ITEM], "left_semi"), cell_items, frequent)
    pairs = with_scope_figures(pairs, n).filter(F.col("pair_count") >= need).drop("n_baskets")
    return _rules_from_pairs(pairs, counts, n, min_confidence).drop("pair_count", "n_baskets")


def adaptive_rules(
    items: DataFrame,
    max_rules: int = MAX_RULES,
    min_confidence: float = MIN_CONFIDENCE,
    floor: float = SUPPORT_FLOOR,
    tries: int = MAX_TRIES,
    decay: float = DECAY,
    cell_items: int = CELL_ITEMS,
) -> DataFrame:
    """Top ``max_rules`` single-item rules per scope at the support level the original retry loop
    would settle on: the first level whose top-k holds more than int(0.8 * max_rules) rules, else
    the last level tried.  Ties in (support, lift) are broken by the items, so the cut is total."""
    levels = local_figures(scope_levels(items, floor, tries, decay))
    lv = levels.select(SCOPE, "n_baskets", F.explode("levels").alias("_sm_l")).filter(F.col("_sm_l.valid"))
    lv = lv.select(SCOPE, "n_baskets", F.col("_sm_l.level").alias("level"), F.col("_sm_l.min_count").alias("min_count"))
    lowest = lv.groupBy(SCOPE).agg(F.min("min_count").alias("_sm_need"))

    counts = materialize(item_counts(items), "item_counts")
    n = levels.select(SCOPE, "n_baskets")
    frequent = with_scope_figures(counts, lowest).filter(F.col("item_count") >= F.col("_sm_need")).select(SCOPE, ITEM)
    pairs = item_pairs(items.join(frequent, [SCOPE, ITEM], "left_semi"), cell_items, frequent)
    pairs = with_scope_figures(pairs, lowest).filter(F.col("pair_count") >= F.col("_sm_need")).drop("_sm_need")
    rules = _rules_from_pairs(pairs, counts, n, min_confidence)

    return _top_at_level(rules, levels, max_rules)


def _top_at_level(rules: DataFrame, levels: DataFrame, max_rules: int) -> DataFrame:
    """Per scope the top ``max_rules`` of the rules that qualify (``pair_count``) at the chosen level."""
    lv = levels.select(SCOPE, "n_baskets", F.explode("levels").alias("_sm_l")).filter(F.col("_sm_l.valid"))
    lv = lv.select(SCOPE, "n_baskets", F.col("_sm_l.level").alias("level"), F.col("_sm_l.min_count").alias("min_count"))
    # First level at which each rule qualifies (thresholds fall with the level).
    thresholds = levels.select(SCOPE, F.filter("levels", lambda l: l["valid"]).alias("_sm_lv"))
    rules = with_scope_figures(rules, thresholds).withColumn(
        "level",
        F.aggregate(F.filter("_sm_lv", lambda l: F.col("pair_count") >= l["min_count"]),
                    F.lit(None).cast("int"), lambda acc, l: F.coalesce(acc, l["level"])),
    ).filter(F.col("level").isNotNull()).drop("_sm_lv")
    rules = materialize(rules, "scope_rules")  # read for the counts by level and for the top

    enough = int(ENOUGH_FRACTION * max_rules)
    per_level = rules.groupBy(SCOPE, "level").agg(F.count(F.lit(1)).alias("_sm_n"))
    grid = lv.join(per_level, [SCOPE, "level"], "left").fillna(0, ["_sm_n"])
    cum = Window.partitionBy(SCOPE).orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grid = grid.withColumn("_sm_cum", F.sum("_sm_n").over(cum))
    found = F.least(F.col("_sm_cum"), F.lit(max_rules)) > F.lit(enough)
    chosen = grid.groupBy(SCOPE).agg(
        F.coalesce(F.min(F.when(found, F.col("level"))), F.max("level")).alias("chosen_level"),
    )
    picked = with_scope_figures(rules, chosen).filter(F.col("level") <= F.col("chosen_level"))
    rank = Window.partitionBy(SCOPE).orderBy(
        F.col("support").desc(), F.col("lift").desc(), F.col("antecedent"), F.col("consequent"))
    top = picked.withColumn("_sm_rank", F.row_number().over(rank)).filter(F.col("_sm_rank") <= max_rules)
    return top.select(SCOPE, "antecedent", "consequent", "antecedent_support", "consequent_support",
                      "support", "confidence", "lift", "chosen_level")


def today_key() -> int:
    return int(dt.date.today().strftime("%Y%m%d"))


def decorate(rules: DataFrame, window: int | None = None, update_at: int | None = None) -> DataFrame:
    """Rows of the published rule table: item arrays, metrics, row id, territory, window,
    update date (the date filter, else today) and the rule hash (+ an unambiguous rule id)."""
    ante = F.array(F.col("antecedent"))
    cons = F.array(F.col("consequent"))
    return rules.select(
        F.sort_array(ante).alias("antecedents"),
        F.sort_array(cons).alias("consequents"),
        "antecedent_support", "consequent_support", "support", "confidence", "lift",
        F.expr("uuid()").alias("row_id"),
        output_scope(),
        F.lit(window).cast("bigint").alias("window"),
        F.lit(update_at if update_at is not None else today_key()).cast("bigint").alias("update_at"),
        rule_hash(ante, cons).alias("rule_hash"),
        rule_id(ante, cons).alias("rule_id"),
    )


def mine_rules(
    lines: DataFrame,
    basket: str,
    item: str,
    territory: str | None = "TerritoryID",
    date_key_col: str = "OrderDateKey",
    date_filter: int | None = None,
    window: int | None = None,
    cell_items: int = CELL_ITEMS,
) -> DataFrame:
    """End-to-end miner for all territories and the overall scope at once (scope filter ->
    baskets -> adaptive rules -> decoration).  Empty input gives an empty frame with the schema."""
    from .baskets import scope_filter, scoped_items

    scoped = scope_filter(lines, date_key_col, territory or "TerritoryID", None, date_filter, window)
    items = materialize(scoped_items(scoped, basket, item, territory), "mining_items")
    max_rules = MAX_RULES_WINDOW if window is not None else MAX_RULES
    return decorate(adaptive_rules(items, max_rules=max_rules, cell_items=cell_items), window, date_filter)


# ---------------------------------------------------------------------------------------------
# Itemsets of any size, by bitmaps of baskets.

def _number_baskets(batches):
    """Rows (scope, item, first), a basket's rows after each other -> (scope, item, no), numbers that no other task gives."""
    no = TaskContext.get().partitionId() << 36
    for batch in batches:
        numbers = no + np.cumsum(batch["first"].to_numpy(zero_copy_only=False))
        no = int(numbers[-1]) if len(numbers) else no
        yield pa.RecordBatch.from_arrays([batch[SCOPE], batch[ITEM], pa.array(numbers)], [SCOPE, ITEM, "no"])


def basket_words(items: DataFrame) -> DataFrame:
    """(scope, item, word, bits): the baskets of each item as bitmaps of 64 baskets; written.

    A window brings a basket's items together (without an exchange, where they are so already); baskets are
    numbered as they lie in their partition, sorted by scope and basket, so a task that runs again gives the
    same numbers."""
    first = F.row_number().over(Window.partitionBy(SCOPE, BASKET).orderBy(ITEM)) == 1
    rows = items.select(SCOPE, BASKET, ITEM).dropna().withColumn("first", first).select(SCOPE, ITEM, "first")
    each = rows.mapInArrow(_number_baskets, f"{SCOPE} {items.schema[SCOPE].dataType.simpleString()}, {ITEM} {items.schema[ITEM].dataType.simpleString()}, no long")
    each = each.select(SCOPE, ITEM, F.shiftright("no", 6).alias("word"), F.expr("shiftleft(1L, CAST(no & 63 AS INT))").alias("bit"))
    return materialize(each.groupBy(SCOPE, ITEM, "word").agg(F.bit_or("bit").alias("bits")), "basket_words")


def frequent_itemsets(items: DataFrame, min_support: float | dict[int, float]) -> DataFrame:
    """Frequent itemsets per scope: count >= ceil(support * baskets of the scope), written once.

    Vertical mining of all scopes at once: an itemset has, per 64 baskets, one long with a bit for each
    basket that holds all its items.  A level joins the sets of the level before with the frequent items
    behind their last one on (scope, word), ANDs the bits and adds up their counts, which combine before
    the exchange; infrequent sets go before the next level.  No set or item is kept in one row, so hot
    items are as many rows as they have words.  Per scope (a few dozen) only its number of baskets comes
    to the driver; the levels are as many as the largest itemset has items.  ``min_support`` may give
    each scope its own support."""
    spark = items.sparkSession
    items = items.select(SCOPE, BASKET, F.col(ITEM).cast("string").alias(ITEM))
    words = basket_words(items)
    # Every basket has an item, so the bits that are set in any of a word's rows are its baskets.
    per_word = words.groupBy(SCOPE, "word").agg(F.bit_or("bits").alias("bits"))
    n = {r[SCOPE]: r["n"] for r in per_word.groupBy(SCOPE).agg(F.sum(F.bit_count("bits")).alias("n")).collect()}
    if not n:
        return spark.createDataFrame([], "scope bigint, items array<string>, freq bigint, size int, n_baskets bigint")
    support = min_support if isinstance(min_support, dict) else dict.fromkeys(n, min_support)
    figures = spark.createDataFrame([(k, v, max(1, math.ceil(support[k] * v))) for k, v in n.items()], "scope long, n_baskets long, _sm_need long")

    def frequent(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy(SCOPE, "items").agg(F.sum(F.bit_count("bits")).alias("freq"))
        found = with_scope_figures(counts, figures).filter(F.col("freq") >= F.col("_sm_need"))
        return materialize(found.select(SCOPE, "items", "freq", F.size("items").alias("size"), "n_baskets"), "itemsets")

    rows = words.select(SCOPE, F.array(ITEM).alias("items"), "word", "bits")
    out = found = frequent(rows)
    single = materialize(words.join(found.select(SCOPE, F.col("items")[0].alias(ITEM)), [SCOPE, ITEM], "left_semi"), "frequent_words")
    added = single.select(SCOPE, "word", F.col(ITEM).alias("_sm_next"), F.col("bits").alias("_sm_bits"))
    while not found.isEmpty():
        rows = rows.join(found.select(SCOPE, "items"), [SCOPE, "items"], "left_semi")
        both = F.col("bits").bitwiseAND(F.col("_sm_bits"))
        longer = rows.join(added, [SCOPE, "word"]).filter((F.col("_sm_next") > F.element_at("items", -1)) & (both != 0))
        rows = longer.select(SCOPE, F.concat("items", F.array("_sm_next")).alias("items"), "word", both.alias("bits"))
        found = frequent(rows)
        out = out.unionByName(found)
    return out


def multi_item_rules(itemsets: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """All antecedent -> consequent splits (both sides non-empty) of every frequent itemset that reach
    ``min_confidence``, with support, confidence, lift, ``freq`` and ``n_baskets``.

    Splits are built level by level: from the whole itemset one antecedent item moves to the
    consequent at a time, and only splits that reach the confidence go on, since a smaller antecedent
    is at least as frequent and its confidence no higher.  Antecedent counts come from the itemset
    table itself (every subset of a frequent itemset is in it).  The loop has as many levels as the
    largest itemset has items, whatever their number."""
    lookup = itemsets.select(SCOPE, F.col("items").alias("_sm_k"), F.col("freq").alias("_sm_f"))
    level = itemsets.filter(F.col("size") >= 2).select(SCOPE, F.col("items").alias("_sm_all"), "freq", "n_baskets", F.col("items").alias("antecedents"))
    enough = (F.col("freq") / F.col("n_baskets")) / (F.col("ante_freq") / F.col("n_baskets")) >= F.lit(min_confidence)
    splits = None
    for _ in range((itemsets.agg(F.max("size")).first()[0] or 1) - 1):
        smaller = level.filter(F.size("antecedents") >= 2).withColumn("_sm_out", F.explode("antecedents"))
        smaller = smaller.withColumn("antecedents", F.array_remove("antecedents", F.col("_sm_out"))).drop("_sm_out").distinct()
        counted = smaller.join(lookup.toDF(SCOPE, "antecedents", "ante_freq"), [SCOPE, "antecedents"]).filter(enough)
        counted = materialize(counted, "rule_splits")
        splits = counted if splits is None else splits.unionByName(counted)
        level = counted.drop("ante_freq")
        if level.isEmpty():
            break
    if splits is None:
        splits = level.withColumn("ante_freq", F.lit(None).cast("bigint"))
    splits = splits.withColumn("consequents", F.array_except("_sm_all", "antecedents"))
    j = splits.join(lookup.toDF(SCOPE, "consequents", "cons_freq"), [SCOPE, "consequents"])
    n = F.col("n_baskets")
    support = F.col("freq") / n
    ante_sup = F.col("ante_freq") / n
    cons_sup = F.col("cons_freq") / n
    conf = support / ante_sup
    return j.select(
        SCOPE, "antecedents", "consequents", ante_sup.alias("antecedent_support"), cons_sup.alias("consequent_support"),
        support.alias("support"), conf.alias("confidence"), (conf / cons_sup).alias("lift"), "freq", "n_baskets")


def adaptive_multi_item_rules(
    items: DataFrame,
    max_rules: int = MAX_RULES,
    min_confidence: float = MIN_CONFIDENCE,
    floor: float = SUPPORT_FLOOR,
    tries: int = MAX_TRIES,
    decay: float = DECAY,
) -> DataFrame:
    """Top ``max_rules`` rules of any size per scope, at the support level that :func:`adaptive_rules`
    describes: itemsets are mined once at each scope's lowest level, and a rule's count says from
    which level on it qualifies."""
    levels = local_figures(scope_levels(items, floor, tries, decay))
    lowest = levels.select(SCOPE, F.array_min(F.transform(F.filter("levels", lambda x: x["valid"]), lambda x: x["level_support"])).alias("s"))
    sets = frequent_itemsets(items, {r[SCOPE]: r["s"] for r in lowest.collect()})
    rules = multi_item_rules(sets, min_confidence)
    rules = rules.withColumnRenamed("antecedents", "antecedent").withColumnRenamed("consequents", "consequent").withColumnRenamed("freq", "pair_count")
    return _top_at_level(rules, levels, max_rules).withColumnRenamed("antecedent", "antecedents").withColumnRenamed("consequent", "consequents")


def upsert_rules(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Idempotent append: a rule row replaces an existing one with the same (territory, window,
    update date, antecedents, consequents); NULL territory / window compare equal."""
    keys = ["territory_id", "window", "update_at", "antecedents", "consequents"]
    k = new.select(*[F.col(c).alias(f"_sm_{c}") for c in keys]).distinct()
    cond = None
    for c in keys:
        e = F.col(c).eqNullSafe(F.col(f"_sm_{c}"))
        cond = e if cond is None else cond & e
    kept = existing.join(k, cond, "left_anti")
    return kept.unionByName(new)

