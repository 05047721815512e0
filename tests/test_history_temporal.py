import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.history import OPEN_END, dedupe_changes, latest_per_key, scd2_from_history, scd2_merge
from starmart.operators.sequence import dense_ids, with_forward_fill, with_neighbors
from starmart.operators.temporal import pit_join, temporal_join

D0 = dt.datetime(2024, 1, 1)
END = dt.datetime.fromisoformat(OPEN_END)


def day(n, h=0):
    return D0 + dt.timedelta(days=n, hours=h)


def test_latest_per_key_tiebreak(spark):
    df = spark.createDataFrame([(1, day(0), 1, "a"), (1, day(1), 2, "b"), (1, day(1), 3, "c")],
                               "k long, t timestamp_ntz, tb long, v string")
    assert latest_per_key(df, "k", "t", "tb").first().v == "c"


def test_dedupe_changes_cases(spark):
    rows = [(1, day(0), "A"), (1, day(1), "A"), (1, day(2), "B"), (1, day(3), "A"),
            (2, day(0), "X"), (3, day(0), "Y"), (2, day(1), "X"), (3, day(1), "Z"),
            (4, day(0), None), (4, day(1), None)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v string")
    out = sorted((r.k, r.t, r.v) for r in dedupe_changes(df, "k", "t", ["k", "v"]).collect())
    assert out == [(1, day(0), "A"), (1, day(2), "B"), (1, day(3), "A"), (2, day(0), "X"),
                   (3, day(0), "Y"), (3, day(1), "Z"), (4, day(0), None)]


def test_neighbors_match_plain_window_on_hot_key(spark, monkeypatch):
    from starmart.operators import sequence
    monkeypatch.setattr(sequence, "HOT_KEY_ROWS", 500)   # key 0 (~60% of rows) is hot, the others are not
    random.seed(7)
    rows = [(0 if random.random() < 0.6 else random.randint(1, 5), day(random.randint(0, 40), random.randint(0, 23)), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, id long")
    got = with_neighbors(df, ["k"], ["t", "id"], ["id"], prev="p", next="n").select("id", "p.id", "n.id")
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.select("id", F.lag("id").over(w), F.lead("id").over(w))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    v = df.withColumn("v", F.when(F.col("id") % 7 == 0, F.col("id")))
    ff = with_forward_fill(v, ["k"], ["t", "id"], "v", "f").select("id", "f")
    expf = v.select("id", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(tuple, ff.collect())) == sorted(map(tuple, expf.collect()))


def test_dense_ids_match_dense_rank(spark):
    df = spark.createDataFrame([(x % 37, str(x % 5)) for x in range(500)], "a long, b string")
    got = {(r.a, r.b): r.i for r in dense_ids(df, ["a", "b"], "i").collect()}
    exp = {(r.a, r.b): r.i for r in df.select("a", "b", F.dense_rank().over(Window.orderBy("a", "b")).alias("i")).distinct().collect()}
    assert got == exp


def _history(spark, rows):
    return spark.createDataFrame(rows, "k long, t timestamp_ntz, tb long, v string")


def test_scd2_tiles_and_merge_equals_rebuild(spark, monkeypatch):
    from starmart.operators import sequence
    monkeypatch.setattr(sequence, "HOT_KEY_ROWS", 40)
    random.seed(3)
    rows = [(random.randint(1, 6), day(random.randint(0, 60), random.randint(0, 23)), i, random.choice("ab"))
            for i in range(400)]
    full = _history(spark, rows)
    rebuilt = scd2_from_history(dedupe_changes(full, "k", "t", ["k", "v"], "tb"), "k", "t", "tb")
    # versions tile [first, open end) per key
    by_key = {}
    for r in rebuilt.collect():
        by_key.setdefault(r.k, []).append((r.valid_from, r.valid_to))
    for spans in by_key.values():
        spans.sort()
        assert spans[-1][1] == END
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for split in (day(10), day(30), day(59)):
        cur = scd2_from_history(dedupe_changes(full.filter(F.col("t") < split), "k", "t", ["k", "v"], "tb"), "k", "t", "tb")
        merged = scd2_merge(cur, full.filter(F.col("t") >= split), "k", "t", ["k", "v"], "tb")
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, rebuilt.select(*merged.columns).collect()))


def test_scd2_merge_cases(spark):
    cur = scd2_from_history(dedupe_changes(_history(spark, [(1, day(5), 1, "a"), (2, day(5), 2, "a"), (3, day(5), 3, "a")]),
                                           "k", "t", ["k", "v"], "tb"), "k", "t", "tb")
    batch = _history(spark, [(1, day(6), 4, "b"),                       # newer -> close + insert
                             (2, day(4), 5, "z"),                       # older -> ignored
                             (3, day(6), 6, "b"), (3, day(7), 7, "c"),  # two versions chained
                             (9, day(1), 8, "n")])                      # new key
    got = sorted((r.k, r.v, r.valid_from, r.valid_to) for r in scd2_merge(cur, batch, "k", "t", ["k", "v"], "tb").collect())
    assert got == [(1, "a", day(5), day(6)), (1, "b", day(6), END), (2, "a", day(5), END),
                   (3, "a", day(5), day(6)), (3, "b", day(6), day(7)), (3, "c", day(7), END), (9, "n", day(1), END)]


def _iv(spark, rows, attr="a"):
    return spark.createDataFrame(rows, f"k long, valid_from timestamp_ntz, valid_to timestamp_ntz, {attr} string")


def test_temporal_join_gaps(spark):
    left = _iv(spark, [(1, day(0), day(10), "L1"), (None, day(0), day(10), "LN"), (2, day(0), day(10), "L2")], "x")
    right = _iv(spark, [(1, day(2), day(4), "r1"), (1, day(6), day(8), "r2"), (1, day(10), day(12), "touch"),
                        (2, day(20), day(30), "late")])
    keep = sorted(((r.x, r.R__a, r.valid_from, r.valid_to) for r in temporal_join(left, right, "k", "k", ["a"], "R", "keep").collect()), key=str)
    assert keep == sorted([("L1", None, day(0), day(2)), ("L1", "r1", day(2), day(4)), ("L1", None, day(4), day(6)),
                           ("L1", "r2", day(6), day(8)), ("L1", None, day(8), day(10)),
                           ("LN", None, day(0), day(10)), ("L2", None, day(0), day(10))], key=str)
    drop = temporal_join(left, right, "k", "k", ["a"], "R", "drop")
    assert drop.filter("x = 'L1'").count() == 2 and drop.count() == 4


def test_temporal_join_null_attribute_not_inherited(spark):
    left = _iv(spark, [(1, day(0), day(10), "L")], "x")
    right = _iv(spark, [(1, day(0), day(5), "old"), (1, day(5), day(10), None)])
    got = sorted(((r.valid_from, r.R__a) for r in temporal_join(left, right, "k", "k", ["a"], "R").collect()), key=str)
    assert got == [(day(0), "old"), (day(5), None)]


def test_pit_join_bounds_both_strategies(spark, monkeypatch):
    from starmart.operators import sequence
    monkeypatch.setattr(sequence, "HOT_KEY_ROWS", 1)
    dim = _iv(spark, [(1, day(1), day(5), "v1"), (1, day(5), END, "v2")])
    facts = spark.createDataFrame([(1, day(1), "at_from"), (1, day(5), "at_to"), (1, day(0), "before"), (2, day(3), "nokey")],
                                  "k long, at timestamp_ntz, name string")
    for strategy in ("join", "asof"):
        inner = {r.name: r.a for r in pit_join(facts, dim, "k", "at", ["a"], strategy=strategy).collect()}
        assert inner == {"at_from": "v1", "at_to": "v2"}, strategy
        left = {r.name: r.a for r in pit_join(facts, dim, "k", "at", ["a"], how="left", strategy=strategy).collect()}
        assert left == {"at_from": "v1", "at_to": "v2", "before": None, "nokey": None}, strategy


def test_temporal_join_ranked_equals_join(spark, monkeypatch):
    from starmart.operators import sequence
    monkeypatch.setattr(sequence, "HOT_KEY_ROWS", 10)
    random.seed(11)
    right_rows = []
    for k in range(4):
        t = 0
        for _ in range(random.randint(0, 25 if k == 0 else 4)):
            t += random.randint(0, 3)          # gaps allowed
            length = random.randint(1, 4)
            right_rows.append((k, day(t), day(t + length) if random.random() < 0.9 else END, random.choice(["p", "q", None])))
            t += length
            if right_rows[-1][2] == END:
                break
    left_rows = [(random.choice([0, 0, 1, 2, 3, None]), day(a), day(a + random.randint(1, 30)), f"l{i}")
                 for i, a in enumerate(random.randint(0, 60) for _ in range(120))]
    left, right = _iv(spark, left_rows, "x"), _iv(spark, right_rows)
    for gaps in ("keep", "drop"):
        a = temporal_join(left, right, "k", "k", ["a"], "R", gaps, strategy="join")
        b = temporal_join(left, right, "k", "k", ["a"], "R", gaps, strategy="ranked")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect())), gaps
