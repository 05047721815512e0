import random
import zlib

import pytest
from pyspark.sql import functions as F

from starmart import session
from starmart.llm import components, decontaminate, jaccard_join, line_dedup
from starmart.llm.components import connected_components


def words(rng, n, vocabulary=4000):
    return ["w%d" % rng.randrange(vocabulary) for _ in range(n)]


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def near_copies(seed, sizes=(3, 6, 9, 12, 20, 40, 120, 700)):
    rng, docs = random.Random(seed), []
    passage = words(rng, 14)
    for n in sizes:
        base = words(rng, n)
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randint(0, 1 + n // 60)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], ["x%d" % rng.randrange(99)], [w[k], "y"]])
            docs.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
        for _ in range(6):  # short texts that share a passage only
            docs.append(" ".join(passage + words(rng, rng.randint(1, 14))))
    docs += [None, "", " \n\t ", "one", "one", "One", "a b c d", docs[0], docs[0]]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    docs = near_copies(seed)
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, n long, node string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(df).collect()}
    assert got == brute_components(docs)


def test_jaccard_groups_are_opened(spark, monkeypatch):
    """Without local groups' links and with one first node per hash the matrix has to find the rest."""
    monkeypatch.setattr(jaccard_join, "FIRST_NODES", 1)
    docs = near_copies(7, sizes=(30, 31, 32, 200))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(df).collect()}
    assert got == brute_components(docs)


def test_prefixes_lose_no_link():
    rng, shared, similar = random.Random(11), 0, 0
    for _ in range(1500):
        n = rng.choice([4, 5, 6, 7, 8, 10, 12, 15, 16, 19, 20, 24, 25, 30, 64, 520])
        a = {rng.randrange(1 << 60) for _ in range(n)}
        b = set(rng.sample(sorted(a), len(a) - rng.randint(0, max(1, n // 8)))) | {rng.randrange(1 << 60) for _ in range(rng.randint(0, max(1, n // 8)))}
        if a != b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = (jaccard_join.np.array(sorted(s), jaccard_join.np.int64) for s in (a, b))
            similar += 1
            some = jaccard_join.np.array(sorted(rng.sample(sorted(a | b), len(a) // 2) + [5, 1 << 61]), jaccard_join.np.int64)  # any order will do
            order = some, jaccard_join.np.array(rng.sample(range(len(some)), len(some)))
            shared += all(set(jaccard_join.prefix_tokens(x, *o).tolist()) & set(jaccard_join.prefix_tokens(y, *o).tolist()) for o in (order, (some[:0], some[:0])))
            assert len(jaccard_join.prefix_tokens(x, *order)) == len(x) - -(-80 * len(x) // 100) + 1
            differ = sum(bin((p ^ q) & (2**64 - 1)).count("1") for p, q in zip(jaccard_join.parity_bits(x), jaccard_join.parity_bits(y), strict=True))
            assert differ <= len(a ^ b)
    assert shared == similar > 300


def test_shared_shingles_stream(spark):
    """Runs of a shingle that go over batches of a few rows."""
    rng = random.Random(12)
    pairs = [(rng.randrange(40), rng.randrange(12)) for _ in range(150)] + [(99, g) for g in range(30)] + [(100, 5)] * 20
    doc = "doc struct<doc_id: long, text_key: long, n: long, node: long, b0: long, b1: long, b2: long, b3: long>"
    rows = spark.createDataFrame([(k, g, None) for k, g in pairs] + [(7, 1, (1, 2, 3, 4, 5, 6, 7, 8))], f"key long, grp long, {doc}")
    holders = {}
    for k, g in pairs:
        holders.setdefault(k, set()).add(g)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 2, 7, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = jaccard_join._shared(rows, 3).collect()
            assert sorted((r["key"], r["grp"]) for r in got if r["doc"] is None) == sorted((k, g) for k, gs in holders.items() if len(gs) > 1 for g in gs)
            assert sum(r["doc"] is not None for r in got) == 1
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_jaccard_long_documents_and_a_loose_family(spark, monkeypatch):
    """Documents of 20,000 words; and a family whose members are at 0.8 of each other about as often as not, asked in small groups."""
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 8)
    monkeypatch.setattr(jaccard_join, "TASK_QUERIES", 5)
    monkeypatch.setattr(jaccard_join, "FREQUENT_COUNT", 2)
    rng = random.Random(13)
    base, long = words(rng, 150), words(rng, 20_000)
    docs = []
    for _ in range(260):
        w = list(base)
        for k in rng.sample(range(150), rng.choice([1, 2, 3, 4, 5, 6])):
            w[k] = f"z{rng.randrange(10**6)}"
        docs.append(" ".join(w))
    for share in (0, 100, 300, 900, 4000):
        w = list(long)
        for k in rng.sample(range(20_000), share):
            w[k] = "y"
        docs.append(" ".join(w))
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(df).collect()}
    assert got == brute_components(docs) and len({c for _, c in got.values()}) > 3


def test_jaccard_loose_family_is_asked_in_blocks(spark, monkeypatch):
    """A family without links whose members all share shingles: questions grow with its members, not with their square."""
    rng, written, write = random.Random(17), [], jaccard_join.materialize

    def counted(df, name):
        out = write(df, name)
        if name == "jaccard_asks":
            written.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", counted)
    base, docs = words(rng, 150), []
    for _ in range(120):
        w = list(base)
        for k in rng.sample(range(150), rng.randint(4, 5)):
            w[k] = f"z{rng.randrange(10**6)}"
        docs.append(" ".join(w))
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(df).collect()}
    assert got == brute_components(docs) and len({c for _, c in got.values()}) > 110
    assert 0 < sum(written) < 20 * len(docs), written


def test_sketches_bound_the_difference():
    np, rng = jaccard_join.np, random.Random(18)
    for n, m in ((1, 1), (4, 5), (31, 33), (60, 70), (400, 410), (500, 520), (3000, 2700)):
        a = {rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)}
        b = set(rng.sample(sorted(a), min(n, m) * 9 // 10)) | {rng.randrange(-(1 << 63), 1 << 63) for _ in range(m // 10)}
        x, y = (np.frombuffer(jaccard_join.sketch(np.array(sorted(s), np.int64)), np.uint64) for s in (a, b))
        assert 2 * n <= 64 * len(x) <= max(64, 4 * n)
        while len(x) != len(y):
            x, y = (jaccard_join.folded(x), y) if len(x) > len(y) else (x, jaccard_join.folded(y))
        differ = int(np.bitwise_count(x ^ y).sum())
        assert differ <= len(a ^ b) and differ % 2 == len(a ^ b) % 2 and (n < 30 or differ > len(a ^ b) * 0.7)


def test_repeated_shingles_equal_counts():
    np, rng = jaccard_join.np, random.Random(19)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(60)] + [None, ""]
    sets = {tuple(jaccard_join.shingle_set(t).tolist()) for t in texts}
    holders = {}
    for s in sets:
        for token in s:
            holders[token] = holders.get(token, 0) + 1
    value, count = jaccard_join._repeated(jaccard_join.pa.array(texts))
    assert dict(zip(value.tolist(), count.tolist(), strict=True)) == {t: n for t, n in holders.items() if n > 1} and (np.diff(value) > 0).all()
    assert [len(x) for x in jaccard_join._repeated(jaccard_join.pa.array([None, "a"]))] == [0, 0]


def test_jaccard_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (2, "A B c d e f"), (9, None), (9, None)], "doc_id long, text string")
    got = sorted(jaccard_join.components(df).collect(), key=str)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(None, 2), (4, 2), (2, 2), (9, 9)} and len(got) == 5
    kept = jaccard_join.keep_first(df).collect()
    assert sorted((str(r["doc_id"]) for r in kept)) == ["2", "9", "9", "None"]
    assert jaccard_join.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("one_task", [0, 500_000])
def test_components_of_chain_star_and_ring(spark, monkeypatch, one_task):
    monkeypatch.setattr(components, "ONE_TASK_LINKS", one_task)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    df = spark.createDataFrame([*links, *links[:5]], "x long, y long")
    got = {r["node"]: r["root"] for r in connected_components(df, "x", "y").collect()}
    want = {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 130)} | {201: 200, 202: 200}
    assert got == want
    assert connected_components(df.limit(0), "x", "y").count() == 0


def test_contained_items_equal_brute_force(spark):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, n))) for k, n in enumerate([16, 20, 30, 40, 59])] + [(90, ""), (91, None), (92, "one two"), (93, "one two")]
    docs = []
    for i in range(120):
        w = words(rng, rng.choice([0, 3, 40, 400, 3000]))
        if i % 3 == 0:
            t = rng.choice(items[:5])[1].split()
            cut = rng.randint(0, len(t) // 4)
            w[len(w) // 2 : len(w) // 2] = t[cut:]
        docs.append((i, " ".join(w)))
    docs += [(500, None), (501, "One  two"), (502, "one two three")]
    want = set()
    for i, t in docs:
        for k, u in items:
            a, b = shingles(u), shingles(t)
            if a and 100 * len(a & b) >= 80 * len(a):
                want.add((i, k, len(a), len(a & b)))
    d = spark.createDataFrame([(*x, "z") for x in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"], r["n_item_shingles"], r["n_shared"]) for r in decontaminate.find_items(d, b).collect()}
    assert got == want and len(want) > 20
    clean = {r["doc_id"] for r in decontaminate.remove_contaminated(d, b).collect()}
    assert clean == {i for i, _ in docs} - {i for i, *_ in want}
    assert decontaminate.find_items(d.limit(0), b).count() == 0 and decontaminate.find_items(d, b.limit(0)).count() == 0


def test_containment_by_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    d = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(100)))], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(f"a{i}" for i in range(30, 60)))], "item_id long, text string")
    assert [tuple(r)[2:] for r in decontaminate.find_items(d, b, rounds=2).collect()] == [(7, 26, 26)]


def test_patience_blocks():
    f = line_dedup.aligned_blocks
    assert f([1, 2, 3], [1, 2, 3]) == [(0, 0, 3)]
    assert f([1, 2, 3], []) == [] == f([], [1])
    assert f([1, 9, 2, 3], [1, 2, 3, 8]) == [(0, 0, 1), (2, 1, 2)]
    assert f([5, 1, 1, 2, 7], [6, 1, 1, 2, 8]) == [(1, 1, 3)]
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(12) for _ in range(rng.randint(0, 30))] for _ in "ab")
        blocks = f(a, b)
        ends = (0, 0)
        for i, j, n in blocks:
            assert a[i : i + n] == b[j : j + n] and n and i >= ends[0] and j >= ends[1]
            ends = (i + n, j + n)
        once = [x for x in a if a.count(x) == 1 and b.count(x) == 1]
        if len(once) == 1:  # a single line that is unique on both sides is aligned
            assert any(i <= a.index(once[0]) < i + n for i, _, n in blocks) or blocks


def sentence(rng, n):
    return " ".join(words(rng, n))


def test_line_dedup_deletes_from_later_documents_only(spark):
    rng = random.Random(8)
    passage, short = sentence(rng, 55), "home page menu"
    a, b, c = ([sentence(rng, 12) for _ in range(4)] for _ in "abc")
    lines = {
        1: [*a, passage, short], 2: [b[0], passage, *b[1:], short], 3: list(reversed(c)), 4: [*a, passage, short],
        5: [c[0], short, a[1], a[2], a[3]], 6: [short], 7: [],
    }
    crowd = {100 + k: [sentence(rng, 20), passage, sentence(rng, 15)] for k in range(20)}  # a line of far more than RARE_DOCS documents
    docs = [(i, "\n".join(x), "src") for i, x in (lines | crowd).items()] + [(8, None, "n"), (9, "\n".join(a), "r"), (9, "\n".join(a), "r")]
    df = spark.createDataFrame(docs, "doc_id long, text string, deleted_lines string").repartition(3)
    out = line_dedup.delete_blocks(df.select("doc_id", "text", F.col("deleted_lines").alias("source")))
    got = {r["doc_id"]: (r["text"], r["deleted_lines"]) for r in out.collect()}
    assert got[1] == ("\n".join(lines[1]), 0) and got[3] == ("\n".join(lines[3]), 0) and got[6] == (short, 0) and got[7] == ("", 0) and got[8] == (None, 0)
    assert got[2] == ("\n".join([b[0], *b[1:], short]), 1)
    assert got[4] == ("", 6) and got[9] == ("", 4)
    assert got[5] == ("\n".join([c[0], short]), 3)
    for i, x in crowd.items():
        assert got[i] == ("\n".join([x[0], x[2]]), 1)
    assert out.count() == len(docs) and out.columns == ["doc_id", "text", "source", "deleted_lines"]
    assert line_dedup.delete_blocks(df.limit(0).select("doc_id", "text")).count() == 0


def test_every_first_line_stays(spark):
    rng = random.Random(21)
    pool = [sentence(rng, rng.randint(3, 25)) for _ in range(60)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.delete_blocks(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {x for _, t in docs for x in t.split("\n")} == {x for t in out.values() for x in t.split("\n") if x}
    assert sum(zlib.crc32(out[i].encode()) != zlib.crc32(t.encode()) for i, t in docs) > 0


def deduped(spark, docs):
    """Ids to what is left of each document's lines."""
    rows = [(i, "\n".join(x)) for i, x in docs.items()]
    out = line_dedup.delete_blocks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    return {r["doc_id"]: r["text"].split("\n") if r["text"] else [] for r in out.collect()}


def all_pairs(docs):
    """Each document aligned with every earlier one."""
    left = {}
    for d, x in docs.items():
        gone = set()
        for e in (e for e in docs if e < d):
            for _, s, n in line_dedup.aligned_blocks(docs[e], x):
                if sum(len(y.split()) for y in x[s : s + n]) >= line_dedup.BLOCK_WORDS:
                    gone.update(range(s, s + n))
        left[d] = [y for k, y in enumerate(x) if k not in gone]
    return left


def test_frequent_lines_whose_first_holder_lacks_the_passage(spark):
    rng = random.Random(31)
    passage, own = [sentence(rng, 10) for _ in range(6)], lambda: sentence(rng, 12)
    later = {10 + k: [own(), *passage, own()] for k in range(9)}
    scattered = {0: [y for x in passage for y in (x, own())]}
    single = {k: [own(), passage[k], own()] for k in range(6)}
    for first in (scattered, single):
        docs = first | later
        got = deduped(spark, docs)
        assert got == first | {10: later[10]} | {i: [x[0], x[-1]] for i, x in later.items() if i > 10} == all_pairs(docs)


def test_frequent_passages_in_other_orders(spark):
    rng = random.Random(32)
    parts, own = [[sentence(rng, 20) for _ in range(2)] for _ in range(5)], lambda: sentence(rng, 12)
    docs = {}
    for i in range(30):
        docs[i] = [own()]
        for k in rng.sample(range(5), 5):
            docs[i] += [*parts[k], own()]
    assert deduped(spark, docs) == all_pairs(docs)


def test_passages_whose_lines_all_repeat(spark):
    rng = random.Random(33)
    f = line_dedup.aligned_blocks
    assert f([8, 1, 2, 1, 2, 9], [5, 6, 1, 2, 1, 2, 7]) == [(1, 2, 4)]
    assert f([8, 1, 2, 1, 2, 9], [1, 2, 7]) == [(1, 0, 2)]
    passage, own = [sentence(rng, 10) for _ in range(6)], lambda: sentence(rng, 12)
    docs = {k: passage * 2 for k in range(10)} | {20 + k: [own(), *passage, *passage, own()] for k in range(10)}
    got = deduped(spark, docs)
    assert got == {k: passage * 2 if k == 0 else [] for k in range(10)} | {i: [x[0], x[-1]] for i, x in docs.items() if i >= 20}
    assert deduped(spark, {1: passage[:2] * 2, 2: passage[:2] * 2}) == {1: passage[:2] * 2, 2: []}


def test_more_copies_than_the_first_holder_has(spark):
    rng = random.Random(34)
    passage, own = [sentence(rng, 10) for _ in range(6)], lambda: sentence(rng, 12)
    once = {k: [own(), *passage, own()] for k in range(9)}
    twice = {20 + k: [own(), *passage, own(), *passage, own()] for k in range(9)}
    got = deduped(spark, once | twice)
    assert got[0] == once[0] and all(got[k] == [once[k][0], once[k][-1]] for k in range(1, 9))
    assert len(got[20]) == 9 and all(got[k] == [twice[k][0], twice[k][7], twice[k][-1]] for k in range(21, 29))


def test_passages_of_short_lines(spark):
    rng = random.Random(35)
    own = lambda: sentence(rng, 12)
    verse = [sentence(rng, 4) for _ in range(20)]
    mixed = [sentence(rng, 7) if k % 6 == 0 else sentence(rng, 4) for k in range(9)]
    han = ["".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(40)) + "\u3002" for _ in range(3)]
    for passage in (verse, mixed, han):
        for n in (2, 6, 7, 10):
            docs = {k: [own(), *passage, own()] for k in range(n)}
            assert deduped(spark, docs) == {k: x if k == 0 else [x[0], x[-1]] for k, x in docs.items()}
    docs = {k: [own(), *verse[:7], own(), han[0], own()] for k in range(10)}  # 28 and 20 words: too little
    assert deduped(spark, docs) == docs


def test_short_items_are_found_exactly(spark, monkeypatch):
    rng = random.Random(36)
    items = {k: words(rng, 5 + k % 10) for k in range(120)}
    docs = [(k, " ".join([*words(rng, 300), *w, *words(rng, 300)])) for k, w in items.items()]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(900, ""), (901, None)], "item_id long, text string")
    for rows in (decontaminate.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
        got = {(r["doc_id"], r["item_id"], r["n_shared"]) for r in decontaminate.find_items(d, b).collect()}
        assert got == {(k, k, len(w) - 4) for k, w in items.items()}


def test_keep_first_on_repeated_ids(spark):
    rng = random.Random(37)
    x, y, z = (" ".join(words(rng, 30)) for _ in "xyz")
    rows = [(1, x, "a"), (5, x, "b"), (5, y, "c"), (6, z, "d"), (6, z, "d"), (7, z.upper(), "e"), (8, "", "f"), (8, "", "f"), (9, y.upper(), "g"), (9, y, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = jaccard_join.keep_first(df)
    assert kept.columns == df.columns and sorted(r["source"] for r in kept.collect()) == ["a", "c", "d", "f", "f"]
    twice = spark.createDataFrame([(3, x, "i"), (3, x.upper(), "j")], df.schema)
    assert jaccard_join.keep_first(twice).count() == 1


def test_small_tables_of_the_join_have_few_files(spark, monkeypatch):
    docs = near_copies(5)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    written, real = [], session.materialize

    def noted(df, name):
        written.append((name, real(df, name)))
        return written[-1][1]

    monkeypatch.setattr(jaccard_join, "materialize", noted)
    monkeypatch.setattr(components, "materialize", noted)
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 40)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(df).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_components(docs)
    files = {name: len(table.inputFiles()) for name, table in written if name != "jaccard_wanted"}
    assert {"jaccard_rows", "jaccard_open", "jaccard_likely", "jaccard_links", "links"} <= set(files)
    assert all(n <= spark.sparkContext.defaultParallelism for n in files.values()), files


def test_a_written_table_keeps_all_rows_in_files_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 10)
    df = spark.range(1000).repartition(90)
    for rows, most in ((1000, 90), (400, 40), (0, spark.sparkContext.defaultParallelism)):
        table = session.materialize(session.few_files(df, rows), "few_files")
        assert len(table.inputFiles()) <= most and table.count() == 1000 and table.distinct().count() == 1000
