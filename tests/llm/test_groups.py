"""Spelling variants, repeated byte strings and centroids against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from starmart.llm import centroids, spelling, suffix_dedup


def _cut(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])))
        out.append((list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)), bytes(b for b, g in zip(r, gone, strict=False) if not g)))
    return out


def _texts(rng, n):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    passages = [" ".join(rng.choices(words, k=rng.randint(20, 90))) for _ in range(6)]
    base, texts = rng.choices(words, k=150), []
    for i in range(n):
        kind, t = i % 6, rng.choices(words, k=rng.randint(5, 120))
        if kind == 1:
            t = [*t, rng.choice(passages), *rng.choices(words, k=20)]
        elif kind == 2:  # near copies
            t = [w if rng.random() > 0.04 else rng.choice(words) for w in base]
        elif kind == 3 and i > 20:
            t = [texts[rng.randrange(i)] or ""]
        elif kind == 4:
            t = [passages[0], "x", passages[0][: rng.randint(10, 300)]]
        texts.append(" ".join(t))
    return texts


SPECIAL = [None, "", "a", "x" * 5000, "x" * 700 + "y" + "x" * 650, "ab" * 900, "é" * 300, "🙂é" * 120, "q" * 199, "q" * 200, "z" * 200, "z" * 200, "\x00" * 450]


def test_interval_expansion_against_brute_force():
    rng = random.Random(3)
    for length in (3, 8, 40):
        for _ in range(25):
            texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))).encode() for _ in range(rng.randint(1, 12))] + [b"a" * rng.randint(0, 90)]
            seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
            repeated, classes = suffix_dedup.repeated_windows(texts, length)
            name = {}
            for t, flags, cls in zip(texts, repeated, classes, strict=True):
                assert flags.tolist() == [seen[t[i : i + length]] > 1 for i in range(len(t) - length + 1)]
                for i, c in enumerate(cls.tolist()):
                    assert name.setdefault(c, t[i : i + length]) == t[i : i + length]
            assert len(name) == len(seen)


def test_contexts_hold_every_window_under_its_smallest_hash():
    rng = random.Random(4)
    raw = ("".join(rng.choice("abc ") for _ in range(4000)) + "a" * 3000 + "abc" * 700).encode()
    least = suffix_dedup._sliding(suffix_dedup._gram_hashes(np.frombuffer(raw, np.uint8)), 200 - suffix_dedup.GRAM + 1, np.minimum)
    finer_of = {}
    for segment in (1 << 20, 777):
        places = []
        for columns in suffix_dedup.contexts_of(raw, 200, segment):
            for a, i, j, two, first in zip(*(c.tolist() for c in columns), strict=True):
                assert set(least[i : j + 1].view(np.int64).tolist()) == {a}
                places += range(i, j + 1)
                inside = [raw[k : k + 200] for k in range(i, j + 1)]
                assert two or len(set(inside)) == len(inside)
                finer = list(suffix_dedup.finer_contexts(raw, 200, a, i, j, two, first))
                assert sorted(k for _, x, y in finer for k in range(x, y + 1)) == list(range(i, j + 1))
                for f, x, y in finer:  # equal windows have equal finer anchors, and a finer context has none twice
                    assert len({raw[k : k + 200] for k in range(x, y + 1)}) == y - x + 1
                    for k in range(x, y + 1):
                        assert finer_of.setdefault(raw[k : k + 200], f) == f
        assert places == list(range(len(raw) - 199))


@pytest.mark.parametrize("limits", [{}, {"in_batch": 1, "hot_contexts": 4}, {"block_bytes": 3000}])
def test_repeated_strings_are_cut(spark, limits):
    texts = _texts(random.Random(7), 150) + SPECIAL
    df = spark.createDataFrame([(i % 140 if i % 9 else None, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, copies int").repartition(7)
    got = suffix_dedup.remove_repeats(df, **limits).collect()
    show = lambda doc_id, spans, kept: (-1 if doc_id is None else doc_id, spans, bytes(kept))
    want = [show(i % 140 if i % 9 else None, spans, kept) for i, (spans, kept) in enumerate(_cut(texts, 200))]
    assert sorted(show(r["doc_id"], [(x["from"], x["to"]) for x in r["spans"]], r["kept"]) for r in got) == sorted(want)
    assert sum(len(s) for _, s, _ in want) > 60
    assert suffix_dedup.remove_repeats(df.limit(0), **limits).count() == 0


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_spelling_against_brute_force(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choice(["th", "in", "er", "a", "é", "ÿ", "on", "oo"]) for _ in range(rng.randint(2, 6))) for _ in range(60)] + ["aaaaaaa", "aaaaaa", "abababab", "b" * 400]
    def bent(w):
        i, c = rng.randrange(len(w)), rng.choice("abinÀ×")
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
    rows = []
    for i in range(300):
        words = [rng.choice(stems[: rng.randint(1, len(stems))]) for _ in range(40)]
        words = [bent(w) if rng.random() < 0.4 else w.upper() if rng.random() < 0.1 else w for w in words]
        rows.append((i % 280 if i % 11 else None, rng.choice([" ", "-", "1", "\n"]).join(words) if i % 13 else rng.choice([None, "", " "]), i))
    count = Counter()
    for doc_id, text, _ in rows:
        for run in spelling.RUN.findall((text or "")):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in count if _near(w, v)] for w in count}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 2 * count[w] else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    df = spark.createDataFrame(rows, "doc_id long, text string, word int").repartition(5)
    got = {r["word"]: r for r in spelling.variants(df, every=7).collect()}
    assert set(got) == set(count) and len(count) > 200 and sum(map(len, near.values())) > 300
    for w, r in got.items():
        assert (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) == (count[w], len(near[w]), form[w], count.get(form[w]), root(w)), w
    assert spelling.variants(df.limit(0)).count() == 0


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(6)
    for _ in range(300):
        prefix = sorted((rng.randrange(40), p) for p in rng.sample(range(9), 3))
        weight = [rng.randrange(50) for _ in range(40)]
        at = {p: weight[r] for r, p in prefix}
        chosen = spelling.pivot_positions(prefix, weight)
        assert abs(chosen[0] - chosen[1]) >= 2
        assert sum(at[p] for p in chosen) == min(at[p] + at[q] for p in at for q in at if abs(p - q) >= 2)


def test_long_word(spark):
    df = spark.createDataFrame([(i, "a" * 10_000 + "b" * (i % 2) + " abcdefgh" * 3) for i in range(8)], "doc_id long, text string")
    got = {len(r["word"]): r for r in spelling.variants(df, every=1 << 40).collect()}
    assert got[10_000]["n_near"] == got[10_001]["n_near"] == 1 and got[8]["n"] == 24


def test_centroids_against_numpy(spark):
    rng = np.random.default_rng(8)
    good = [(i % 190 if i % 17 else None, [float(x) for x in rng.normal(size=4)]) for i in range(200)] + [(500, [1e30, -1e30, 0.0, 0.0]), (7, [1.0, 1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0, 1.0])]
    bad = [(600, None), (601, [1.0, 2.0]), (602, [1.0, None, 0.0, 0.0]), (603, [float("nan"), 0.0, 0.0, 0.0]), (604, [float("inf"), 0.0, 0.0, 0.0]), (605, [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 3) for i, v in good + bad], "vec_id long, embedding array<double>, cluster int").repartition(6)
    limit = centroids.LARGEST
    q = [[int(np.clip(np.floor(1024 * x), -limit, limit)) for x in v] for _, v in good]
    name = [hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest() for i, _ in good]
    cs = [q[j] for j in sorted(range(len(q)), key=lambda j: (name[j], q[j]))[:5]]
    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(cs)) for v in q]
    for _ in range(6):
        of = [k for _, k in assign()]
        for k in range(5):
            mine = [v for v, j in zip(q, of, strict=True) if j == k]
            if mine:
                cs[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    got, found = centroids.cluster(df, dim=4, k=5, rounds=6)
    assert found == cs
    want = sorted((-1 if i is None else i, k, d) for (i, _), (d, k) in zip(good, assign(), strict=True))
    rows = centroids.with_inertia(got, found).collect()
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in rows) == want
    assert {r["inertia"] for r in rows} == {sum(d for _, _, d in want)}
    assert {(r["cluster"], r["centroid_sha256"]) for r in rows} == {(k, hashlib.sha256(",".join(map(str, cs[k])).encode()).hexdigest()) for k in {k for _, k, _ in want}}
    assert centroids.with_inertia(*centroids.cluster(df.limit(0), dim=4)).count() == 0
    assert len(centroids.cluster(df.filter("vec_id = 7"), dim=4, k=9)[1]) == df.filter("vec_id = 7 AND size(embedding) = 4").count()
