import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starmart.llm import bpe, queries, sharding, url_filter

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [None, "", " ", "it's  a\n\n test", "x" * 3000, "1234 abc'd 12.5%", "naïve déjà-vu 東京 🙂🙂", "a b\tc \n d" * 40, "\x1c\x1d word x  y", "'re 's'st don't"]


def test_bpe_round_trip_and_cuts(spark):
    enc = bpe.codec(RANKS, PATTERN)
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(["ab", " ", "\n", "'s", "9", "é", " ", "!", "The", "\x1c"]) for _ in range(300))
        assert "".join(bpe.parts(text, 20)) == text
        assert bpe.encode_text(enc, text, 20) == enc.encode_ordinary(text)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    ids = bpe.encode(df, RANKS, PATTERN, part_chars=16)
    both = bpe.decode(ids, RANKS, PATTERN, keep=("doc_id", "ids")).collect()
    assert len(both) == len(TEXTS)
    for r in both:
        assert r["ids"] == enc.encode_ordinary(TEXTS[r["doc_id"]] or "")
        assert bytes(r["decoded"]) == (TEXTS[r["doc_id"]] or "").encode()
    assert bpe.encode(df.limit(0), RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("blank", [" ", "\n", "\u3000"])
def test_bpe_long_blank_runs(spark, blank):
    enc = bpe.codec(RANKS, PATTERN)
    for n in (999, 1000, 1001, 30_000):
        for before in ("", "a", "!", "9 b"):
            for after in ("", "word", " word", "!", "\n", "5", "\x1c", "'s", "\t\tx"):
                text = before + blank * n + after
                assert bpe.encode_text(enc, text) == enc.encode_ordinary(text), (n, before, after)
    texts = [blank * 1_000_000, "a" + blank * 5_000_000 + "b", "a b" + blank * 5_000_000, blank * 2000 + "x" + blank * 1_000_000 + "\n" * 1_000_000 + "!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    both = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN, keep=("doc_id", "ids")).collect()
    for r in both:
        assert bytes(r["decoded"]).decode() == texts[r["doc_id"]]
    last = {r["doc_id"]: r["ids"][-1] for r in both}
    assert enc.decode([last[1]]) == "b" if blank != " " else enc.decode([last[1]]) == " b"


def _elements(glob):
    """(characters read, or None for any; whether it may read none or several)."""
    out, i = [], 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = [*out, (None, True)], i + 2
        elif glob[i] == "*":
            out, i = [*out, (set("ab?"), True)], i + 1
        elif glob[i] == "?":
            out, i = [*out, (None, False)], i + 1
        elif glob[i] == "[":
            end = glob.index("]", i)
            out, i = [*out, (set(glob[i + 1 : end]), False)], end + 1
        else:
            i += glob[i] == "\\"
            out, i = [*out, ({glob[i]}, False)], i + 1
    return out


def _fits(glob, text):
    """By dynamic programming: row k says which beginnings of the text the first k elements read."""
    row = [True] + [False] * len(text)
    for chars, star in _elements(glob):
        new = [star and row[0]]
        for j, c in enumerate(text):
            reads = chars is None or c in chars
            new.append((row[j + 1] or (new[j] and reads)) if star else row[j] and reads)
        row = new
    return row[-1]


def test_automaton_equals_matcher():
    rng = random.Random(5)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "[ab]", "\\?"]) for _ in range(rng.randint(1, 30))) for _ in range(80)]
    texts = ["".join(rng.choice("ab/?") for _ in range(rng.randint(0, 25))) for _ in range(300)] + ["", "ab" * 500]
    auto = url_filter.GlobAutomaton(globs)
    assert auto.words > 1
    got = auto.matches([t.encode() for t in texts])
    want = np.array([[_fits(g, t) for g in globs] for t in texts])
    assert (got == want).all()


def test_url_verdicts(spark):
    urls = [
        ("http://a.com/x", "com/", "allow"), ("https://EXAMPLE.com/en/1", "example.com/en/", "block"), ("http://www.example.com/en/", "www.example.com/en/", "allow"),
        ("http://m.www.example.com/en/q", "www.example.com/en/", "allow"), ("http://x.net/es/1", "net/es/", "block"), ("http://x.net/ES/1", None, "allow"),
        ("http://a.com", None, "allow"), ("http://a.com?/", None, "allow"), ("http://badexample.com/en/", "com/", "allow"), ("evil.org/x.net/es/", None, "allow"),
        ("http://evil.org/x.net/es/", None, "allow"), ("http://ads-track.org/x", None, "block"), ("http://q.org/a?page=4", None, "block"),
        ("http://docs.org/a?page=4", None, "allow"), ("http://q.org/a?utm_x=1&page=1#page=4", None, "allow"), (None, None, "allow"), ("", None, "allow"),
        ("http://x.net/" + "y" * 200_000, None, "allow"), ("http://a.com/x", "com/", "allow"),
        ("http://q.org?ref=x.net/es/", None, "allow"), ("http://a?x.com/", None, "allow"), ("http://q.org?x=.com/", None, "allow"), ("http://net?y/es/", None, "allow"),
        ("http://q.org/?ref=x.net/es/", None, "allow"), ("http://x.net/es/?a", "net/es/", "block"), ("http://x.net#/es/", None, "allow"),
    ]
    df = spark.createDataFrame([(i, u, 0, "h") for i, (u, _, _) in enumerate(urls)], "page_id long, url string, rule_no int, host string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, queries.HOST_RULES, queries.GLOB_RULES, keep=("page_id",)).collect()}
    for i, (u, rule, verdict) in enumerate(urls):
        assert (got[i]["rule"], got[i]["verdict"]) == (rule, verdict), u
    assert (got[15]["host"], got[15]["path"]) == ("", "")
    assert url_filter.judge_urls(df.limit(0), queries.HOST_RULES, [], keep=("page_id",)).count() == 0


@pytest.mark.parametrize("shards", [1, 7])
def test_shards_are_exact_and_gapless(spark, shards):
    rows = [(i % 50 if i % 3 else None, None if i % 7 == 0 else "t" * (i % 5), 1) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(5)
    got = sharding.assign_shards(df, {"doc_id": F.col("doc_id"), "text": F.col("text")}, shards).collect()
    sizes = Counter(r["shard"] for r in got)
    assert sum(sizes.values()) == 500 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((a, b) for a, b, _ in rows)
    assert sharding.assign_shards(df.limit(0), {"doc_id": F.col("doc_id")}, shards).count() == 0
    few = sharding.assign_shards(df.limit(3), {"doc_id": F.col("doc_id")}, 7).collect()
    assert len({r["shard"] for r in few}) == 3


def test_communication_matrix_law():
    rng_sums = np.zeros((3, 4))
    counts, sizes = [10, 25, 5], sharding.even_sizes(40, 4)
    for seed in range(400):
        m = sharding.communication_matrix(counts, sizes, seed)
        assert [sum(r) for r in m] == counts and [sum(c) for c in zip(*m, strict=True)] == sizes
        rng_sums += np.array(m)
    assert np.allclose(rng_sums / 400, np.outer(counts, sizes) / 40, atol=0.35)
    # beyond numpy's population: mean and spread of the inversion
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(rng, 10**9, 3 * 10**9, 400) for _ in range(3000)]
    assert abs(np.mean(draws) - 100) < 1 and abs(np.std(draws) - 75**0.5) < 0.6


def test_write_shards(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    sharding.write_shards(df, str(tmp_path / "out"), "doc_id", 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [25] * 4
    assert back.select("doc_id").distinct().count() == 100
