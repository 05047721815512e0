import datetime as dt
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import quality_classifier, quality_rules, toxicity, warc
from starmart.llm.tables import fold
from starmart.operators import sequence


def sentences(rng, n):
    return ". ".join(" ".join(rng.choice("the a of house river walks green seven under moon kept bridge story often".split()) + str(rng.randrange(50)) * (rng.random() < 0.3)
                              for _ in range(9)).capitalize() for _ in range(n)) + "."


def measured(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    count, covered, seen, dup = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set(), set(), 0
    for i in range(len(w) - 4):
        if count[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    for x in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_measures_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", " \t\n", "a", "a b c d e", "x y " * 9, "a\n\na\n a\nb\nb\nb\n", "é🙂 ü\x0bz\x0c\rq # | <b>", "one two three four five six " * 2 + "tail"]
    texts += ["".join(rng.choice(["a ", "b ", "c ", "\n", "#", "é", " "]) for _ in range(rng.randint(0, 120))) for _ in range(60)] + ["w " * 20_000]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in quality_rules.measures(df.drop("n_words")).collect()}
    assert got == {i: measured(t) for i, t in enumerate(texts)}
    assert quality_rules.measures(df).count() == len(texts)


def test_label_model_separates_without_labels(spark):
    rng = random.Random(3)
    good = [sentences(rng, rng.randint(3, 9)) for _ in range(150)]
    marks = [" ".join(w + rng.choice(["***", "$$$", "###"]) for w in sentences(rng, 5).split()) for _ in range(20)]
    shout = ["!! ".join(sentences(rng, 5).upper().split()) + "!!" for _ in range(20)]
    rows = [(i, t) for i, t in enumerate([*good, *marks, *shout, None, ""])]
    judged = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("failed", quality_rules.base_failed())
    got = {r["doc_id"]: r for r in judged.collect()}
    assert all(got[i]["posterior"] > 0.5 for i in range(150))
    assert all(got[i]["posterior"] < 0.5 for i in range(150, 190))
    assert got[190]["failed"] and got[191]["failed"] and len(got) == 192
    assert quality_rules.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_label_model_step_equals_numpy(spark):
    rng = np.random.default_rng(0)
    votes = rng.choice([-1, 0, 1], size=(300, 3), p=[0.2, 0.3, 0.5])
    df = spark.createDataFrame([(*map(int, v), 1.0) for v in votes], "v0 int, v1 int, v2 int, n double")
    got, start = quality_rules.fit(df, 3, steps=1), quality_rules.LabelModel.start(3)
    odds = np.zeros(300)
    for j in range(3):
        (gn, gp), (bn, bp) = start.good[j], start.bad[j]
        odds += np.where(votes[:, j] == -1, min(0, np.log(gn / bn)), np.where(votes[:, j] == 1, max(0, np.log(gp / bp)), 0))
    p, w = 1 / (1 + np.exp(-odds)), quality_rules.START_WEIGHT
    assert got.share == pytest.approx((p.sum() + 1) / 302)
    for j in range(3):
        assert got.good[j][0] == pytest.approx((p[votes[:, j] == -1].sum() + w * start.good[j][0]) / (p.sum() + w))
        assert got.bad[j][1] == pytest.approx(((1 - p)[votes[:, j] == 1].sum() + w * start.bad[j][1]) / ((1 - p).sum() + w))


def test_quality_classifier_held_out(spark):
    rng, rows, labels = random.Random(9), [], []
    for i in range(700):
        bad = rng.random() < 0.3
        text = sentences(rng, rng.randint(2, 9))
        if bad:
            text = "!! ".join(text.upper().split()) if i % 2 else " | ".join(text.split())
        rows.append((i, text, 0.5))
        if rng.random() < 0.5:
            labels.append((i, 0 if bad else 1))
    rows += [(None, None, 0.1), (9001, "", 0.2), (9001, "", 0.2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (77777, 1)], "doc_id long, quality int")
    model = quality_classifier.train(docs, marks, fold("doc_id", 4) != 2)
    assert 0.55 < model.prior < 0.9
    out = quality_classifier.score(docs, model, keep=("doc_id", "score")).toDF("doc_id", "old", "score")
    got = [(r["doc_id"], r["score"]) for r in out.filter(fold("doc_id", 4) == 2).collect()]
    truth = dict(labels)
    right = [(s >= 0.7) == (truth[i] == 1) for i, s in got if i in truth]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert out.count() == len(rows) and out.filter("score between 0 and 1").count() == len(rows)
    nobody = quality_classifier.train(docs, marks.filter("quality = 0"), fold("doc_id", 4) != 2)
    assert {r["score"] for r in quality_classifier.score(docs, nobody).collect()} == {0.5}
    empty = quality_classifier.train(docs.limit(0), marks, fold("doc_id", 4) != 2)
    assert quality_classifier.score(docs.limit(0), empty).count() == 0


def test_non_negative_risk_gradient():
    rng = np.random.default_rng(2)
    positive = rng.random(40) < 0.4
    for prior, shift in ((0.3, 0.0), (0.9, -6.0)):
        f, g = rng.normal(size=40) + shift * ~positive, quality_classifier._pu_gradient(positive, prior)

        def parts(f):
            loss = np.logaddexp(0, f)
            return prior * np.logaddexp(0, -f)[positive].mean(), loss[~positive].mean() - prior * loss[positive].mean()

        pos, neg = parts(f)
        numeric = []
        for k in range(40):
            h = np.zeros(40)
            h[k] = 1e-6
            (p1, n1), (p0, n0) = parts(f + h), parts(f - h)
            numeric.append(((p1 + n1) - (p0 + n0)) / 2e-6 if neg >= 0 else -(n1 - n0) / 2e-6)
        assert (neg < 0) == (shift < 0)
        assert np.allclose(g(f), numeric, atol=1e-6)


def test_toxicity_held_out(spark):
    rng, rows, labels = random.Random(12), [], []
    for i in range(900):
        words = sentences(rng, rng.randint(2, 8)).split()
        toxic = rng.random() < 0.2
        if toxic:
            insults = ["moron", "Scum"] if i % 2 else ["vortu" + rng.choice("abcdef") + "x" for _ in range(2 + len(words) // 40)]
            for x in insults:
                words.insert(rng.randrange(len(words)), x)
        rows.append((i, " ".join(words), "h"))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
    rows += [(None, None, "h"), (5000, "", "h"), (5000, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.score_documents(docs, marks, fold("doc_id", 3) != 1).collect()
    truth = dict(labels)
    held = {r[0] for r in docs.filter(fold("doc_id", 3) == 1).select("doc_id").collect()}
    right = [(r["score"] >= 0.7) == (truth[r["doc_id"]] == 1) for r in out if r["doc_id"] in held and r["doc_id"] in truth]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["score"] < 0.5 for r in out if r["doc_id"] in (None, 5000))
    assert toxicity.score_documents(docs.limit(0), marks, fold("doc_id", 3) != 1).count() == 0
    assert toxicity.score_documents(docs, marks.limit(0), fold("doc_id", 3) != 1).count() == len(rows)


def block(status, **headers):
    return "\r\n".join([f"HTTP/1.1 {status} x", *[f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]])


@pytest.mark.parametrize("hot", [1_000_000, 2])
def test_warc_revisits(spark, monkeypatch, hot):
    monkeypatch.setattr(sequence, "CHUNK_ROWS", 3)

    def at(m):
        return dt.datetime(2024, 1, 1, 0, m)

    u = "http://www.Ex.org:80/a?utm_s=1#f"
    rows = [
        ("r1", "response", u, at(1), block(200, ETag='"a"', Date="d1", Content_Type="text/html"), "p1"),
        ("v1", "revisit", "https://ex.org/a", at(2), block(304, ETag='W/"a"', Date="d2", Content_Type="x", X="y"), None),
        ("v2", "revisit", "https://ex.org/a", at(3), block(304, ETag='"b"'), None),
        ("v0", "revisit", "https://ex.org/a", at(0), block(304, ETag='"a"'), None),
        ("r2", "response", "http://ex.org/a", at(4), block(200, Last_Modified="m1"), "p2"),
        ("r3", "response", "http://ex.org/a", at(5), block(404), "p3"),
        ("v3", "revisit", "http://ex.org/a", at(6), block(304, Last_Modified="m1", ETAG=""), None),
        ("v4", "revisit", "http://ex.org/a", at(7), block(304, last_modified="m1"), "p9"),
        ("v5", "revisit", "http://ex.org/a", at(8), block(304), "p2"),
        ("v6", "revisit", "http://ex.org/a", at(8), block(304), None),
        ("v7", "revisit", "http://ex.org/b", at(9), block(304), "p2"),
        ("n1", "revisit", None, at(9), block(304), "p2"), ("n2", "revisit", "http://ex.org/a", None, block(304), "p2"), ("n3", None, "http://ex.org/a", at(9), None, None),
        (None, "revisit", "http://ex.org/a", at(9), block(304), "p2"),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "record_id string, warc_type string, target_uri string, warc_date timestamp_ntz, http_block string, payload_digest string, status string")
    got = {r["record_id"]: r for r in warc.resolve_revisits(df, hot_rows=hot).collect()}
    want = {"r1": ("response", "r1"), "v1": ("resolved", "r1"), "v2": ("mismatch", None), "v0": ("no_earlier", None), "r2": ("response", "r2"), "r3": ("other", None),
            "v3": ("mismatch", None), "v4": ("resolved", "r2"), "v5": ("resolved", "r2"), "v6": ("no_validator", None), "v7": ("no_earlier", None),
            "n1": ("no_earlier", None), "n2": ("no_earlier", None), "n3": ("other", None), None: ("no_earlier", None)}
    assert {k: (r["outcome"], r["resolved_id"]) for k, r in got.items()} == want
    assert got["v1"]["headers"] == {"etag": 'W/"a"', "date": "d2", "content-type": "text/html"}
    assert got["v1"]["canonical_uri"] == got["r1"]["canonical_uri"] == "ex.org/a"
    bodies = warc.with_bodies(warc.resolve_revisits(df), df.withColumn("body", F.concat(F.lit("B"), "record_id")))
    assert {r["record_id"]: r["body"] for r in bodies.collect()}["v4"] == "Br2"
    assert warc.resolve_revisits(df.limit(0)).count() == 0
