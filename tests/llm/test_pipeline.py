import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_models import sentences

import corpus_pipeline
from starmart.llm import bpe


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(17)

    def text(n):
        return "\n".join(" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9999)}" for _ in range(14)) + "." for _ in range(n))

    docs, passage, item = {}, " ".join(f"p{k}" for k in range(60)), " ".join(f"q{k}" for k in range(30))
    for i in range(260):
        docs[i] = text(rng.randint(3, 9)).replace("\n", " " if i % 4 == 0 else "\n")
    for i in range(260, 320):
        docs[i] = "!! ".join(sentences(rng, 9).upper().split()) + "!!"
    docs[400] = docs[3]  # a copy: all its lines go
    docs[401], docs[402] = text(2) + "\n" + passage, text(2) + "\n" + passage
    words = text(9).replace("\n", " ").split()
    docs[403] = " ".join(words)  # one line, so only the Jaccard join can see the near copy
    docs[404] = " ".join([*words[:60], "changed", *words[61:]])
    docs[405] = text(2) + " " + item + " " + text(1)
    d = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    marks = [(i, int(i < 260), 0) for i in range(320) if i % 3]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), docs, passage


def test_stages_take_effect(spark, corpus):
    path, docs, passage = corpus
    now = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialize(stage(spark, now, path), name)
        kept[name] = {r["doc_id"]: r for r in now.collect()}
        if name != "byte_bpe":
            assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {i for i in docs if not 260 <= i < 320}
    assert set(kept["quality_classifier"]) == clean
    lines = kept["line_dedup"]
    assert set(lines) == clean - {400}
    assert passage in lines[401]["text"] and passage not in lines[402]["text"] and lines[402]["n_chars"] == len(lines[402]["text"])
    assert set(kept["jaccard_join"]) == set(lines) - {404}
    assert set(kept["decontamination"]) == set(lines) - {404, 405}
    enc = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for i, r in kept["byte_bpe"].items():
        assert r["ids"] == enc.encode_ordinary(lines[i]["text"]) and r["n_tokens"] == len(r["ids"])
    assert set(kept["byte_bpe"]) == set(kept["decontamination"])


def test_stages_on_null_and_empty_texts(spark, corpus):
    path = corpus[0]
    docs = spark.createDataFrame([(1, None, "en", "s", None), (None, "", None, None, 0), (2, "one two", "en", "s", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, path).count() == 3, name
        assert stage(spark, docs.limit(0), path).count() == 0, name
    assert corpus_pipeline.quality(spark, docs.limit(0), path).count() == 0
    assert docs.select(F.count("*")).first()[0] == 3


def test_stages_on_repeated_rows_long_texts_and_clashing_columns(spark, corpus):
    path, given, _ = corpus
    rng = random.Random(23)
    long = "\n".join(" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9999)}" for _ in range(14)) + "." for _ in range(2500))  # 35,000 words
    blanks = given[5] + "\n" + " " * 300_000 + "\n" * 300_000 + "end"
    texts = [(1, given[1]), (1, given[1]), (2, given[2]), (3, given[2]), (4, None), (4, None), (5, ""), (6, long), (7, blanks), (8, given[8]), (8, given[9])]
    extra = ["score", "deleted_lines", "marked_doc_id", "Marked_Text_Key", "contaminated_text_key", "row", "txt", "n", "node", "ids", "decoded", "k0"]
    rows = [(i, t, "en", "s", None if t is None else len(t), *range(len(extra))) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in extra)).repartition(3)
    kept, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialize(stage(spark, docs, path), name)
        kept[name] = sorted((r["doc_id"] for r in now.collect()))
        if name == "quality_classifier":  # its verdict on such texts is not what is tested here
            assert now.columns == columns and kept[name].count(1) in (0, 2) and kept[name].count(4) in (0, 2)  # equal rows are judged alike
            continue
        docs = now
        if name != "byte_bpe":
            assert docs.columns == columns, name
            assert {r["doc_id"]: r["text"] for r in docs.collect()}[6] == long
    assert kept["line_dedup"].count(1) == 2 and kept["line_dedup"].count(8) == 2  # equal rows are one document there
    assert kept["jaccard_join"].count(1) == 1 and kept["jaccard_join"].count(8) == 2 and kept["jaccard_join"].count(2) + kept["jaccard_join"].count(3) == 1
    enc = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = {r["doc_id"]: r["ids"] for r in docs.collect()}
    assert ids[6] == enc.encode_ordinary(long) and kept["byte_bpe"] == kept["decontamination"]


def test_a_task_has_one_python_worker_at_most(spark, corpus):
    path = corpus[0]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        plan = stage(spark, docs, path)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"EvalPython|MapIn(?:Arrow|Pandas)", plan)) <= 1, name
