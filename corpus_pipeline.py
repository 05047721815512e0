"""The corpus pipeline: stages over ``documents``, each calling one operator of ``starmart.llm``.

Each stage reads what its predecessor kept, whole, and its decision takes effect:

1. quality classifier: documents with a score under 0.7 go;
2. line dedup: blocks that an earlier document has are cut out (``n_chars`` follows); documents that
   lose all their words go, the others stay;
3. n-gram Jaccard join: of each group of near duplicates the document with the smallest id stays;
4. benchmark decontamination: documents that contain a benchmark item go;
5. byte-level BPE: each document's ids, with their number and the digests of ids and decoded bytes.

Null and empty texts: the classifier scores them like any text; later stages leave them alone.  Repeated
rows are judged alike and become one row in stage 3; of rows with one id and different texts each text
stands for itself.  Very long texts are read whole.  Other columns pass through to stage 4, whatever
their names (``score``, ``deleted_lines``, ...).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import bpe, decontaminate, jaccard_join, line_dedup, quality_classifier
from starmart.llm.queries import CONFIDENT, bpe_digests, quality_model
from starmart.llm.tables import free_name, read_table
from starmart.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = free_name(docs, "score")
    scored = quality_classifier.score(docs, quality_model(spark, docs, sf_dir), keep=docs.columns, result=score)
    return scored.filter(F.col(score) >= CONFIDENT).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    deleted = free_name(docs, "deleted_lines")
    cut = line_dedup.delete_blocks(docs, result=deleted)
    words_left = F.length(F.translate("text", " \t\n\x0b\x0c\r", "")) > 0
    cut = cut.filter((F.col(deleted) == 0) | words_left)
    size = F.when(F.col(deleted) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", size).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    # Written between, so that a task has one Python worker with the ranks, not two at a time.
    ids = materialize(bpe.encode(docs, ranks, pattern), "pipeline_ids")
    both = bpe.decode(ids, ranks, pattern, keep=("doc_id", "ids"))
    return both.select("doc_id", *bpe_digests(), "ids")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark),
    ("byte_bpe", tokens),
]

#: A trained classifier, patience diff and BPE can't be stated in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
