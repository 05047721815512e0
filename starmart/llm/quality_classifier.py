"""Quality classifier by positive-unlabelled learning.

Trusted positives (labelled good) and unlabelled web text train a linear classifier; no negative
label is used.  The risk is the non-negative unbiased one for a logistic loss l and class prior p:

    p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)])

While the second part is negative, its gradient is followed upwards instead, so the model can't fit
the unlabelled sample below zero risk.  The prior is estimated before, from a classifier of positive
against unlabelled fitted on one half of the samples: on the other half, over the sets "score at
least t", the least ratio of the unlabelled share to the positive share (with a margin for chance)
bounds the part of positives in the unlabelled text.

Features are the text's own: lengths, kinds of characters, repetition, and the shapes of its words
(letters, capitals, digits and marks, runs shortened) hashed into :data:`SHAPES` shares; numbers are
also cut at the sample's quantiles, so that the linear model can bend.

Bounds: the fit reads at most :data:`MAX_POSITIVES` labelled and :data:`MAX_UNLABELLED` unlabelled
documents, those with the smallest hashes of their ids; all documents are scored, whole.

Edge cases: null and empty texts have all features 0 and get a score like others; without positives
or without documents to learn from the score is 0.5; equal texts get equal scores; null labels and
labels without a document are ignored, a document with several labels is positive if one is; an
empty table gives an empty result; other columns pass through or are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .linear import LinearModel, fit_linear, sigmoid
from .tables import small

MAX_POSITIVES = 8_000
MAX_UNLABELLED = 16_000
SHAPES = 64
QUANTILES = (0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98)
_KINDS = bytes(
    ord("a") if chr(c).islower() and c < 128 or c >= 128 else ord("A") if chr(c).isupper() and c < 128 else ord("0") if 48 <= c <= 57 else c
    for c in range(256)
)
_RUNS = re.compile(rb"([^ \n])\1+")
NUMBERS = 12


def text_features(text: str | None) -> np.ndarray:
    out = np.zeros(NUMBERS + SHAPES, np.float32)
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return out
    n, chars = len(words), sum(map(len, words))
    kinds = raw.translate(_KINDS)
    lower, upper, digits = kinds.count(b"a"), kinds.count(b"A"), kinds.count(b"0")
    lines = [x for x in raw.split(b"\n") if x.strip()]
    joined = b" ".join(words)
    out[:NUMBERS] = (
        np.log1p(n), chars / n, upper / chars, digits / chars, (chars - lower - upper - digits) / chars, len(set(words)) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1), 1 - len(set(lines)) / max(1, len(lines)), len(zlib.compress(joined, 1)) / len(joined),
        np.log1p(len(lines)), sum(x.rstrip()[-1:] in b".!?" for x in lines) / max(1, len(lines)), raw.count(b"!") / n,
    )
    shapes = Counter(_RUNS.sub(rb"\1", kinds).split())
    for shape, count in shapes.items():
        out[NUMBERS + zlib.crc32(shape) % SHAPES] += count / n
    return out


def _bend(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The features, and for each number whether it is beyond each of its cuts."""
    beyond = (x[:, :NUMBERS, None] > cuts[None]).reshape(len(x), -1)
    return np.concatenate([x, beyond.astype(np.float32)], axis=1)


def _pu_gradient(positive: np.ndarray, prior: float):
    """Derivative by the logits of the non-negative risk; rows are positives and unlabelled."""
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())

    def gradient(f: np.ndarray) -> np.ndarray:
        s = sigmoid(f)
        rest = np.logaddexp(0, f)  # the loss as a negative
        negative_part = rest[~positive].mean() - prior * rest[positive].mean()
        down = np.where(positive, -prior * s / n_pos, s / n_unl)
        keep = np.where(positive, -prior * (1 - s) / n_pos, 0.0)
        return keep + down if negative_part >= 0 else -down

    return gradient


def estimate_prior(x: np.ndarray, positive: np.ndarray, steps: int = 200) -> float:
    """Share of positives in the unlabelled rows, by the best bin of a held-back half."""
    half = np.arange(len(x)) % 2 == 0
    fit, test = half, ~half
    p, u = max(1, (positive & fit).sum()), max(1, (~positive & fit).sum())
    y = positive[fit]
    model = fit_linear(x[fit], lambda f: np.where(y, (sigmoid(f) - 1) / (2 * p), sigmoid(f) / (2 * u)), steps=steps)
    scores = model.logits(x[test])
    pos, unl = np.sort(scores[positive[test]]), np.sort(scores[~positive[test]])
    if not len(pos) or not len(unl):
        return 0.5
    cuts = np.quantile(pos, np.linspace(0.0, 0.8, 41))
    share_pos = 1 - np.searchsorted(pos, cuts) / len(pos)
    share_unl = 1 - np.searchsorted(unl, cuts) / len(unl)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(pos)) + 1 / np.sqrt(len(unl)))
    best = int(np.argmin((share_unl + margin) / share_pos))
    return float(np.clip(share_unl[best] / share_pos[best], 0.02, 0.98))


class QualityModel:
    """Cuts of the numbers and the linear model; small, so it travels with the scoring tasks."""

    def __init__(self, cuts: np.ndarray, linear: LinearModel | None, prior: float):
        self.cuts, self.linear, self.prior = cuts, linear, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.linear.score(_bend(x, self.cuts)) if self.linear is not None else np.full(len(x), 0.5)


def _features(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``features`` of the column ``txt``."""
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("features", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            each = pa.array([text_features(t) for t in rb.column("txt").to_pylist()], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*[rb.column(c) for c in keep], each], [*keep, "features"])

    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", max_positives: int = MAX_POSITIVES,
          max_unlabelled: int = MAX_UNLABELLED) -> QualityModel:
    """``labels``: ``doc_id`` and ``quality``; only documents for which ``learn`` (over the column ``doc_id``) holds are read."""
    good = labels.filter(F.col("quality") == 1).select("doc_id").distinct().filter(learn)
    ids = docs.select(F.col(id_col).alias("doc_id")).filter(learn & F.col("doc_id").isNotNull()).distinct()
    order = F.xxhash64("doc_id", F.lit("pu"))
    positives = good.join(ids, "doc_id", "left_semi").orderBy(order, "doc_id").limit(max_positives).select("doc_id", F.lit(True).alias("positive"))
    unlabelled = ids.orderBy(F.xxhash64("doc_id", F.lit("unlabelled")), "doc_id").limit(max_unlabelled).select("doc_id", F.lit(False).alias("positive"))
    chosen = materialize(positives.union(unlabelled), "pu_sample")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("txt")).join(small(chosen), "doc_id")
    # Rows of a repeated id count once, with the smallest of their texts; a number in hash order deals them to the two halves.
    rows = _features(texts.groupBy("doc_id", "positive").agg(F.min("txt").alias("txt")), ["doc_id", "positive"]).orderBy(order, "positive").toPandas()
    if not len(rows) or not rows["positive"].any() or rows["positive"].all():
        return QualityModel(np.zeros((NUMBERS, len(QUANTILES))), None, 0.5)
    raw, positive = np.stack(rows["features"].to_numpy()), rows["positive"].to_numpy(bool)
    cuts = np.quantile(raw[:, :NUMBERS], QUANTILES, axis=0).T
    x = _bend(raw, cuts)
    prior = estimate_prior(x, positive)
    return QualityModel(cuts, fit_linear(x, _pu_gradient(positive, prior), l2=3e-4), prior)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: Sequence[str] = ("doc_id",), result: str = "score") -> DataFrame:
    """``keep`` columns and ``result`` (probability that the text is good) of every row."""
    given = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("txt"))
    names = [f"k{i}" for i in range(len(keep))]
    schema = T.StructType([*[given.schema[c] for c in names], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, 2000):
                part = rb.slice(at, 2000)
                x = np.stack([text_features(t) for t in part.column("txt").to_pylist()])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(model.score(x))], [*names, "score"])

    return given.mapInArrow(run, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("score").alias(result))
