"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. *Terms.*  A short list of insults in several languages, and terms mined from labelled training
   rows: words and word beginnings of 3 to 7 letters that far more toxic than clean documents have,
   or have as a dense share of their words.
2. *Voters.*  Terms are dealt into presence voters by kind and rank; a density voter per kind looks
   at the share of its terms in the words; pattern voters look at shouting, exclamation and address;
   one fires if no lexicon voter does and speaks for clean, all others speak for toxic.  A voter
   fires or abstains.
3. *Label model.*  Given the unknown class, a voter fires with its own rate.  Expectation-maximisation
   estimates rates (hence accuracies) and the share of toxic documents over all documents, without
   labels.  Voters are not independent (a word and its beginning fire together): correlations of the
   voters within the toxic class are estimated from the same sums, and a voter's evidence is divided
   by one plus its correlations with the others that fired, so that echoes count once.
4. *Classifier.*  A logistic regression on term presence and text statistics is trained on the
   posteriors of a bounded sample and scores all documents.

Every text is read whole, once; what is kept per document is the list of terms it has and a few
numbers, so label model and scores work on a small table.  The model's counts are sums over that
whole table; only one row per task and step reaches the driver.

Bounds: mining reads at most :data:`MAX_LABELLED` labelled rows of each class, the classifier's fit at
most :data:`MAX_FIT` documents, those with the smallest hashes of their ids; at most
:data:`MAX_TERMS` terms are mined.

Edge cases: null and empty texts have no terms and are scored like any text without them; without
labels the fixed list alone votes; without documents to learn from the score is the share that the
label model ends with; null labels and labels without a document are ignored; equal texts get equal
scores; an empty table gives an empty result; columns not named in ``keep`` are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .linear import LinearModel, fit_linear, sigmoid
from .tables import small

#: Insults, our own choice; a trailing * marks a word beginning.
LEXICON = (
    "idiot", "moron", "stupid", "scum", "loser", "trash", "worthless", "pathetic", "disgusting", "clown", "imbecile", "bastard",
    "dumm*", "trottel", "abschaum", "arschloch", "connard*", "salaud", "ordure", "imbécile", "idiota", "estúpid*", "basura", "cabrón",
)
MAX_LABELLED = 15_000
MAX_FIT = 20_000
MAX_TERMS = 300
#: Different labelled toxic texts that have a mined term, at least, as a number and as a share; its log ratio of rates.
MIN_TOXIC, MIN_SHARE, MIN_RATIO = 4, 0.02, 3.0
PREFIXES = (3, 4, 5, 6, 7)
#: A dense term makes up at least this share of a text's words; a dense voter fires from DENSE_VOTE on.
DENSE, DENSE_VOTE = 0.008, 0.01
VOTERS_PER_KIND = 3
STEPS = 12
_WORD = re.compile(r"[^\W\d_]+")
_ADDRESS = re.compile(r"\b(?:you|du|ihr|tu|vous|vosotros|ustedes)\b(?:\W+\w+){0,3}?\W+(?:are|bist|seid|es|êtes|sois|son)\b")
#: The last one, no term at all, speaks for clean; all other voters speak for toxic.
DENSE_MARK = "%"
PATTERNS = ("shouting", "exclamation", "address", "silence")
NUMBERS = 4


def _beginnings(word: str) -> list[str]:
    return [word[:k] + "*" for k in PREFIXES if len(word) >= k]


def document_terms(text: str | None) -> set[str]:
    """Words in lower case and their beginnings, marked by a star; those that are dense also with a mark."""
    counts: Counter[str] = Counter()
    words = Counter(_WORD.findall((text or "").lower()))
    for w, n in words.items():
        counts[w] += n
        for p in _beginnings(w):
            counts[p] += n
    least = DENSE * words.total()
    return {*counts, *(t + DENSE_MARK for t, n in counts.items() if n >= least)}


def text_numbers(text: str | None) -> tuple[float, ...]:
    """Log words, share of capitals, exclamation marks a word, whether someone is addressed."""
    t = text or ""
    n = max(1, len(t.split()))
    letters = max(1, sum(map(len, t.split())))
    capitals = sum(map(t.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return float(np.log1p(len(t.split()))), capitals / letters, t.count("!") / n, float(bool(_ADDRESS.search(t.lower())))


def mine_terms(texts: DataFrame, max_terms: int = MAX_TERMS) -> list[str]:
    """``texts``: ``txt``, ``toxic`` (0 or 1).  Terms by how many toxic documents they tell, times how clearly."""
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("toxic", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, 500):
                part = rb.slice(at, 500)
                terms, toxic = [], []
                for t, y in zip(part.column("txt").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                    found = document_terms(t)
                    terms += found
                    toxic += [y] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(toxic, pa.int32())], ["term", "toxic"])

    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return []
    counts = texts.select("txt", "toxic").mapInArrow(run, schema).groupBy("term").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    ratio = F.log((F.col("t") + 0.1) / (totals[1] + 1)) - F.log((F.col("n") - F.col("t") + 0.1) / (totals[0] + 1))
    best = counts.withColumn("ratio", ratio).filter((F.col("t") >= max(MIN_TOXIC, MIN_SHARE * totals[1])) & (F.col("ratio") >= MIN_RATIO))
    chosen: list[str] = []
    stems: list[str] = []
    for r in best.orderBy(F.desc(F.col("t") * F.col("ratio")), "term").limit(10 * max_terms).collect():
        # Of terms that begin alike, only the one that tells most stays: the others echo it, or hold its chance hits.
        stem = r["term"].rstrip(DENSE_MARK).rstrip("*")
        if not any(stem.startswith(x) or x.startswith(stem) for x in stems):
            chosen.append(r["term"])
            stems.append(stem)
    return chosen[:max_terms]


def _kind(term: str) -> int:
    return len(term) if term[-1] == "*" else 0


@dataclass
class Voters:
    """All terms; for each presence voter the numbers of its terms, for each density voter likewise."""

    terms: list[str]
    present: list[np.ndarray]
    dense: list[np.ndarray]

    @classmethod
    def build(cls, mined: Sequence[str]) -> Voters:
        some = [t for t in mined if t[-1] != DENSE_MARK]
        thick = [t[:-1] for t in mined if t[-1] == DENSE_MARK]
        terms = list(dict.fromkeys([*LEXICON, *some, *thick]))
        number = {t: i for i, t in enumerate(terms)}
        kinds = sorted({_kind(t) for t in terms})
        groups = [list(LEXICON), *[[t for t in some if _kind(t) == k] for k in kinds]]
        present = [np.array([number[t] for t in g[v::VOTERS_PER_KIND]]) for g in groups for v in range(VOTERS_PER_KIND)]
        dense = [np.array([number[t] for t in dict.fromkeys([*thick, *some]) if _kind(t) == k]) for k in kinds]
        return cls(terms, [x for x in present if len(x)], [x for x in dense if len(x)])

    def __len__(self) -> int:
        return len(self.present) + len(self.dense) + len(PATTERNS)

    def rates(self, hits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Share of the text's words that are a dense voter's terms, per voter."""
        words = np.maximum(np.expm1(numbers[:, :1]), 1)
        return np.stack([hits[:, x].sum(1) for x in self.dense], axis=1) / words if self.dense else np.zeros((len(hits), 0))

    def fired(self, hits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Row by voter, from counts by row and term and the texts' numbers."""
        lexicon = [*[(hits[:, x] > 0).any(1) for x in self.present], *(self.rates(hits, numbers) >= DENSE_VOTE).T]
        silent = ~np.any(lexicon, axis=0) if lexicon else np.ones(len(hits), bool)
        return np.stack([*lexicon, numbers[:, 1] > 0.5, numbers[:, 2] > 0.3, numbers[:, 3] > 0, silent], axis=1).astype(float)

    def features(self, hits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """For the classifier: counts of terms and rates of the dense voters, both bent, and the numbers."""
        return np.concatenate([np.log1p(hits), np.minimum(self.rates(hits, numbers), 0.05) * 40, numbers], axis=1).astype(np.float32)


def _dense(rb: pa.RecordBatch, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by row and term, and the numbers, of rows of :func:`read_documents`."""
    hits = np.zeros((rb.num_rows, terms), np.float32)
    found = rb.column("hits")
    rows = np.repeat(np.arange(rb.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
    np.add.at(hits, (rows, found.flatten().to_numpy(zero_copy_only=False)), 1)
    numbers = rb.column("numbers").flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, NUMBERS)
    return hits, numbers


def read_documents(docs: DataFrame, terms: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep``, ``hits`` (the number of a term once for each time it occurs), ``numbers`` of every text ``txt``."""
    number = {t: i for i, t in enumerate(terms)}
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("hits", T.ArrayType(T.IntegerType())), T.StructField("numbers", T.ArrayType(T.DoubleType()))])
    heads = {t[:3] for t in terms}

    def hits(text: str | None) -> list[int]:
        out: list[int] = []
        for w, n in Counter(_WORD.findall((text or "").lower())).items():
            if w[:3] in heads:
                out += [number[t] for t in (w, *_beginnings(w)) if t in number] * n
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, 2000):
                part = rb.slice(at, 2000)
                texts = part.column("txt").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array([hits(t) for t in texts], pa.list_(pa.int32())),
                     pa.array([text_numbers(t) for t in texts], pa.list_(pa.float64()))], [*keep, "hits", "numbers"])

    return docs.select(*keep, "txt").mapInArrow(run, schema)


@dataclass
class LabelModel:
    """Share of toxic documents, each voter's rates of firing by class, and the voters' correlations."""

    share: float
    toxic: np.ndarray
    clean: np.ndarray
    correlation: np.ndarray

    @classmethod
    def start(cls, voters: int) -> LabelModel:
        toxic, clean = np.full(voters, 0.3), np.full(voters, 0.02)
        toxic[-1], clean[-1] = 0.1, 0.95
        return cls(0.1, toxic, clean, np.zeros((voters, voters)))

    def accuracies(self) -> np.ndarray:
        """Probability that a document is toxic if the voter fires."""
        return self.share * self.toxic / (self.share * self.toxic + (1 - self.share) * self.clean)

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        echoes = 1 + fired @ self.correlation
        evidence = fired * np.log(self.toxic / self.clean) / echoes
        return sigmoid(np.log(self.share / (1 - self.share)) + evidence.sum(1))


def fit_label_model(seen: DataFrame, voters: Voters, steps: int = STEPS) -> LabelModel:
    """Expectation-maximisation over ``hits`` and ``numbers`` of all rows; equal vote patterns are counted first."""
    v, n_terms = len(voters), len(voters.terms)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, 2000):
                fired = voters.fired(*_dense(rb.slice(at, 2000), n_terms))
                rows, counts = np.unique(fired.astype(np.uint8), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(counts, pa.int64())], ["fired", "n"])

    counted = seen.select("hits", "numbers").mapInArrow(patterns, "fired binary, n long").groupBy("fired").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "toxicity_votes")
    model = LabelModel.start(v)
    for _ in range(steps):

        def sums(batches: Iterator[pa.RecordBatch], model: LabelModel = model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 + 2 * v + v * v)
            for rb in batches:
                fired = np.stack([np.frombuffer(x, np.uint8) for x in rb.column("fired").to_pylist()]).astype(float)
                n = rb.column("n").to_numpy()
                p = model.posterior(fired) * n
                total += np.concatenate([[n.sum(), p.sum()], n @ fired, p @ fired, ((fired * p[:, None]).T @ fired).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])

        each = [np.array(r["total"]) for r in counted.mapInArrow(sums, "total array<double>").collect()]
        total = np.sum(each, axis=0) if each else np.zeros(2 + 2 * v + v * v)
        n, toxic = total[0], total[1]
        if not n:
            break
        by, by_toxic = total[2 : 2 + v], total[2 + v : 2 + 2 * v]
        start = LabelModel.start(v)
        rate = (by_toxic + start.toxic) / (toxic + 1)
        other = (np.maximum(by - by_toxic, 0) + start.clean) / (n - toxic + 1)
        both = total[2 + 2 * v :].reshape(v, v) / max(toxic, 1e-9)
        spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-9))
        correlation = np.clip((both - np.outer(rate, rate)) / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(correlation, 0)
        # A voter that fires more on the other class is held to say nothing.
        rate = np.append(np.maximum(rate, other)[:-1], min(rate[-1], other[-1]))
        model = LabelModel(float(np.clip(toxic / n, 1e-4, 0.9)), np.clip(rate, 1e-5, 0.999), np.clip(other, 1e-6, 0.999), correlation)
    return model


class ToxicityModel:
    """Voters, label model and classifier."""

    def __init__(self, voters: Voters, labels: LabelModel, linear: LinearModel | None):
        self.voters, self.labels, self.linear = voters, labels, linear

    def score(self, hits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        if self.linear is None:
            return np.full(len(hits), self.labels.share)
        return self.linear.score(self.voters.features(hits, numbers))


def score_documents(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED,
                    max_fit: int = MAX_FIT) -> DataFrame:
    """``doc_id`` and ``score`` (probability of toxic) of every row.  ``labels``: ``doc_id`` and ``toxic``; labels
    and sample are read only where ``learn`` (over the column ``doc_id``) holds."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("txt"))
    known = labels.filter(learn & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit("toxic"))
    chosen = [known.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(max_labelled) for y in (0, 1)]
    chosen = materialize(chosen[0].union(chosen[1]), "toxicity_labelled")
    labelled = texts.join(small(chosen), "doc_id").select("txt", "toxic", F.xxhash64("txt").alias("same"))
    voters = Voters.build(mine_terms(labelled.dropDuplicates(["same", "toxic"])))

    seen = materialize(read_documents(texts, voters.terms, ["doc_id"]), "toxicity_seen")
    label_model = fit_label_model(seen, voters)
    n_terms = len(voters.terms)

    sample = seen.filter(learn).orderBy(order, "doc_id").limit(max_fit).select("hits", "numbers").toArrow()
    linear = None
    if sample.num_rows:
        rb = sample.combine_chunks().to_batches()[0]
        hits, numbers = _dense(rb, n_terms)
        goal = label_model.posterior(voters.fired(hits, numbers))
        linear = fit_linear(voters.features(hits, numbers), lambda f: (sigmoid(f) - goal) / len(goal), l2=1e-5, steps=400, rate=0.1, standardise=False)
    model = ToxicityModel(voters, label_model, linear)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, 4000):
                part = rb.slice(at, 4000)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(*_dense(part, n_terms)))], ["doc_id", "score"])

    return seen.mapInArrow(run, T.StructType([texts.schema["doc_id"], T.StructField("score", T.DoubleType())]))
