"""Spelling variant grouping: words one edit apart, found through pivotal grams.

Words are counted over all texts (:func:`noisy_words`), combined per batch before the exchange.

Pairs.  Bigrams are ordered by the number of words that have them, rare ones first.  A word's prefix
has its three first bigrams in that order (rank, then position); its pivots are two prefix bigrams
that don't overlap, chosen by dynamic programming for the smallest sum of frequencies.  One edit
destroys one of two disjoint pivots at most, so of two words one edit apart the one whose prefix ends
earlier keeps a pivot inside the prefix of the other, moved by one position at most (hence a prefix
also has the last bigram's next neighbour, if that is the same bigram: a run of one letter).

Index.  Pivots are indexed with position limits: the edit lies on one side of the surviving pivot, in
the nearer or in the farther half of that side, and everything else is the same in both words.  So a
pivot at ``p`` of a word of length ``n`` gives four keys (side, half; n, p and the text that is the
same), and a prefix bigram gives the keys that a word of length n - 1, n or n + 1 would have for it.
Words that meet on a key are verified by their edit distance in the join itself; a key's words are
those that share more than half of their letters, so no key collects the words of a frequent bigram.

Forms.  A word's form is its near word of the largest count (ties: the smallest in code-point order),
if that is at least twice its own.  Counts double at each step, so pointer jumping follows the chains
in a few rounds.

Edge cases: null and empty texts have no words; a null id counts as the empty text in the hash; very
long runs are words like others (their bigrams cost time in proportion to their length); repeated
rows count each; an empty table or no word frequent enough gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Runs of letters, and the letters that are lower-cased.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Words of a batch of keys.
BATCH_WORDS = 5_000


def noisy_word(doc_id, word: str, every: int) -> str:
    """The word, or without one of its code points if ``every`` divides the crc32 of ``<doc_id>:<word>``."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def noisy_words(df: DataFrame, id_col: str, text_col: str, every: int, min_length: int, min_count: int) -> DataFrame:
    """``word`` and ``n`` of the words of at least ``min_length`` code points and ``min_count`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            total: Counter[str] = Counter()
            for doc_id, text in zip(rb.column(0).to_pylist(), rb.column(1), strict=True):
                for word, n in Counter(RUN.findall((text.as_py() or "").translate(LOWER))).items():
                    found = noisy_word(doc_id, word, every)
                    if len(found) >= min_length:
                        total[found] += n
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    given = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    counts = given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts.filter(F.col("n") >= min_count), "spelling_words")


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """Number of words with each bigram; the alphabet has 90 letters, so at most 8,100 rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            total = Counter(g for w in rb.column(0).to_pylist() for g in set(map(str.__add__, w, w[1:])))
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["gram", "n"])

    each = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in each.collect()}


def prefix_grams(word: str, rank: Mapping[str, int]) -> list[tuple[int, int]]:
    """(rank, position) of the three first bigrams in the order."""
    if len(word) > 64:  # the rarest bigrams without a sorted list of all
        import heapq

        return heapq.nsmallest(3, ((rank[word[i : i + 2]], i) for i in range(len(word) - 1)))
    return sorted((rank[word[i : i + 2]], i) for i in range(len(word) - 1))[:3]


def pivot_positions(prefix: list[tuple[int, int]], weight: list[int], pivots: int = 2) -> list[int]:
    """The positions of ``pivots`` disjoint bigrams of the prefix with the smallest sum of weights by rank.

    best[m] holds (sum, positions) of m disjoint bigrams among those that end before the current one."""
    at = sorted((p, weight[r]) for r, p in prefix)
    done: list[list[tuple[int, list[int]]]] = []  # per bigram and m: the best choice that ends with it or before
    for i, (p, w) in enumerate(at):
        before = max((j for j in range(i) if at[j][0] + 2 <= p), default=None)
        row: list[tuple[int, list[int]]] = [(0, [])]
        for m in range(1, pivots + 1):
            options = [done[i - 1][m]] if i and len(done[i - 1]) > m else []
            if m == 1:
                options.append((w, [p]))
            elif before is not None and len(done[before]) >= m:
                s, chosen = done[before][m - 1]
                options.append((s + w, [*chosen, p]))
            if not options:
                break
            row.append(min(options))
        done.append(row)
    return done[-1][pivots][1]


def _key(side: int, n: int, p: int, a: str, b: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{side},{n},{p},{len(a)}:{a}{b}")


def pivot_keys(word: str, positions: list[int]) -> list[int]:
    n, keys = len(word), []
    for p in positions:
        far = p + 2 + (n - p - 2) // 2  # an edit to the right lies before or behind ``far``
        keys += [_key(0, n, p, word[:far]), _key(1, n, p, word[: p + 2], word[far:])]
        mid = p // 2  # an edit to the left lies before or behind ``mid``
        keys += [_key(2, n, p, word[mid:]), _key(3, n, p, word[:mid], word[p:])]
    return keys


def prefix_keys(word: str, prefix: list[tuple[int, int]]) -> list[int]:
    """The keys under which a pivot of a word one edit away would meet this word's prefix bigrams."""
    length, keys, places = len(word), set(), [q for _, q in prefix]
    last = prefix[-1][1]
    if word[last : last + 2] == word[last + 1 : last + 3]:
        places.append(last + 1)
    for q in places:
        for n in (length - 1, length, length + 1):  # of the other word
            if q + 2 <= n:
                far = q + 2 + (n - q - 2) // 2
                keys |= {_key(0, n, q, word[:far]), _key(1, n, q, word[: q + 2], word[length - (n - far) :] if n > far else "")}
            p = q + n - length
            if 0 <= p <= n - 2:
                mid = p // 2
                keys |= {_key(2, n, p, word[q - (p - mid) :]) if q >= p - mid else 0, _key(3, n, p, word[:mid], word[q:])}
    return list(keys)


def _keyed(words: DataFrame, counts: Mapping[str, int], pivots: bool) -> DataFrame:
    """``key``, ``word``, ``n``: a row for each key of a word's pivots, or of its prefix."""
    order = sorted(counts, key=lambda g: (counts[g], g))
    rank, weight = {g: i for i, g in enumerate(order)}, [counts[g] for g in order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for start in range(0, rb.num_rows, BATCH_WORDS):
                some, keys, sizes = rb.slice(start, BATCH_WORDS), [], []
                for word in some.column(0).to_pylist():
                    prefix = prefix_grams(word, rank)
                    found = pivot_keys(word, pivot_positions(prefix, weight)) if pivots else prefix_keys(word, prefix)
                    keys += found
                    sizes.append(len(found))
                at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), some.column(0).take(at), some.column(1).take(at)], ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``other``, ``other_n``: all pairs of words one edit apart, both ways, each once."""
    counts = bigram_counts(words)
    a, b = _keyed(words, counts, True).alias("a"), _keyed(words, counts, False).alias("b")
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.word") != F.col("b.word")) & (F.levenshtein("a.word", "b.word", 1) == 1)
    found = a.join(b, near)
    both = F.array(F.struct(F.col("a.word").alias("word"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n")),
                   F.struct(F.col("b.word").alias("word"), F.col("a.word").alias("other"), F.col("a.n").alias("other_n")))
    return found.select(F.explode(both).alias("x")).select("x.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for the words that have a form: the last one of the chain, by pointer jumping."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = materialize(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_roots")
        roots = jumped.select("word", "root")
        if not jumped.filter("moved").limit(1).count():
            return roots


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97, min_length: int = 5, min_count: int = 3, factor: int = 2) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` per word; ``min_length`` is 4 or more."""
    if min_length < 4:
        raise ValueError("words of less than 4 letters need not have two disjoint bigrams beside a third")
    words = noisy_words(df, id_col, text_col, every, min_length, min_count)
    best = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    judged = words.join(best, "word", "left").withColumn("has_form", F.coalesce(-F.col("best.less") >= factor * F.col("n"), F.lit(False)))
    judged = materialize(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(F.col("has_form"), F.col("best.other")).alias("form"),
                                       F.when(F.col("has_form"), -F.col("best.less")).alias("form_n")), "spelling_forms")
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
