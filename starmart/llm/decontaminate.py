"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

Short test items are looked for inside long documents by containment: the share of an item's 5-word
shingles that the document has.

1. Both sides become sets of 64-bit shingle hashes (lower case A-Z; words ``[^\\x20\\x09-\\x0D]+``;
   a text of one to four words is one shingle, as a whole).
2. Documents are partitioned by the size of their set, in powers of two.  The partition of sets of
   up to 2^k shingles has its own one-permutation MinHash: the hash range is cut into 2^(k+1) bins,
   and a set's signature has the smallest hash of each bin that is not empty.  The signature grows
   with the size class, so a bin of a document holds half a shingle on average at most, however long
   the document is; plain MinHash of a fixed length cannot find short items in long texts.
3. A document is a candidate for an item if both have the same smallest hash in a bin, under the
   bins of the document's partition.  Bins of larger classes are halves of those before, so an item's
   hash that opens its bin in one class does so in all larger ones: an item has one row per hash with
   the class from which it holds, instead of a signature per class.
4. Candidates are verified exactly: the document's shingles as texts against the item's.

A common shingle is missed only if the document has a smaller hash in its bin, with a probability of
0.21 at most and each shingle by itself.  An item is a candidate unless all its common shingles are
missed: 0.21 ** 9 (8e-7) at most.  Items for which fewer than nine common shingles are enough
(:data:`SURE`; up to ten shingles at four fifths) are left out of the search and found exactly: each of
their hashes is compared with all hashes of the documents.  ``rounds`` adds independent hash functions.

A shingle that very many documents have costs one row per document and item that has it, so the work
is linear in the documents.  The item side is broadcast only if it has few rows (counted first,
:data:`BROADCAST_ROWS`); a larger benchmark is joined by a shuffle.

Edge cases: null and empty texts have no shingles and are found nowhere; items of fewer than five
words are found only in documents with the same words and no others; repeated items and documents
give a row each; an empty side gives an empty result; only id and text columns are read, whatever
other columns there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import few_files, materialize
from .tables import free_name, small, word_array

SHINGLE = 5
#: Share of an item's shingles that a document must have, in hundredths.
CONTAINED = 80
#: Items that fewer common shingles make a hit are found exactly.
SURE = 9
#: Item rows (one per shingle) up to which they are broadcast: 32 bytes each, so some 32 MB.
BROADCAST_ROWS = 1_000_000


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(words: Column) -> Column:
    """Distinct 64-bit hashes of the five-word windows; the whole sequence if it is shorter."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    return F.array_distinct(F.when(F.size(words) >= SHINGLE, windows).when(F.size(words) > 0, F.array(F.xxhash64(F.lit(-1), words)))
                            .otherwise(F.array().cast("array<bigint>")))


def shingle_texts(words: Column) -> Column:
    """The same shingles as texts; words hold no blank, so joining by a blank is one to one."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1), lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))
    return F.array_distinct(F.when(F.size(words) >= SHINGLE, windows).when(F.size(words) > 0, F.array(F.array_join(words, " ")))
                            .otherwise(F.array().cast("array<string>")))


def size_class(n: Column) -> Column:
    """Smallest k with n <= 2^k."""
    return F.coalesce(F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int"), F.lit(0))


def _mixed(hashes: Column, round_: int) -> Column:
    return F.sort_array(hashes if round_ == 0 else F.transform(hashes, lambda h: F.xxhash64(F.lit(round_), h)))


def signatures(sets: DataFrame, key: str, rounds: int) -> DataFrame:
    """``key``, class, hash: the one-permutation MinHash of each set ``hashes`` under its size class."""
    # No filter on computed arrays anywhere here: Spark would push it below the projections and
    # evaluate their expressions again, inside the lambdas.  explode_outer and a class that is never
    # null keep it from inferring one.
    d = sets.withColumn("klass", size_class(F.size("hashes")))
    out = None
    for r in range(rounds):
        one = d.select(key, "klass", _mixed(F.col("hashes"), r).alias("ordered")).withColumn("shift", 63 - F.col("klass"))
        opens = F.filter("ordered", lambda h, i: (i == 0) | (
            F.call_function("shiftright", h, F.col("shift")) != F.call_function("shiftright", F.get(F.col("ordered"), i - 1), F.col("shift"))))
        one = one.select(key, "klass", F.explode_outer(opens).alias("hash"))
        out = one if out is None else out.unionAll(one)
    return out


def item_rows(sets: DataFrame, key: str, rounds: int) -> DataFrame:
    """``key``, hash and ``from_class``: the smallest size class in which the hash opens its bin."""
    out = None
    for r in range(rounds):
        one = sets.select(key, _mixed(F.col("hashes"), r).alias("ordered"))
        rows = F.transform("ordered", lambda h, i: F.struct(
            h.alias("hash"), F.when(i == 0, 0).otherwise(64 - F.length(F.bin(h.bitwiseXOR(F.get(F.col("ordered"), i - 1))))).alias("from_class")))
        one = one.select(key, F.explode_outer(rows).alias("x")).select(key, "x.hash", "x.from_class")
        out = one if out is None else out.unionAll(one)
    return out


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", contained: int = CONTAINED, rounds: int = 1) -> DataFrame:
    """Documents that contain an item to ``contained`` hundredths or more: doc_id, text_key (a hash of
    the text), item_id, n_item_shingles, n_shared; one row per document row and different item."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("t"))
    d = d.filter(F.col("t").isNotNull())
    i = items.select(F.col(item_id_col).alias("item_id"), _lower(F.col(item_text_col)).alias("t")).distinct()
    i = i.select(F.xxhash64("item_id", "t").alias("item_key"), "item_id", word_array(F.col("t")).alias("w"))
    i = i.select("item_key", "item_id", shingle_hashes(F.col("w")).alias("hashes"), shingle_texts(F.col("w")).alias("item_shingles"))
    i = materialize(few_files(i, items.count()), "benchmark_items")
    # No hash, no hit: items without words are in neither.
    is_short = contained * F.size("hashes") <= 100 * (SURE - 1)
    needles = materialize(item_rows(i.filter(~is_short), "item_key", rounds), "benchmark_hashes")
    if needles.count() <= BROADCAST_ROWS:
        needles = F.broadcast(needles)
    whole = materialize(i.filter(is_short).select("item_key", F.explode("hashes").alias("hash")), "benchmark_short_hashes")
    n_whole = whole.count()

    sets = d.select("text_key", word_array(_lower(F.col("t"))).alias("w")).select("text_key", shingle_hashes(F.col("w")).alias("hashes"))
    found = signatures(sets, "text_key", rounds).join(needles, "hash").filter(F.col("klass") >= F.col("from_class")).select("text_key", "item_key")
    if n_whole:
        every = sets.select("text_key", F.explode_outer("hashes").alias("hash"))
        every = every.join(F.broadcast(whole) if n_whole <= BROADCAST_ROWS else whole, "hash")
        found = found.unionAll(every.select("text_key", "item_key"))
    found = materialize(found.distinct(), "benchmark_candidates")

    # Exact check: each candidate document's shingles once, then against each of its items.
    wanted = found.groupBy("text_key").agg(F.collect_set("item_key").alias("item_keys"))
    texts = d.join(wanted, "text_key").withColumn("w", word_array(_lower(F.col("t"))))
    texts = texts.select("doc_id", "text_key", "item_keys", shingle_texts(F.col("w")).alias("shingles"))
    pairs = texts.select("doc_id", "text_key", "shingles", F.explode("item_keys").alias("item_key"))
    pairs = pairs.join(i.select("item_key", "item_id", "item_shingles"), "item_key")
    pairs = pairs.select("doc_id", "text_key", "item_id", F.size("item_shingles").cast("bigint").alias("n_item_shingles"),
                         F.size(F.array_intersect("item_shingles", "shingles")).cast("bigint").alias("n_shared"))
    pairs = materialize(pairs, "benchmark_checked")  # so that the filter stays above the shingles
    return pairs.filter(100 * F.col("n_shared") >= contained * F.col("n_item_shingles"))


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents, all columns, that contain no item; those with a null text stay."""
    key = free_name(docs, "contaminated_text_key")
    hits = find_items(docs, items, id_col, text_col, **how).select(F.col("text_key").alias(key))
    hits = small(materialize(few_files(hits.distinct(), hits.count()), "benchmark_hits"))
    return docs.join(hits, F.xxhash64(F.col(text_col)) == F.col(key), "left_anti")
