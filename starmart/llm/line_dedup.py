"""Line dedup by pairwise alignment: blocks of lines that an earlier document has go from later ones.

1. Documents become arrays of line hashes (lines between ``\\n``, compared without outer blanks).
2. Partners come from *windows*: neighbouring lines that just reach :data:`BLOCK_WORDS` words, from
   each line on and up to each line, whatever the lines' lengths, and counted within the document, so
   that the second copy of a window is another key than the first.  Every line of a common block of
   enough words is in a window that lies in the block, so documents without an equal window have no
   block to delete.  A window that few documents have (:data:`RARE_DOCS`) pairs each with every
   earlier one; one that more have pairs each with its first holder.  Where the alignment with the
   first holder leaves out such a window (the documents have their passages in another order), the
   next holders follow, one in each of :data:`ROUNDS` rounds, then all that are left at once.  So the
   pairs are linear in the lines but for frequent windows that no alignment of the rounds takes, and
   the result is that of aligning each document with every earlier one (but for one case: a second
   copy of a frequent window meets earlier documents that have two, not each that has one).
3. Each pair is aligned by patience diff: the longest rising run of lines that are unique on both
   sides, widened line by line, then again in the gaps.  In a gap without such lines the common lines
   of the fewest occurrences take their place, the first with the first, the second with the second.
4. An aligned block (neighbouring lines on both sides) of at least :data:`BLOCK_WORDS` words is
   deleted from the later document.  Blocks are taken from the documents as they were; since every
   deleted line is in an earlier document, the first document with a line keeps it.

Earlier means a smaller id; documents without id come first; equal ids are ordered by a hash of the
text.  Rows with the same id and text are one document and are treated alike.

Words are what blanks separate; of scripts written without blanks two letters count as a word (a line
counts the greater of the two numbers).  Other text without blanks (a long code or URL) is one word a line.

Edge cases: null texts stay null, empty ones empty; an exact copy of an earlier document of enough
words loses all its lines (its text is then empty); very long documents are handled line by line in
time n log n but for badly repetitive gaps; an empty table gives an empty result; other columns
pass through, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import few_files, materialize

RARE_DOCS = 6
BLOCK_WORDS = 30
#: Rounds in which a frequent window that is still there is aligned with one more holder; what they leave is aligned with all.
ROUNDS = 3
#: Letters of scripts that are written without blanks (Thai, Lao, Burmese, Khmer, kana, Han); two count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: An odd number and its inverse modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given by rising first, that also rises in the second."""
    tops, at, back = [], [], [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        i = bisect_left(tops, j)
        tops[i : i + 1], at[i : i + 1] = [j], [k]
        back[k] = at[i - 1] if i else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def aligned_blocks(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int, int]]:
    """Patience diff of two sequences: blocks (start in a, start in b, length), in order, as long as they go."""
    match: dict[int, int] = {}
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, i_end, j, j_end = gaps.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            match[i] = j
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            match[i_end] = j_end
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        often = {h: max(n, in_b[h]) for h, n in in_a.items() if h in in_b}
        if not often:
            continue
        few = min(often.values())  # 1 if there are lines that are unique on both sides
        turns: dict[int, list[int]] = {h: [] for h, n in often.items() if n == few}
        for y in range(j_end - 1, j - 1, -1):
            if b[y] in turns:
                turns[b[y]].append(y)
        anchors = _rising([(x, turns[a[x]].pop()) for x in range(i, i_end) if turns.get(a[x])])
        last = (i, j)
        for x, y in anchors:
            gaps.append((last[0], x, last[1], y))
            last = (x, y)  # the anchor itself is the first match of the next gap
        gaps.append((last[0], i_end, last[1], j_end))
    blocks: list[list[int]] = []
    for x in sorted(match):
        y = match[x]
        if blocks and blocks[-1][0] + blocks[-1][2] == x and blocks[-1][1] + blocks[-1][2] == y:
            blocks[-1][2] += 1
        else:
            blocks.append([x, y, 1])
    return [tuple(x) for x in blocks]


def _words(line: bytes) -> int:
    n = len(line.split())
    return n if line.isascii() else max(n, -(-len(_UNSPACED.findall(line.decode())) // 2))


def _lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = text.encode().split(b"\n")
    hashes = np.fromiter((xxhash.xxh64_intdigest(x.strip()) for x in raw), np.uint64, len(raw)).view(np.int64)
    words = map(_words, raw) if _UNSPACED.search(text) else (len(x.split()) for x in raw)
    return hashes, np.fromiter(words, np.int32, len(raw))


def line_table(docs: DataFrame) -> DataFrame:
    """``doc`` (id and text hash), ``hashes``, ``words``: the lines of each document with a text."""
    doc_type = T.StructType([docs.schema["doc_id"], T.StructField("text_key", T.LongType())])
    schema = T.StructType([T.StructField("doc", doc_type), T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("words", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, 2000):
                part = rb.slice(at, 2000)
                each = [_lines(t) for t in part.column("txt").to_pylist()]
                ends = pa.array(np.cumsum([0, *[len(h) for h, _ in each]]).astype(np.int32))
                hashes = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([h for h, _ in each])))
                words = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([w for _, w in each])))
                yield pa.RecordBatch.from_arrays([part.column("doc"), hashes, words], ["doc", "hashes", "words"])

    given = docs.filter(F.col("text").isNotNull()).select(F.struct("doc_id", F.xxhash64("text").alias("text_key")).alias("doc"), F.col("text").alias("txt"))
    return given.mapInArrow(run, schema)


def _windows(hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, start and end of the windows that just reach the words of a block, from each line on and up to each line.
    Which windows there are depends on their own lines only, so equal blocks of two documents have equal windows."""
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    n = len(words)
    if total[-1] < BLOCK_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.searchsorted(total, total[:-1] + BLOCK_WORDS, "left")
    starts = np.searchsorted(total, total[1:] - BLOCK_WORDS, "right") - 1
    onward, upward = np.flatnonzero(ends <= n), np.flatnonzero(starts >= 0)
    spans = np.unique(np.concatenate([onward * (n + 1) + ends[onward], starts[upward] * (n + 1) + upward + 1]))
    start, end = spans // (n + 1), spans % (n + 1)
    # Sums of hashes times powers of an odd number; times the inverse power of the start they depend on the lines alone.
    up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]), dtype=np.uint64) for x in (_BASE, _INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * up[:n], dtype=np.uint64)])
    key = (sums[end] - sums[start]) * down[start]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    turn = np.empty(len(key), np.uint64)
    turn[order] = np.arange(len(key)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    key = (key ^ (key >> np.uint64(31))) * _BASE + turn * _INVERSE
    return key.view(np.int64), start, end


def window_table(lines: DataFrame) -> DataFrame:
    """``doc``, ``key``: the windows of each document."""
    schema = T.StructType([lines.schema["doc"], T.StructField("key", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, 2000):
                part = rb.slice(at, 2000)
                each = [_windows(h.values.to_numpy(), w.values.to_numpy())[0] for h, w in zip(part.column("hashes"), part.column("words"))]
                of = np.repeat(np.arange(len(each)), [len(k) for k in each])
                yield pa.RecordBatch.from_arrays([part.column("doc").take(pa.array(of)), pa.array(np.concatenate(each))], ["doc", "key"])

    return lines.select("doc", "hashes", "words").mapInArrow(run, schema)


def _shared_windows(lines: DataFrame) -> DataFrame:
    """``key``, ``doc``, ``first``, ``holders``: the windows that several documents have."""
    windows = window_table(lines)
    holders = windows.groupBy("key").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    return materialize(windows.join(holders, "key"), "dedup_shared_windows")


def _pairs(shared: DataFrame) -> DataFrame:
    """``later``, ``earlier``: documents to align first."""
    rare = shared.filter(F.col("holders") <= RARE_DOCS).groupBy("key").agg(F.sort_array(F.collect_list("doc")).alias("docs"))
    rare = rare.select("docs").distinct().select(F.posexplode("docs").alias("at", "later"), "docs").filter("at > 0")
    rare = rare.select("later", F.explode(F.slice("docs", F.lit(1), F.col("at"))).alias("earlier"))
    often = shared.filter((F.col("holders") > RARE_DOCS) & (F.col("doc") != F.col("first")))
    return rare.union(often.select(F.col("doc").alias("later"), F.col("first").alias("earlier"))).distinct()


def _aligned(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """``doc``, ``earlier``, ``start``, ``length`` of the blocks to delete (``key`` is null), and of the windows
    (with ``key``) that both documents have and no such block covers; written."""
    wide = pairs.join(lines.select(F.col("doc").alias("earlier"), F.col("hashes").alias("a"), F.col("words").alias("wa")), "earlier")
    wide = wide.join(lines.select(F.col("doc").alias("later"), F.col("hashes").alias("b"), F.col("words").alias("wb")), "later")
    doc_type = lines.schema["doc"].dataType
    schema = T.StructType([T.StructField("doc", doc_type), T.StructField("earlier", doc_type), T.StructField("start", T.IntegerType()),
                           T.StructField("length", T.IntegerType()), T.StructField("key", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            out = []
            cols = [rb.column(c) for c in ("a", "wa", "b", "wb")]
            for r in range(rb.num_rows):
                a, wa, b, wb = (c[r].values.to_numpy() for c in cols)
                total = np.concatenate([[0], np.cumsum(wb)])
                blocks = [(s, n) for _, s, n in aligned_blocks(a.tolist(), b.tolist()) if total[s + n] - total[s] >= BLOCK_WORDS]
                out += [(r, s, n, None) for s, n in blocks]
                if sum(n for _, n in blocks) == len(b):
                    continue
                key, start, end = _windows(b, wb)
                both = np.isin(key, _windows(a, wa)[0])
                block_of = np.full(len(b), -1)
                for k, (s, n) in enumerate(blocks):
                    block_of[s : s + n] = k
                both &= (block_of[start] < 0) | (block_of[start] != block_of[end - 1])
                out += [(r, int(start[k]), int(end[k] - start[k]), int(key[k])) for k in np.flatnonzero(both)]
            rows, starts, lengths, keys = zip(*out) if out else ([], [], [], [])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([rb.column("later").take(at), rb.column("earlier").take(at), pa.array(starts, pa.int32()),
                                              pa.array(lengths, pa.int32()), pa.array(keys, pa.int64())], ["doc", "earlier", "start", "length", "key"])

    return materialize(wide.select("later", "earlier", "a", "wa", "b", "wb").mapInArrow(run, schema), "dedup_aligned")


def _uncovered(left: DataFrame, blocks: DataFrame) -> DataFrame:
    b = blocks.select(F.col("doc").alias("in_doc"), F.col("start").alias("s"), (F.col("start") + F.col("length")).alias("e")).distinct()
    return left.join(b, (F.col("doc") == F.col("in_doc")) & (F.col("s") <= F.col("start")) & (F.col("e") >= F.col("start") + F.col("length")), "left_anti")


def common_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` (id and text hash of the later document), ``start``, ``length``: line ranges to delete, with ``earlier``."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = materialize(few_files(line_table(docs).dropDuplicates(["doc"]), docs.count()), "dedup_lines")
    shared = _shared_windows(lines)
    found = _aligned(_pairs(shared), lines)
    blocks = found.filter(F.col("key").isNull()).drop("key")
    often = shared.filter(F.col("holders") > RARE_DOCS)
    tried = often.select("key", F.col("first").alias("tried")).distinct()
    left = found.filter(F.col("key").isNotNull()).select("doc", "start", "length", "key").distinct().join(tried, "key")
    for turn in range(ROUNDS + 1):
        left = materialize(_uncovered(left, blocks if turn == 0 else now), "dedup_left_windows")
        if left.isEmpty():
            break
        asked = left.groupBy("key").agg(F.min("tried").alias("tried"), F.max("doc").alias("last"))
        others = often.select("key", "doc").join(asked, "key").filter((F.col("doc") > F.col("tried")) & (F.col("doc") < F.col("last")))
        others = others.select("key", F.col("doc").alias("earlier"))
        if turn < ROUNDS:
            others = others.groupBy("key").agg(F.min("earlier").alias("earlier"))
        left = left.join(others, "key").filter(F.col("earlier") < F.col("doc"))
        now = _aligned(left.select(F.col("doc").alias("later"), "earlier").distinct(), lines).filter(F.col("key").isNull()).drop("key")
        blocks = blocks.union(now)
        left = left.select("key", "doc", "start", "length", F.col("earlier").alias("tried"))
    return blocks


def delete_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", result: str = "deleted_lines") -> DataFrame:
    """All columns of ``df`` with the text without its deleted lines, and a last column ``result`` (how many;
    0 if none), which must not be the name of another column."""
    blocks = common_blocks(df, id_col, text_col).select("doc", "start", "length").distinct()
    gone = blocks.groupBy("doc").agg(F.collect_list(F.struct("start", "length")).alias("ranges"))
    gone = gone.select(F.col("doc.doc_id").alias("gone_id"), F.col("doc.text_key").alias("gone_key"), "ranges")
    gone = materialize(few_files(gone, df.count()), "dedup_ranges")

    def cut(text: str | None, ranges) -> tuple | None:
        if ranges is None:
            return None
        lines, drop = text.split("\n"), set()
        for r in ranges:
            drop.update(range(r["start"], r["start"] + r["length"]))
        return "\n".join(x for i, x in enumerate(lines) if i not in drop), len(drop)

    # Marked as nondeterministic so that a filter on its results stays behind it: pushed down, it would cut every text twice, in two Python workers a task.
    cut = F.udf(cut, T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType())]), useArrow=True).asNondeterministic()
    names = df.columns
    wide = df.select(F.struct(*[F.col(c) for c in names]).alias("row"))
    row_id, row_text = F.col("row").getField(id_col), F.col("row").getField(text_col)
    # Always by a shuffle of the texts: the ranges grow with the corpus, and one plan holds at every size.
    wide = wide.join(gone.hint("merge"), F.xxhash64(row_text).eqNullSafe(F.col("gone_key")) & row_id.eqNullSafe(F.col("gone_id")), "left")
    wide = wide.select("row", cut(F.when(F.col("ranges").isNotNull(), row_text), "ranges").alias("cut"))
    new_text = F.when(F.col("cut").isNotNull(), F.col("cut.text")).otherwise(row_text)
    return wide.select(*[new_text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in names],
                       F.coalesce(F.col("cut.n"), F.lit(0)).alias(result))
