"""Removal of repeated byte strings by threshold-bounded interval expansion on Burrows-Wheeler transforms.

Every byte goes that a string of ``length`` bytes covers which starts anywhere else too, in the same
or another text; strings are judged on the input, overlaps count, matches never cross texts.

1. Texts.  Equal texts are brought together once (key: 96 bits of hashes) and written in buckets by
   key, so the later joins with them move only their small side.  A text with copies is repeated as a
   whole; a hot group of copies is one row from here on.
2. Anchors.  The *anchor* of a window of ``length`` bytes is the smallest hash of its :data:`GRAM`-byte
   strings: equal windows have equal anchors.  Neighbouring windows with the same anchor make a
   *context*, one row (anchor, hash of its bytes, place) for some 85 bytes of text.  Contexts that
   repeat within a batch are settled there and sent once.  Contexts that meet an equal one are repeated
   as a whole; those whose anchor nobody else has are not; the others have to be compared.
3. Comparison.  One copy of each such context goes, with its bytes, to the block of its anchor.  A block
   of contexts gets a suffix array and its Burrows-Wheeler transform.  Starting with the interval of the
   empty string, each level extends all its intervals backwards by every byte that precedes them; where
   the end of a new interval has no value yet, the common prefix there is as long as the level, and the
   interval goes to the next one.  So values come in increasing order, and the expansion stops at
   ``length``: places without a value then are between windows that are equal in ``length`` bytes.
4. Cutting.  Spans are united per text and cut out.

Hot anchors.  Anchors with more different contexts than :data:`HOT_CONTEXTS` (near copies by the
million, what stands around a frequent passage) get finer ones: by the place of the anchor in the window
windows fall into :data:`CLASSES` classes, all windows of a class hold the same bytes around the anchor,
and the hash of these is the finer anchor.  Equal windows have equal finer anchors, and a context whose
finer anchor nobody else has ends there.  Where even these are hot, each window is a context by itself,
which meets equal ones only.  An anchor that the batches did not show to be hot is compared block after
block in its task; windows that such a block has once are matched with those of its other blocks by a
hash of their bytes.

Edge cases: a null text is the empty text; texts shorter than ``length`` keep everything and match
nothing; long runs of one byte are one context in pieces; very long texts are read in overlapping
segments; repeated rows and ids are rows like others (equal texts repeat each other); an empty table
gives an empty result; only id and text are read, whatever other columns there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import written_in_buckets

#: Bytes of the strings of which a window's smallest hash is its anchor.
GRAM = 32
#: Bytes of text that the hashes are computed for at once.
SEGMENT = 1 << 20
#: Windows of a context, at most (reached in runs of one byte or a short period only).
PIECE = 1024
#: Bytes of contexts with one suffix array.
BLOCK_BYTES = 1 << 20
#: An anchor with this many different contexts in one batch is counted, and with this many in all it is hot.
HOT_IN_BATCH, HOT_CONTEXTS = 4, 4000
#: Hot anchors, at most (the most frequent ones); others are compared block after block.
HOT_ANCHORS = 100_000
#: Finer anchors of a hot one.
CLASSES = 4
#: Bytes of text of an exchange partition.
PART_BYTES = 64 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _M1
    size = 1
    while size < GRAM:
        x = h[: len(h) - size]
        h = ((x ^ (x >> np.uint64(29))) * _M2 + h[size:]) * _M1
        size *= 2
    return h ^ (h >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Smallest or largest of each ``width`` neighbours."""
    done, n = 1, len(x) - width + 1
    while 2 * done <= width:
        x = pick(x[: len(x) - done], x[done:])
        done *= 2
    return pick(x[:n], x[width - done : width - done + n])


def contexts_of(raw: bytes, length: int, segment: int = SEGMENT) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (anchor, first window, last window, whether the anchor occurs twice in the context, its first place) of a text."""
    width = length - GRAM + 1
    for start in range(0, max(0, len(raw) - length + 1), segment):
        data = np.frombuffer(raw, np.uint8, min(len(raw) - start, segment + length - 1), start)
        hashes = _gram_hashes(data)
        least = _sliding(hashes, width, np.minimum)
        n = len(least)
        at = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        end = np.append(at[1:], n)
        pieces = -(-(end - at) // PIECE)
        if pieces.max() > 1:  # cut long contexts
            of = np.repeat(np.arange(len(at)), pieces)
            no = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            at, end = at[of] + no * PIECE, np.minimum(end[of], at[of] + (no + 1) * PIECE)
        anchor = least[at]
        # places whose hash is the smallest of a window; how many of a context's are its anchor
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        chosen = np.flatnonzero(_sliding(padded, width, np.maximum) == hashes)
        values, of = np.unique(hashes[chosen], return_inverse=True)
        scale = len(data) + 1
        places = np.sort(of * scale + chosen)
        base = np.searchsorted(values, anchor) * scale
        place = np.searchsorted(places, base + at)
        count = np.searchsorted(places, base + end - 1 + width) - place
        yield anchor.view(np.int64), at + start, end - 1 + start, count > 1, places[place] - base + start


def finer_contexts(raw: bytes, length: int, anchor: int, lo: int, hi: int, twice: bool, first: int) -> Iterator[tuple[int, int, int]]:
    """(finer anchor, first window, last window): the context's windows by the first place of the anchor in them and its class."""
    step = -(-(length - GRAM + 1) // CLASSES)
    places = [first]
    if twice:
        hashes = _gram_hashes(np.frombuffer(raw, np.uint8, hi - lo + length, lo))
        places = (np.flatnonzero(hashes.view(np.int64) == anchor) + lo).tolist()
    for p in places:
        last = min(hi, p)
        for c in range((p - last) // step, (p - lo) // step + 1):
            core = raw[p - c * step : p - (c + 1) * step + 1 + length]
            yield _signed(xxhash.xxh64_intdigest(core, c)), max(lo, p - (c + 1) * step + 1), min(last, p - c * step)
        lo = last + 1
        if lo > hi:
            break


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``data`` (0 ends a text, bytes are 1 to 256) sorted by their first ``depth`` values; texts end differently, in their order.

    Sorts by as many bytes as fit a key, then by the ranks of two or three neighbouring pieces at a time."""
    n, k = len(data), len(starts)
    text = np.repeat(np.arange(k), np.diff(np.append(starts, n)))
    end = np.append(starts[1:], n)[text] - 1
    place = np.arange(n)
    number = np.zeros(257, np.int64)
    number[1:] = np.cumsum(np.bincount(data, minlength=257)[1:] > 0)  # only bytes that occur
    bits = int(number[-1]).bit_length()
    small, done = number[data], 63 // bits
    key = small.copy()
    for i in range(1, done):
        follow = np.zeros(n, np.int64)
        follow[: max(n - i, 0)] = small[i:]
        follow[place + i > end] = 0
        key = (key << bits) | follow
    wide = (n + k).bit_length()
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if done >= depth or rank[order[-1]] == n - 1:
            return order
        key, pieces = rank, min(3, 63 // wide)
        for i in range(1, pieces):
            at = place + i * done
            key = (key << wide) | np.where(at > end, text, k + rank[np.minimum(at, n - 1)])
        done *= pieces


def _children(lo: np.ndarray, hi: np.ndarray, lf: np.ndarray, before: np.ndarray, after: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals of all strings with one byte more in front, of the intervals [lo, hi)."""
    size = hi - lo
    at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
    first, last, inside = before[at] < np.repeat(lo, size), after[at] >= np.repeat(hi, size), ~ends[at]
    return np.sort(lf[at[first & inside]]), np.sort(lf[at[last & inside]]) + 1


def repeated_windows(texts: list[bytes], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per text: whether its window from each place on starts anywhere else, and the number of its class.

    Windows are equal if their class is; -1 where the text ends before."""
    data = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.int64) + 1, 0) for t in texts])
    sizes = np.array([len(t) + 1 for t in texts])
    starts, n = np.cumsum(sizes) - sizes, int(sizes.sum())
    order = suffix_order(data, starts, length)
    bwt = data[order - 1]  # the first text is preceded by the last one's end
    by_byte = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_byte] = np.arange(n)
    before, after = np.full(n, -1), np.full(n, n)
    same = bwt[by_byte[1:]] == bwt[by_byte[:-1]]
    before[by_byte[1:][same]], after[by_byte[:-1][same]] = by_byte[:-1][same], by_byte[1:][same]
    ends = bwt == 0

    known = np.zeros(n + 1, bool)  # the common prefix with the place before is shorter than ``length``
    known[[0, n]] = True
    lo, hi = np.zeros(1, np.int64), np.full(1, n)
    for level in range(length):
        a, b = _children(lo, hi, lf, before, after, ends)
        if level == 0:  # each text's end is a string by itself
            a, b = np.concatenate([np.arange(len(texts)), a]), np.concatenate([np.arange(len(texts)) + 1, b])
        new = ~known[b]
        known[b] = True
        lo, hi = a[new], b[new]
        if not len(lo):
            break
    number = np.cumsum(known[:n]) - 1
    twice = np.bincount(number)[number] > 1
    repeated, cls = np.zeros(n, bool), np.full(n, -1)
    repeated[order], cls[order] = twice, number
    out = [(repeated[s : s + max(0, z - length)], cls[s : s + max(0, z - length)]) for s, z in zip(starts, sizes, strict=True)]
    return [r for r, _ in out], [c for _, c in out]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """[first, last] of each run of true places."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def text_key(raw: Column) -> list[Column]:
    """Two columns, ``key`` (64 bits) and ``check`` (31 more), of a text's bytes; null counts as empty."""
    raw = F.coalesce(raw.cast("binary"), F.lit(b""))
    return [F.xxhash64(raw).alias("key"), F.xxhash64(F.lit("check"), raw).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("check")]


def _distinct_texts(df: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """key, check, raw, copies of each different text, written in buckets by key; and the number of buckets."""

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            count = Counter(zip(rb.column("key").to_pylist(), rb.column("check").to_pylist(), strict=True))
            first = {k: i for i, k in reversed(list(enumerate(zip(rb.column("key").to_pylist(), rb.column("check").to_pylist(), strict=True))))}
            once = rb.take(pa.array([first[k] for k in count], pa.int64()))
            yield once.append_column("copies", pa.array(count.values(), pa.int64()))

    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    given = df.select(raw.alias("raw")).select(*text_key(F.col("raw")), "raw")
    size = given.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    once = given.mapInArrow(combined, "key long, check int, raw binary, copies long").repartition(parts, "key")
    texts = once.groupBy("key", "check").agg(F.first("raw").alias("raw"), F.sum("copies").alias("copies"))
    return written_in_buckets(texts, "suffix_texts", parts, "key"), parts


def _batches_of_bytes(rb: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(np.asarray(pc.binary_length(rb.column(column)), dtype=np.int64))
    at = 0
    while at < rb.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield rb.slice(at, stop - at)
        at = stop


def _batch_contexts(rb: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...] | None:
    """anchor, row, lo, hi, twice, first of the contexts of all texts."""
    cols: list[list[np.ndarray]] = [[] for _ in range(6)]
    for row, raw in enumerate(rb.column("raw")):
        for anchor, lo, hi, twice, first in contexts_of(raw.as_py(), length):
            for c, x in zip(cols, (anchor, np.full(len(lo), row), lo, hi, twice, first), strict=True):
                c.append(x)
    return tuple(np.concatenate(c) for c in cols) if cols[0] else None


def _hot_anchors(texts: DataFrame, length: int, in_batch: int, contexts: int) -> np.ndarray:
    """The anchors, and of these the finer ones, with many different contexts, sorted; counted where a batch has a few of them."""

    def frequent(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value, count = np.unique(anchors, return_counts=True)
        return value[count >= in_batch], count[count >= in_batch]

    def of_batch(rb: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray] | None:
        found = _batch_contexts(rb, length)
        if found is None:
            return None
        pick = np.flatnonzero(np.isin(found[0], frequent(found[0])[0]))
        seen: dict[tuple[int, bytes], None] = {}
        each, finer, held, at = [], [], b"", -1
        for anchor, row, lo, hi, twice, first in zip(*(x[pick].tolist() for x in found), strict=True):
            if row != at:
                held, at = rb.column("raw")[row].as_py(), row
            key = (anchor, xxhash.xxh3_64_digest(held[lo : hi + length]))
            if key not in seen:
                seen[key] = None
                each.append(anchor)
                finer += [f for f, _, _ in finer_contexts(held, length, anchor, lo, hi, twice, first)]
        (a, n), (b, m) = frequent(np.array(each, np.int64)), frequent(np.array(finer, np.int64))
        return np.concatenate([a, b]), np.concatenate([n, m])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rb in _batches_of_bytes(whole, "raw", 32 << 20):
                found = of_batch(rb)
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["anchor", "n"])

    counts = texts.select("raw").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= contexts).orderBy(F.desc("n"), "anchor").limit(HOT_ANCHORS).collect()
    return np.sort(np.array([r["anchor"] for r in rows], np.int64))


def _placed_contexts(texts: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    """Rows of contexts (anchor, ctx, n, twice, key, check, lo, hi), and of settled spans (anchor null, ctx a random number)."""
    schema = "anchor long, ctx int, n int, twice boolean, key long, check int, lo long, hi long"
    names = [x.split()[0] for x in schema.split(", ")]
    is_hot = set(hot.tolist())

    def of_batch(whole: pa.RecordBatch) -> pa.RecordBatch | None:
        found = _batch_contexts(whole, length)
        if found is None:
            return None
        anchor, row, lo, hi, twice, place = found
        raws, held, at = whole.column("raw"), b"", -1
        ctx = np.empty(len(row), np.uint32)
        for i, (r, a, b) in enumerate(zip(row.tolist(), lo.tolist(), hi.tolist(), strict=True)):
            if r != at:
                held, at = memoryview(raws[r].as_py()), r
            ctx[i] = xxhash.xxh32_intdigest(held[a : b + length])
        ctx = ctx.view(np.int32)
        copies = whole.column("copies").to_numpy(zero_copy_only=False)[row]
        order = np.lexsort((ctx, anchor))
        new = np.ones(len(order), bool)
        new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (ctx[order][1:] != ctx[order][:-1])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        n = np.minimum(np.bincount(group, weights=np.minimum(copies, 2)), 2).astype(np.int32)
        settled = np.flatnonzero((n[group] > 1) & (copies == 1))  # spans; texts with copies go as a whole
        once = order[new]
        finer = []
        if len(hot):
            dealt = np.isin(anchor[once], hot)
            for i in np.sort(once[dealt]).tolist():
                if row[i] != at:
                    held, at = raws[int(row[i])].as_py(), row[i]
                for f, a, b in finer_contexts(bytes(held), length, int(anchor[i]), int(lo[i]), int(hi[i]), bool(twice[i]), int(place[i])):
                    for x, y in [(w, w) for w in range(a, b + 1)] if f in is_hot else [(a, b)]:
                        part = held[x : y + length]
                        finer.append((_signed(xxhash.xxh64_intdigest(part, 99)) if f in is_hot else f, xxhash.xxh32_intdigest(part), n[group[i]], row[i], x, y))
            once = once[~dealt]
        f_anchor, f_ctx, f_n, f_row, f_lo, f_hi = (np.array(x, np.int64) for x in (zip(*finer, strict=True) if finer else [[]] * 6))
        k = len(once) + len(finer)
        rows = whole.select(["key", "check"]).take(pa.array(np.concatenate([row[once], f_row, row[settled]])))
        mask = np.arange(rows.num_rows) >= k
        spread = (_M1 * (row[settled] + np.arange(len(settled))).astype(np.uint64) >> np.uint64(40)).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([anchor[once], f_anchor, anchor[settled]]), mask=mask),
            pa.array(np.concatenate([ctx[once], f_ctx.astype(np.uint32).view(np.int32), spread])),
            pa.array(np.concatenate([n[group[once]], f_n, np.zeros(len(settled))]).astype(np.int32)),
            pa.array(np.concatenate([twice[once], np.zeros(rows.num_rows - len(once), bool)])), rows.column("key"), rows.column("check"),
            pa.array(np.concatenate([lo[once], f_lo, lo[settled]])), pa.array(np.concatenate([hi[once], f_hi, hi[settled]]))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rb in _batches_of_bytes(whole, "raw", 32 << 20):
                out = of_batch(rb)
                if out is not None:
                    yield out

    return texts.select("key", "check", "copies", "raw").mapInArrow(run, schema)


def _judged(rows: DataFrame, parts: int) -> DataFrame:
    """Of each context: ``compare`` with its bytes, or settled as a span; those of an anchor of their own go."""
    schema = "anchor long, key long, check int, lo long, hi long"
    names = [x.split()[0] for x in schema.split(", ")]

    def of_rows(x: dict[str, np.ndarray]) -> pa.RecordBatch:
        """Whole anchors, sorted by (anchor, ctx)."""
        group_new = np.ones(len(x["anchor"]), bool)
        group_new[1:] = x["anchor"][1:] != x["anchor"][:-1]
        ctx_new = group_new.copy()
        ctx_new[1:] |= x["ctx"][1:] != x["ctx"][:-1]
        group, ctx = np.cumsum(group_new) - 1, np.cumsum(ctx_new) - 1
        n = np.bincount(ctx, weights=x["n"])[ctx]
        several = (np.bincount(group, weights=ctx_new)[group] > 1) | (np.bincount(group, weights=x["twice"])[group] > 0)
        span, compare = (n > 1) & (x["n"] == 1), several & ctx_new
        pick = np.concatenate([np.flatnonzero(span), np.flatnonzero(compare)])
        mask = np.arange(len(pick)) < span.sum()
        return pa.RecordBatch.from_arrays([pa.array(x["anchor"][pick], mask=mask), *[pa.array(x[c][pick]) for c in names[1:]]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for rb in batches:
            spans = rb.filter(pc.is_null(rb.column("anchor")))
            if spans.num_rows:
                yield spans.select(names)
            rb = rb.filter(pc.is_valid(rb.column("anchor")))
            x = {c: rb.column(c).to_numpy(zero_copy_only=False) for c in ["anchor", "ctx", "n", "twice", "key", "check", "lo", "hi"]}
            if held is not None:
                x = {c: np.concatenate([held[c], v]) for c, v in x.items()}
            if not len(x["anchor"]):
                continue
            # the last anchor may go on in the next batch; its rows are few, frequent contexts being combined and hot anchors finer
            cut = int(np.argmax(x["anchor"] == x["anchor"][-1]))
            if cut:
                yield of_rows({c: v[:cut] for c, v in x.items()})
            held = {c: v[cut:] for c, v in x.items()}
        if held is not None:
            yield of_rows(held)

    # Settled spans have no anchor; their random number spreads them.
    place = F.coalesce("anchor", F.col("ctx").cast("bigint"))
    return rows.repartition(parts, place).sortWithinPartitions("anchor", "ctx").mapInArrow(run, schema)


def _context_bytes(texts: DataFrame, wanted: DataFrame, length: int, parts: int) -> DataFrame:
    """The wanted contexts with their bytes; the bucketed texts stay where they are."""
    each = wanted.repartition(parts, "key").groupBy("key").agg(F.collect_list(F.struct("check", "anchor", "lo", "hi")).alias("at"))
    met = texts.join(each, "key").withColumn("at", F.filter("at", lambda x: x["check"] == F.col("check")))
    schema = "anchor long, key long, check int, lo long, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rb in _batches_of_bytes(whole, "raw", 4 << 20):
                at, raws = rb.column("at"), rb.column("raw")
                row = np.repeat(np.arange(rb.num_rows), np.asarray(pc.list_value_length(at)))
                flat = at.flatten()
                lo, hi = (flat.field(c).to_numpy() for c in ("lo", "hi"))
                held = {}
                out = []
                for r, i, j in zip(row.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    if r not in held:
                        held = {r: raws[r].as_py()}
                    out.append(held[r][i : j + length])
                of = pa.array(row)
                yield pa.RecordBatch.from_arrays([flat.field("anchor"), rb.column("key").take(of), rb.column("check").take(of), flat.field("lo"), pa.array(out, pa.binary())],
                                                 ["anchor", "key", "check", "lo", "bytes"])

    return met.select("key", "check", "at", "raw").mapInArrow(run, schema)


def _compared(contexts: DataFrame, length: int, parts: int, block_bytes: int) -> DataFrame:
    """key, check, lo, hi (first and last repeated window), h1 null; and windows (h1, h2) of anchors in several
    blocks: hi null where the window was found twice in its block."""
    schema = "key long, check int, lo long, hi long, h1 long, h2 long"
    names = [x.split()[0] for x in schema.split(", ")]

    def of_block(rows: list[dict], split: bool) -> pa.RecordBatch:
        texts = [r["bytes"] for r in rows]
        repeated, classes = repeated_windows(texts, length)
        out = [(r["key"], r["check"], r["lo"] + i, r["lo"] + j, None, None) for r, flags in zip(rows, repeated, strict=True) for i, j in _runs(flags)]
        if split:
            seen = set()
            for r, t, flags, cls in zip(rows, texts, repeated, classes, strict=True):
                for i, (twice, c) in enumerate(zip(flags.tolist(), cls.tolist(), strict=True)):
                    if c not in seen:
                        seen.add(c)
                        h = xxhash.xxh3_128_intdigest(t[i : i + length])
                        out.append((r["key"], r["check"], r["lo"] + i, None if twice else r["lo"] + i, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)))
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kinds[k]) for k in range(6)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole anchors fill a block; one that fills several sends its windows.
        block, size, anchor, anchor_at, split = [], 0, None, 0, False
        for rb in batches:
            for r in rb.to_pylist():
                if r["anchor"] != anchor:
                    if split or size >= block_bytes:
                        yield of_block(block, split)
                        block, size, split = [], 0, False
                    anchor, anchor_at = r["anchor"], len(block)
                elif size >= block_bytes:
                    if anchor_at:  # the anchors before this one are done
                        yield of_block(block[:anchor_at], False)
                        block, anchor_at = block[anchor_at:], 0
                        size = sum(len(x["bytes"]) for x in block)
                    if size >= block_bytes:
                        split = True
                        yield of_block(block, True)
                        block, size = [], 0
                block.append(r)
                size += len(r["bytes"])
        if block:
            yield of_block(block, split)

    return contexts.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(run, schema)


def repeated_spans(df: DataFrame, text_col: str = "text", length: int = 200, in_batch: int = HOT_IN_BATCH, hot_contexts: int = HOT_CONTEXTS,
                   block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """The different texts (key, check, raw, copies) in buckets; spans (key, check, lo, hi): first and last window of
    ``length`` bytes of a run of repeated ones, for texts without copies (those with copies are repeated whole);
    and the number of buckets."""
    if length < GRAM:
        raise ValueError(f"strings of {GRAM} bytes at least")
    texts, parts = _distinct_texts(df, text_col)
    long = texts.filter(F.octet_length("raw") >= length)
    hot = _hot_anchors(long, length, in_batch, hot_contexts)
    judged = materialize(_judged(_placed_contexts(long, length, hot), parts), "suffix_contexts")
    settled = judged.filter(F.col("anchor").isNull()).select("key", "check", "lo", "hi")
    found = materialize(_compared(_context_bytes(long, judged.filter(F.col("anchor").isNotNull()), length, parts), length, parts, block_bytes), "suffix_spans")
    spans = settled.union(found.filter(F.col("h1").isNull()).select("key", "check", "lo", "hi"))
    windows = found.filter(F.col("h1").isNotNull())
    several = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("blocks")).filter("blocks > 1").select("h1", "h2")
    return texts, spans.union(windows.filter(F.col("hi").isNotNull()).join(several, ["h1", "h2"], "left_semi").select("key", "check", "lo", "hi")), parts


def cut_texts(texts: DataFrame, spans: DataFrame, parts: int, length: int = 200) -> DataFrame:
    """key, check, n_bytes, spans (array of [from, to) of the removed bytes) and kept (the remaining bytes) per text."""
    each = spans.repartition(parts, "key").groupBy("key").agg(F.collect_list(F.struct("check", "lo", "hi")).alias("found"))
    met = texts.join(each, "key", "left").withColumn("found", F.filter("found", lambda x: x["check"] == F.col("check")))
    schema = "key long, check int, n_bytes long, spans array<struct<from: long, to: long>>, kept binary"
    kinds = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def cut(raw: bytes, copies: int, found) -> tuple[list[dict], bytes]:
        if len(raw) < length or (copies == 1 and not found):
            return [], raw
        if copies > 1:
            return [{"from": 0, "to": len(raw)}], b""
        lo = np.array([x["lo"] for x in found])
        order = np.argsort(lo)
        lo, hi = lo[order], np.maximum.accumulate(np.array([x["hi"] for x in found])[order] + length)
        new = np.concatenate([[True], lo[1:] > hi[:-1]])
        a, b = lo[new].tolist(), hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)].tolist()
        kept = b"".join(raw[i:j] for i, j in zip([0, *b], [*a, len(raw)], strict=True))
        return [{"from": i, "to": j} for i, j in zip(a, b, strict=True)], kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rb in _batches_of_bytes(whole, "raw", 8 << 20):
                done = [cut(raw.as_py(), c, f.as_py()) for raw, c, f in zip(rb.column("raw"), rb.column("copies").to_pylist(), rb.column("found"), strict=True)]
                yield pa.RecordBatch.from_arrays([rb.column("key"), rb.column("check"), pc.binary_length(rb.column("raw")).cast(pa.int64()),
                                                  pa.array([s for s, _ in done], kinds), pa.array([k for _, k in done], pa.binary())], ["key", "check", "n_bytes", "spans", "kept"])

    return met.select("key", "check", "raw", "copies", "found").mapInArrow(run, schema)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, result=("n_bytes", "spans", "kept"), **limits) -> DataFrame:
    """``id_col`` and the columns or expressions ``result`` over n_bytes, spans and kept, one row per input row.

    The result is evaluated once per different text, before it is joined to the rows."""
    texts, spans, parts = repeated_spans(df, text_col, length, **limits)
    done = materialize(cut_texts(texts, spans, parts, length).select("key", "check", *result), "suffix_cut")
    rows = df.select(F.col(id_col).alias("row_id"), *[c.alias(f"row_{n}") for c, n in zip(text_key(F.col(text_col)), ("key", "check"), strict=True)])
    met = rows.join(done, (F.col("row_key") == F.col("key")) & (F.col("row_check") == F.col("check")))
    return met.drop("row_key", "row_check", "key", "check").withColumnRenamed("row_id", id_col)
