"""N-gram Jaccard join by prefixes and parity sketches: all links of 5-word shingle sets at 0.8 or more.

A document's set has the distinct 5-word shingles of its text (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``) as 64-bit hashes; a text of one to four words is one shingle.  Equal sets
are one *node*.

Order.  Shingles that several nodes of a batch have are counted, the most frequent
:data:`FREQUENT_TOKENS` of them come last in the order of all shingles, by count; the others come
first, by hash.  Of two sets of the threshold each one's first n - ceil(0.8 n) + 1 shingles, its
*prefix*, share one, whatever the order is; with rare shingles first, passages that many documents
share stay out of the prefixes.

Groups.  Where documents are read, each batch puts similar ones into groups: nodes with the same
smallest hash that are within the threshold of the group's first node (checked exactly).  A group has
the prefix shingles of all its members, once.  One exchange, sorted by shingle, brings those of several
groups together; shingles of one group only, by far most, end there.

Links.  Groups that are linked make a component.  In the first rounds every shingle that groups of several
components have names a *head*, the component with most groups on it, and the nodes of the others ask the
head's; a head that all have asked is done for that shingle.  Then one last round lets all that is left on a
shingle ask each other: the groups lie in blocks of :data:`BLOCK_NODES` nodes by the most shared of their
shingles, so a loose family (near copies of which any two need not be links) is a few blocks, and a node asks
a block once, whichever of their shingles they share.  After it all pairs of nodes that share a prefix
shingle are in one component or have been compared, so the components are exact; links inside a component
are not enumerated.

Questions.  A set's *sketch* has the parity of its hashes on each of at least twice as many bits as it has
shingles, a power of two; of two sketches the wider one is folded to the other's width.  Where they differ on
more bits than two linked sets can differ in shingles, there is no link.  For one node's question to a block
the sketches (some 3 bits a shingle) are moved and compared, a block at a time; the sets themselves are
moved and compared exactly for one likely member of each component in the block, and for all of its likely
members where that one is no link.

Skew.  A round is linear in the rows of the shingles that are still open, times the blocks of a shingle in the
last one.  Questions to one block are dealt out over several tasks, each with a copy of the block.

Edge cases: null, empty and blank texts have no shingles and are linked with nothing (their
component is their own id); a null id is no smallest id, a document without id that is linked with
others gets their smallest id; repeated rows and ids keep a row each; an empty table gives an empty
result; only id and text are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import FILE_ROWS, few_files, materialize
from .components import connected_components
from .tables import free_name, small

SHINGLE = 5
#: Jaccard similarity in hundredths, from which documents are linked.
THRESHOLD = 80
#: First nodes of a batch's groups with the same smallest hash that a document is compared with; it
#: opens a group of its own beyond that, which costs time later, no link.
FIRST_NODES = 4
#: Shingles that come last in the order, at most, and from which count on.
FREQUENT_TOKENS, FREQUENT_COUNT = 500_000, 8
#: Nodes of a block that is asked as a whole, about.
BLOCK_NODES = 2048
#: Questions to a block that one task answers, about.
TASK_QUERIES = 1_000
#: Rounds with one head per shingle, before all that is left asks each other.
SINGLE_HEAD_ROUNDS = 2
#: Bytes of text of an exchange partition; a document has a prefix row for about 30 of them.
PART_BYTES = 16 << 20
#: Bytes of text for each row that an exchange's last tasks are counted by, so that one has some 2 MB of text at least.
ROW_BYTES = 100
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLY + y
    return (x ^ (x >> np.uint64(32))) * _MULTIPLY


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes (int64); bytes.lower and bytes.split know A-Z and the six separators only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64).view(np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    x = h[:n].copy()
    for k in range(1, SHINGLE):
        x = _mix(x, h[k : k + n])
    return np.unique(x.view(np.int64))


def prefix_tokens(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 shingles: those not among the ``frequent`` ones (sorted) by hash, then these by ``rank``."""
    n = len(tokens)
    k = n + THRESHOLD * n // -100 + 1
    if not len(frequent):
        return tokens[:k]
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    found = frequent[at] == tokens
    if not found[:k].any():
        return tokens[:k]
    return tokens[np.argsort(np.where(found, rank[at] + 1, 0), kind="stable")[:k]]


def parity_bits(tokens: np.ndarray, bits: int = 256) -> list[int]:
    """``bits`` (a power of two) bits in longs: whether an odd number of hashes falls on each.  Where two sets differ in d hashes, at most d bits do."""
    odd = (np.bincount(tokens.view(np.uint64) & np.uint64(bits - 1), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def sketch(tokens: np.ndarray) -> bytes:
    """Parity bits, two to four for each hash.  To be read as unsigned, as numpy counts the bits of an absolute value."""
    return np.array(parity_bits(tokens, max(64, 1 << (2 * len(tokens) - 1).bit_length())), np.int64).tobytes()


def folded(sketches: np.ndarray) -> np.ndarray:
    """Sketches (the last axis) on half as many bits."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < THRESHOLD * max(len(a), len(b)):
        return False
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= THRESHOLD * (len(a) + len(b) - common)


def _node(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).view(np.int64))


def _slices(rb: pa.RecordBatch, limit: int = 12 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(rb.column("txt")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < rb.num_rows:
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right")))
        yield rb.slice(at, stop - at)
        at = stop


def _repeated(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several nodes have, sorted, and how many; all shingles are held once at a time."""
    nodes: dict[int, np.ndarray] = {}
    for text in texts:
        tokens = shingle_set(text.as_py())
        nodes.setdefault(_node(tokens), tokens)
    every = np.concatenate([np.empty(0, np.int64), *nodes.values()])
    nodes.clear()
    every.sort()
    value, count = np.unique(every[1:][every[1:] == every[:-1]], return_counts=True)
    return value, count + 1


def _frequent_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their ranks by count; counted where several nodes of a batch have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rb in _slices(whole):
                value, count = _repeated(rb.column("txt"))
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count)], ["token", "n"])

    counts = docs.select(F.col("text").alias("txt")).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = counts.filter(F.col("n") >= FREQUENT_COUNT).orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).toArrow()
    token, n = (found.column(c).to_numpy().astype(np.int64) for c in ("token", "n"))
    rank = np.empty(len(token), np.int32)
    rank[np.lexsort((token, n))] = np.arange(len(token), dtype=np.int32)
    order = np.argsort(token)
    return token[order], rank[order]


def _grouped_batch(texts: Iterable[str | None], frequent: np.ndarray, rank: np.ndarray) -> tuple[list, list, list, list, dict[int, list[np.ndarray]]]:
    """Per text size, node, sketch and group (None without shingles); per group its members' prefixes."""
    sizes, nodes, bits, groups, own = [], [], [], [], {}
    first: dict[int, list[tuple[int, np.ndarray]]] = {}  # by smallest hash
    seen: dict[int, int] = {}
    for text in texts:
        tokens = shingle_set(text)
        sizes.append(len(tokens))
        if not len(tokens):
            nodes.append(None)
            bits.append(None)
            groups.append(None)
            continue
        node = _node(tokens)
        group = seen.get(node)
        if group is None:
            heads = first.setdefault(int(tokens[0]), [])
            group = next((g for g, t in heads if similar(t, tokens)), None)
            if group is None:
                group = node
                if len(heads) < FIRST_NODES:
                    heads.append((node, tokens))
            seen[node] = group
            own.setdefault(group, []).append(prefix_tokens(tokens, frequent, rank))
        nodes.append(node)
        bits.append(sketch(tokens))
        groups.append(group)
    return sizes, nodes, bits, groups, own


def _keyed_rows(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: (prefix shingle, group, null) and (any key, group, document)."""
    names = ["doc_id", "text_key", "n", "node", "bits"]
    types = [docs.schema["doc_id"].dataType, T.LongType(), T.LongType(), T.LongType(), T.BinaryType()]
    doc_type = T.StructType([T.StructField(c, t) for c, t in zip(names, types, strict=True)])
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("grp", T.LongType()), T.StructField("doc", doc_type)])
    last = docs.sparkSession.sparkContext.broadcast(_frequent_tokens(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rb in _slices(whole):
                sizes, nodes, bits, groups, own = _grouped_batch((t.as_py() for t in rb.column("txt")), *last.value)
                doc = pa.StructArray.from_arrays(
                    [rb.column("doc_id"), rb.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary())], names)
                spread = _mix(np.array([x or 0 for x in nodes], np.int64).view(np.uint64), np.arange(len(nodes), dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(groups, pa.int64()), doc], ["key", "grp", "doc"])
                each = [(g, np.unique(np.concatenate(s)) if len(s) > 1 else s[0]) for g, s in own.items()]
                for at in range(0, len(each), 1000):
                    some = each[at : at + 1000]
                    keys = np.concatenate([s for _, s in some])
                    of = np.repeat(np.array([g for g, _ in some], np.int64), [len(s) for _, s in some])
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(of), pa.nulls(len(keys), doc.type)], ["key", "grp", "doc"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").alias("txt")).mapInArrow(run, schema)


def _shared(rows: DataFrame, parts: int) -> DataFrame:
    """Document rows as they are; of the shingles those of two groups or more, each group once.  Streams over sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sent = None, False  # the last (shingle, group), and whether it has gone out
        for rb in batches:
            is_row = rb.column("doc").is_null()
            docs = rb.filter(pc.invert(is_row))
            if docs.num_rows:
                yield docs
            rb = rb.filter(is_row)
            if not rb.num_rows:
                continue
            key, grp = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("key", "grp"))
            if last is not None:
                key, grp = np.append(last[0], key), np.append(last[1], grp)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (grp[1:] != grp[:-1])
            key, grp = key[new], grp[new]
            with_next = np.append(key[1:] == key[:-1], False)
            out = with_next | np.append(False, with_next[:-1])
            ended = bool(out[-1]) or (len(key) == 1 and last is not None and sent)
            if last is not None and sent:
                out[0] = False
            last, sent = (key[-1], grp[-1]), ended
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(grp[out]), pa.nulls(int(out.sum()), rb.column("doc").type)], ["key", "grp", "doc"])

    return rows.repartition(parts, "key").sortWithinPartitions("key", "grp").mapInArrow(run, rows.schema)


def _token_sets(docs: DataFrame, places: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``tokens`` of the wanted nodes, each from one document; only ids are broadcast, if few.

    ``places``: node, id, text_key and how many rows have that id and text; of several rows one is taken."""
    wanted = materialize(places.join(nodes, "node", "left_semi"), "jaccard_wanted")
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for part in _slices(rb, 4 << 20):
                sets = [s for t in part.column(0).to_pylist() if len(s := shingle_set(t))]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), tokens], ["node", "tokens"])

    def sets_of(rows: DataFrame) -> DataFrame:
        ids = small(rows.select("id", "text_key"))
        met = docs.join(ids, docs["doc_id"].eqNullSafe(ids["id"]) & (F.xxhash64(docs["text"]) == ids["text_key"]), "left_semi")
        return met.select(F.col("text").alias("txt")).mapInArrow(run, schema)

    once, several = wanted.filter("copies = 1"), wanted.filter("copies > 1")
    return sets_of(once) if several.isEmpty() else sets_of(once).union(sets_of(several).dropDuplicates(["node"]))


def _alike(every: bool, later: bool):
    """Rows sorted by (blk, part, asks): a block's members, then the questions to it.  Of each other component with members
    that the sketches don't rule out one of these (a clearly similar one, or else the nearest) and whether there are several,
    or ``every`` such member; of components with greater numbers only, if ``later``."""

    def widths(members: list) -> dict[int, tuple]:
        by: dict[int, list] = {}
        for m in members:
            by.setdefault(len(m[3]) // 8, []).append(m)
        return {w: (*(np.array([m[k] for m in ms], np.int64) for k in range(3)), np.frombuffer(b"".join(m[3] for m in ms), np.uint64).reshape(len(ms), w)) for w, ms in by.items()}

    def likely(node: int, comp: int, n: int, own: np.ndarray, tables: dict) -> Iterator[tuple]:
        for width in (len(own) // 2, len(own), 2 * len(own)):
            if width not in tables:
                continue
            nodes, comps, sizes, sketches = tables[width]
            if width > len(own):
                if (width, "folded") not in tables:
                    tables[width, "folded"] = folded(sketches)
                sketches = tables[width, "folded"]
            differ = np.bitwise_count(sketches ^ (folded(own) if width < len(own) else own)).sum(axis=1, dtype=np.int64) * (100 + THRESHOLD)
            most = (100 - THRESHOLD) * (sizes + n)
            fits = (differ <= most) & (100 * np.minimum(sizes, n) >= THRESHOLD * np.maximum(sizes, n)) & (comps > comp if later else comps != comp)
            for at in np.flatnonzero(fits):
                yield int(comps[at]), int(differ[at]) if 5 * differ[at] > 4 * most[at] else 0, int(nodes[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, tables = None, [], None
        for rb in batches:
            out = []
            for blk, part, asks, node, comp, n, bits in zip(*(rb.column(c).to_pylist() for c in ("blk", "part", "asks", "node", "comp", "n", "bits")), strict=True):
                if (blk, part) != block:
                    block, members, tables = (blk, part), [], None
                if not asks:
                    members.append((node, comp, n, bits))
                    continue
                if tables is None:
                    tables = widths(members)
                found = sorted(likely(node, comp, n, np.frombuffer(bits, np.uint64), tables))
                for k, (other, _, b) in enumerate(found):
                    if every or not k or found[k - 1][0] != other:
                        out.append((node, b, blk, other, not every and k + 1 < len(found) and found[k + 1][0] == other))
            if out:
                a, b, blk, other, several = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (a, b, blk, other)), pa.array(several)], ["a", "b", "blk", "other", "several"])

    return run


def _dealt(asks: DataFrame, holds: DataFrame) -> DataFrame:
    """Questions (blk, node, ...) and members of blocks (the same columns) with ``part``, the number of one of a block's tasks, and ``asks``."""
    tasks = asks.groupBy("blk").agg(F.ceil(F.count(F.lit(1)) / TASK_QUERIES).cast("int").alias("tasks"))
    part = F.pmod(F.xxhash64("node"), F.col("tasks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))
    asks = asks.join(tasks, "blk").select(*asks.columns, part.alias("part"), F.lit(True).alias("asks"))
    return asks.unionByName(holds.join(tasks, "blk").select(*holds.columns, each.alias("part"), F.lit(False).alias("asks")))


def _likely(asks: DataFrame, blocks: DataFrame, info: DataFrame, parts: int, every: bool, later: bool) -> DataFrame:
    """Pairs (a, b) of questions (blk, node, comp; a written table) and members of ``blocks`` (the same columns) as :func:`_alike` finds them; written."""
    tasks = asks.count() / TASK_QUERIES
    rows = _dealt(asks, blocks).join(info, "node").repartition(parts, "blk", "part").sortWithinPartitions("blk", "part", "asks")
    found = rows.select("blk", "part", "asks", "node", "comp", "n", "bits").mapInArrow(_alike(every, later), "a long, b long, blk long, other long, several boolean")
    return materialize(few_files(found, int(tasks * FILE_ROWS)), "jaccard_likely")


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (blk, part, asks): a node's set, then those compared with it; the links (a, b)."""
    held = None
    for rb in batches:
        links = []
        for b, asks, node, tokens in zip(*(rb.column(c).to_pylist() for c in ("blk", "asks", "node")), rb.column("tokens"), strict=True):
            own = tokens.values.to_numpy()
            if not asks:
                held = own
            elif similar(held, own):
                links.append((node, b))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame, places: DataFrame, parts: int) -> DataFrame:
    """The pairs (a, b; a written table) that are links; written.  Only their nodes' sets are made, from their documents."""
    tasks = pairs.count() / TASK_QUERIES
    tokens = _token_sets(docs, places, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    rows = _dealt(pairs.select(F.col("b").alias("blk"), F.col("a").alias("node")).distinct(), pairs.select(F.col("b").alias("blk"), F.col("b").alias("node")).distinct())
    rows = rows.join(tokens, "node").select("blk", "part", "asks", "node", "tokens")
    rows = rows.repartition(parts, "blk", "part").sortWithinPartitions("blk", "part", "asks")
    return materialize(few_files(rows.mapInArrow(_answers, "a long, b long"), int(tasks * FILE_ROWS)), "jaccard_links")


def _asked(asks: DataFrame, blocks: DataFrame, info: DataFrame, docs: DataFrame, places: DataFrame, parts: int, later: bool, n_asks: int) -> DataFrame:
    """Links (a, b) of nodes ``a`` with members of the blocks each asks: one for each component in a block that it is linked with, at least.

    asks: blk, node, comp, about ``n_asks``; blocks: blk, node, comp; questions that sizes rule out are left out first."""
    sizes = blocks.join(info.select("node", "n"), "node").groupBy("blk").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    fits = (100 * F.col("n") >= THRESHOLD * F.col("least")) & (100 * F.col("most") >= THRESHOLD * F.col("n"))
    asks = materialize(few_files(asks.join(sizes, "blk").join(info.select("node", "n"), "node").filter(fits).select("blk", "node", "comp"), n_asks), "jaccard_asks")
    first = _likely(asks, blocks, info, parts, False, later)
    links = _verified(first, docs, places, parts)
    # Where the one compared is no link, others of its component may be.
    left = materialize(few_files(first.filter("several").join(links, ["a", "b"], "left_anti").select("a", "blk", "other"), first.count()), "jaccard_left")
    if left.isEmpty():
        return links
    again = asks.join(left.select(F.col("a").alias("node"), "blk").distinct(), ["node", "blk"], "left_semi").select("blk", "node", "comp")
    again = materialize(few_files(again, asks.count()), "jaccard_again")
    found = _likely(again, blocks.join(left.select("blk", F.col("other").alias("comp")).distinct(), ["blk", "comp"], "left_semi").select("blk", "node", "comp"), info, parts, True, later)
    rest = found.join(left, ["a", "blk", "other"], "left_semi").join(first, ["a", "b"], "left_anti").select("a", "b")
    rest = materialize(few_files(rest, found.count()), "jaccard_rest")
    return links.union(_verified(rest, docs, places, parts))


def _in_blocks(holds: DataFrame, unit: str) -> DataFrame:
    """``holds`` (bucket, node, n, ...) with ``blk``: each bucket's nodes in blocks of about :data:`BLOCK_NODES`, those of one ``unit`` in one."""
    size = holds.groupBy("bucket").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("n") / (BLOCK_NODES * 1000))).alias("blks"))
    return holds.join(size, "bucket").withColumn("blk", F.xxhash64("bucket", F.pmod(F.xxhash64(unit), F.col("blks"))))


def _link_groups(shared: DataFrame, members: DataFrame, links: DataFrame, info: DataFrame, docs: DataFrame, places: DataFrame, parts: int, n_rows: int) -> DataFrame:
    """``node``, ``root`` of all components; rounds of questions to head components, then of all that is left to each other.

    ``n_rows``: of shared shingles and documents together."""
    roots = connected_components(links, "a", "b")
    for turn in range(SINGLE_HEAD_ROUNDS + 1):
        known = members.select("node", "n").distinct().join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("comp"))
        known = materialize(few_files(known, n_rows), "jaccard_comps")
        labelled = shared.join(known.select(F.col("node").alias("grp"), "comp"), "grp")
        per = labelled.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"))
        head = F.max_by("comp", F.struct("k", F.xxhash64("comp", F.lit(turn)))).alias("head")
        open_keys = per.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), head).filter("comps > 1")
        live = materialize(few_files(labelled.join(open_keys, "key").select("key", "grp", "comp", "comps", "head"), n_rows), "jaccard_open")
        if live.isEmpty():
            return roots
        last = turn == SINGLE_HEAD_ROUNDS
        if last:
            bucket = live.groupBy("grp").agg(F.max_by("key", F.struct("comps", F.xxhash64("key"))).alias("bucket"), F.first("comp").alias("comp"))
            held = materialize(few_files(_in_blocks(bucket.join(members, "grp"), "grp").select("blk", "grp", "node", "comp"), n_rows), "jaccard_blocks")
            on_key = live.select("key", "grp").join(held.select("grp", "blk").distinct(), "grp").join(bucket.select("grp", F.col("comp").alias("of")), "grp")
            on_key = on_key.groupBy("key", "blk").agg(F.max("of").alias("greatest"))
            asks = live.select("key", "grp", "comp").join(on_key, "key").filter(F.col("greatest") > F.col("comp")).select("grp", "comp", "blk").distinct()
            asks = asks.join(members.select("grp", "node"), "grp")
        else:
            asks = live.filter("comp != head").select("grp", "comp", "head").distinct()
            asks = asks.join(members.select("grp", "node"), "grp").select("head", "node", "comp").distinct()
            held = known.join(asks.select(F.col("head").alias("comp")).distinct(), "comp", "left_semi").withColumn("bucket", F.col("comp"))
            held = materialize(few_files(_in_blocks(held, "node").select("blk", "node", "comp"), n_rows), "jaccard_blocks")
            asks = asks.join(held.select(F.col("comp").alias("head"), "blk").distinct(), "head")
        n_asks = n_rows * (1 + held.count() // BLOCK_NODES)
        found = _asked(asks.select("blk", "node", "comp").distinct(), held.select("blk", "node", "comp").distinct(), info, docs, places, parts, last, n_asks)
        roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found), "a", "b")
        shared = live.filter("comp != head").select("key", "grp")
    return roots


def _labelled(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key (a hash of the text), n, node, root (null without shingles) and component_id per row."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), text_bytes // PART_BYTES)
    rows = materialize(few_files(_shared(_keyed_rows(docs), parts), text_bytes // ROW_BYTES), "jaccard_rows")
    n_rows = rows.count()
    each = rows.filter(F.col("doc").isNotNull()).select("doc.doc_id", "doc.text_key", "doc.n", "doc.node", "grp")
    shared = rows.filter(F.col("doc").isNull()).select("key", "grp")

    touched = shared.select("grp").distinct()
    members = materialize(few_files(each.join(touched, "grp").select("grp", "node", "n").distinct(), n_rows), "jaccard_members")
    # One document of each node, and how many rows have its id and text.
    rows_of = each.join(members.select("node").distinct(), "node", "left_semi").groupBy("node", F.col("doc_id").alias("id"), "text_key").agg(F.count(F.lit(1)).alias("copies"))
    places = rows_of.groupBy("node").agg(F.min(F.struct("id", "text_key", "copies")).alias("x")).select("node", "x.*")
    places = materialize(few_files(places, n_rows), "jaccard_places")
    inside = each.filter("node != grp").select(F.col("node").alias("a"), F.col("grp").alias("b"))
    info = rows.filter(F.col("doc.node").isNotNull()).select("doc.node", "doc.n", "doc.bits")
    info = materialize(few_files(info.join(members.select("node").distinct(), "node", "left_semi").distinct(), n_rows), "jaccard_info")
    roots = _link_groups(shared, members, inside, info, docs, places, parts, n_rows)

    least = each.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    least = materialize(few_files(least.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least"), n_rows), "jaccard_nodes")
    best = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = least.join(best, "root").select("node", "root", "component_id")
    return each.join(of_node, "node", "left").select("doc_id", "text_key", "n", "node", "root", "component_id")


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) per row."""
    out = _labelled(df, id_col, text_col)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, that are the first of their component, by id and then by a hash of the
    text, so an id that several texts have stands for each text by itself; of rows with the same id and
    text one stays.  Rows without id and rows without shingles all stay."""
    found = _labelled(df, id_col, text_col).filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    found = found.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n_rows"))
    found = materialize(few_files(found.withColumn("at", F.struct("doc_id", "text_key")), df.count()), "jaccard_documents")
    several = found.groupBy("root").agg(F.min("at").alias("first"), F.sum("n_rows").alias("n")).filter("n > 1").select("root", "first")
    m_id, m_text, m_gone = (free_name(df, c) for c in ("marked_doc_id", "marked_text_key", "marked_gone"))
    marked = found.join(several, "root").select(F.col("doc_id").alias(m_id), F.col("text_key").alias(m_text), (F.col("at") != F.col("first")).alias(m_gone), "n_rows")
    marked = small(materialize(few_files(marked.filter(F.col(m_gone) | (F.col("n_rows") > 1)).drop("n_rows"), found.count()), "jaccard_marked"))
    same = (F.col(id_col) == F.col(m_id)) & (F.xxhash64(F.col(text_col)) == F.col(m_text))
    rest = df.join(marked, same, "left_anti")
    repeated = df.join(marked.filter(~F.col(m_gone)), same, "left_semi").withColumn(m_text, F.xxhash64(F.col(text_col)))
    return rest.unionByName(repeated.dropDuplicates([id_col, m_text]).drop(m_text))
