"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A long text is cut at safe boundaries before encoding: between a letter or digit and a following
blank or newline.  No match of the split pattern spans such a place (every match is a run of
non-blanks, with at most one leading blank, or a run of blanks), and what stands before it does not
look further, so the ids of the parts, one after the other, are those of the whole.  Where a long
text has no such place it is encoded in one go.

A long run of blanks has no safe place, and the library's regex needs stack for each of its blanks.
Such runs are taken out before: the pattern makes one match of the run, without its last blank if
more text follows (that one belongs to the next match), and the library's merges encode it as it is.

Edge cases: a null text is encoded as the empty text (no ids); ids decode to raw bytes, so a cut
inside a character is kept as it is; repeated rows are encoded alike; an empty table stays empty;
columns that are not named in ``keep`` are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters after which a text is cut at the next safe boundary.
PART_CHARS = 50_000
#: Bytes of an output batch (a single larger text makes a batch of its own).
BATCH_BYTES = 8_000_000
_SAFE = re.compile(r"(?<=[^\W_])(?=[ \n])")
#: Runs of at least this many blanks are encoded as one match without the regex.
LONG_RUN = 1_000
#: What the pattern's ``\s`` stands for, in runs.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


@lru_cache(maxsize=4)
def codec(rank_path: str, pattern: str):
    """The encoding of a rank file, read once per worker process."""
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, limit: int = PART_CHARS) -> Iterator[str]:
    """The text in pieces of about ``limit`` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > limit:
        found = _SAFE.search(text, at + limit)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _encode_parts(enc, text: str, limit: int) -> list[int]:
    if len(text) <= limit:
        return enc.encode_ordinary(text)
    return [i for part in parts(text, limit) for i in enc.encode_ordinary(part)]


def encode_text(enc, text: str, limit: int = PART_CHARS) -> list[int]:
    ids, at = [], 0
    for run in _BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += _encode_parts(enc, text[at : run.start()], limit)
        ids += enc._encode_single_piece(text[run.start() : end])
        at = end
    return ids + _encode_parts(enc, text[at:], limit)


def _grouped(values: Iterator, size) -> Iterator[list]:
    """Runs of values of about BATCH_BYTES, with their first position."""
    run, held = [], 0
    for v in values:
        run.append(v)
        held += size(v)
        if held >= BATCH_BYTES:
            yield run
            run, held = [], 0
    if run:
        yield run


def encode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
           part_chars: int = PART_CHARS) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int), one row per input row."""
    given = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("txt"))
    fields = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = codec(rank_path, pattern)
        for rb in batches:
            texts, at = rb.column(rb.num_columns - 1), 0
            each = (np.array(encode_text(enc, t.as_py() or "", part_chars), np.int32) for t in texts)
            for some in _grouped(each, lambda a: a.nbytes + 16):
                ends = np.cumsum([0, *[len(a) for a in some]]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(some), pa.int32()))
                cols = [rb.column(i).slice(at, len(some)) for i in range(len(keep))]
                at += len(some)
                yield pa.RecordBatch.from_arrays([*cols, ids], [*[f"k{i}" for i in range(len(keep))], "ids"])

    out = given.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "ids")


def decode(df: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded`` (raw bytes), one row per input row; null ids decode to no bytes."""
    given = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(ids_col).alias("tok"))
    fields = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = codec(rank_path, pattern)
        for rb in batches:
            ids, at = rb.column(rb.num_columns - 1), 0
            each = (enc.decode_bytes(x.values.to_pylist() if x.is_valid else []) for x in ids)
            for some in _grouped(each, lambda b: len(b) + 16):
                cols = [rb.column(i).slice(at, len(some)) for i in range(len(keep))]
                at += len(some)
                yield pa.RecordBatch.from_arrays([*cols, pa.array(some, pa.binary())], [*[f"k{i}" for i in range(len(keep))], "decoded"])

    out = given.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "decoded")
