"""URL filters: every glob rule at once over each canonical URL, by a bit-parallel automaton.

All rules are packed end to end into one row of 64-bit words (extended Shift-And).  A rule with m
elements takes m + 1 bits: bit j means "the first j elements are read".  One URL byte c moves all
rules together:

    state = ((state << 1) & STEP[c]) | (state & STAY[c])

STEP[c] has the bits whose element reads c, STAY[c] the bits that stand before a star that reads c.
The bit shifted out of one word enters the next.  A rule matches if its last bit is set at the end
of the URL (rules are anchored at both ends).  The state of a whole batch of URLs is one numpy
matrix, so one step costs a few array operations for all URLs and rules.

Globs: ``**`` any bytes, ``*`` any bytes but ``/``, ``?`` one byte, ``[abc]`` one of these bytes,
``\\x`` the byte x; everything else reads itself.  URLs are compared as UTF-8.

Edge cases: a null URL, or one without ``://``, has empty host and path and is matched as the empty
text; a batch is cut so that the padded matrix stays small, so very long URLs cost time, not memory;
equal URLs give equal verdicts; an empty table gives an empty result; other columns of the input
are ignored unless asked for with ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Cells of the padded byte matrix that are held at once.
MATRIX_CELLS = 8_000_000


@dataclass(frozen=True)
class HostRule:
    """Holds for ``host`` and all its subdomains where the URL's path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        literal = _quoted(self.host + self.path)
        return [literal + "**", "*." + literal + "**"]


@dataclass(frozen=True)
class GlobRule:
    verdict: str
    glob: str


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "*?[]\\" else c for c in text)


def _elements(glob: str) -> list[tuple[str, frozenset[int]]]:
    """('byte', accepted bytes) or ('star', accepted bytes)."""
    every, raw, out, i = frozenset(range(256)), glob.encode(), [], 0
    while i < len(raw):
        c = raw[i : i + 1]
        if c == b"*":
            deep = raw[i + 1 : i + 2] == b"*"
            out.append(("star", every if deep else every - {ord("/")}))
            i += 2 if deep else 1
        elif c == b"?":
            out.append(("byte", every))
            i += 1
        elif c == b"[":
            end = raw.index(b"]", i)
            out.append(("byte", frozenset(raw[i + 1 : end])))
            i = end + 1
        elif c == b"\\":
            out.append(("byte", frozenset(raw[i + 1 : i + 2])))
            i += 2
        else:
            out.append(("byte", frozenset(c)))
            i += 1
    return out


class GlobAutomaton:
    """The packed masks of a list of globs."""

    def __init__(self, globs: Sequence[str]):
        starts, ends, step, stay, bit = [], [], {}, {}, 0
        for glob in globs:
            starts.append(bit)
            for kind, accepted in _elements(glob):
                if kind == "star":
                    stay[bit] = stay.get(bit, frozenset()) | accepted
                else:
                    bit += 1
                    step[bit] = accepted
            ends.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.starts, self.ends = starts, ends
        self.step, self.stay = self._masks(step), self._masks(stay)
        self.initial = np.zeros(self.words, np.uint64)
        for b in starts:
            self.initial[b // 64] |= np.uint64(1 << (b % 64))

    def _masks(self, by_bit: dict[int, frozenset[int]]) -> np.ndarray:
        masks = np.zeros((256, self.words), np.uint64)
        for b, accepted in by_bit.items():
            masks[sorted(accepted), b // 64] |= np.uint64(1 << (b % 64))
        return masks

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix: text i matches glob j."""
        out = np.zeros((len(texts), len(self.ends)), bool)
        order = np.argsort([-len(t) for t in texts], kind="stable")
        at = 0
        while at < len(order):
            longest = max(1, len(texts[order[at]]))
            some = order[at : at + max(1, MATRIX_CELLS // longest)]
            out[some] = self._run([texts[i] for i in some], longest)
            at += len(some)
        return out

    def _run(self, texts: list[bytes], longest: int) -> np.ndarray:
        # Texts come longest first, so those still being read are always the first rows.
        lengths = np.array([len(t) for t in texts])
        flat = np.frombuffer(b"".join(t.ljust(longest, b"\0") for t in texts), np.uint8).reshape(len(texts), longest)
        state = np.tile(self.initial, (len(texts), 1))
        for i in range(longest):
            n = int(np.searchsorted(-lengths, -i, side="left"))  # rows with a byte at i
            if not n:
                break
            c, now = flat[:n, i], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[c]) | (now & self.stay[c])
        ends = np.array(self.ends)
        return (state[:, ends // 64] >> (ends % 64).astype(np.uint64)) & np.uint64(1) == 1


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a URL: the host from the first ``://`` to ``/``, ``?``, ``#`` or the
    end with A-Z in lower case, the path up to ``?``, ``#`` or the end, the query up to ``#``."""
    at = F.instr(url, "://")
    # expr-level substring: the start is a column
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), A_Z, a_z)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return host, path, query


def canonical_url(host: Column, path: Column, query: Column) -> Column:
    """What the automaton reads: host, path and, if any is left, the query without ``utm_``
    parameters; scheme and fragment are dropped."""
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.startswith("utm_") & (p != "")), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def judge_urls(
    df: DataFrame,
    host_rules: Sequence[HostRule],
    glob_rules: Sequence[GlobRule],
    default: str = "allow",
    url_col: str = "url",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep`` columns, host, path, canonical_url, rule, glob_rule, verdict (allow or block) per URL.

    ``rule`` is the longest host rule that fits, ``glob_rule`` the glob rule with most literal bytes that
    matches (ties: block before allow, then the earlier one).  The verdict is the rule's, else the
    glob's, else ``default``.  Host rules read host and path, glob rules the canonical URL, each kind in one
    automaton; so a query never completes the host or the path of a rule."""
    of_host = [(g, i, (len(r.name.encode()), 0, -i)) for i, r in enumerate(host_rules) for g in r.globs()]
    of_url = [(g.glob, i, (sum(k == "byte" and len(a) == 1 for k, a in _elements(g.glob)), int(g.verdict == "block"), -i)) for i, g in enumerate(glob_rules)]
    hosts, urls = GlobAutomaton([g for g, _, _ in of_host]), GlobAutomaton([g for g, _, _ in of_url])

    def best(automaton: GlobAutomaton, rules: list[tuple], texts: list[bytes]) -> pa.Array:
        won = np.full(len(texts), -1)
        if rules:
            hit = automaton.matches(texts)
            for j in sorted(range(len(rules)), key=lambda j: rules[j][2]):
                won[hit[:, j]] = rules[j][1]
        return pa.array(won, pa.int32(), mask=won < 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            host, path, url = (rb.column(rb.num_columns - k).to_pylist() for k in (3, 2, 1))
            rule = best(hosts, of_host, [(h + p).encode() for h, p in zip(host, path, strict=True)])
            glob = best(urls, of_url, [x.encode() for x in url])
            yield pa.RecordBatch.from_arrays([*rb.columns, rule, glob], schema=pa.schema([*rb.schema, pa.field("rule_no", pa.int32()), pa.field("glob_no", pa.int32())]))

    host, path, query = url_parts(F.col(url_col))
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    given = df.select(*keys, host.alias("host"), path.alias("path"), canonical_url(host, path, query).alias("canonical_url"))
    schema = T.StructType([*given.schema.fields, T.StructField("rule_no", T.IntegerType()), T.StructField("glob_no", T.IntegerType())])
    out = given.mapInArrow(run, schema)

    def pick(values: list[str], no: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col(no)) if values else F.lit(None).cast("string")

    verdict = F.coalesce(
        pick([r.verdict for r in host_rules], "rule_no"), pick([g.verdict for g in glob_rules], "glob_no"), F.lit(default)
    )
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "host", "path", "canonical_url",
        pick([r.name for r in host_rules], "rule_no").alias("rule"), pick([g.glob for g in glob_rules], "glob_no").alias("glob_rule"),
        verdict.alias("verdict"),
    )
