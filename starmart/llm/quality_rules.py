"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes on a document: 1 (good), -1 (bad) or 0 (abstains).  A label model says how far to
trust each: given the unknown quality, rules vote independently, each with its own rates of bad and
good votes on good and on bad documents (an abstention says nothing).  Expectation-maximisation
estimates these rates, so the rules' accuracies, and the share of good documents from the votes of
*all* documents, without labels: the votes are first counted by pattern (at most 3 ** rules
patterns, whatever the corpus), and each step is one aggregate over that small table.  The
posterior probability that a document is good then replaces the all-must-pass filter.

Words are ``[^\\x20\\x09-\\x0D]+``.

Edge cases: null and empty texts have no words, all counts are 0, and they fail the base check;
texts of fewer than five words have no repeated windows; equal texts get equal results; on an empty
table the model keeps its starting values and the result is empty; only the named columns of the
input are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import word_array

WINDOW = 5
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"
DIGITS = "0123456789"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BLANKS = " \t\n\x0b\x0c\r"
#: Where estimation starts, and with the weight of how many documents the start stays in each
#: estimate: how often a good and a bad document get a bad and a good vote from a rule.
START_GOOD, START_BAD, START_WEIGHT = (0.02, 0.6), (0.25, 0.4), 10.0
STEPS = 15


@dataclass(frozen=True)
class Rule:
    """Votes by a ratio: bad above (or below) one bound, good beyond the other, else abstains."""

    name: str
    ratio: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words", "{x} < 10", "{x} >= 30"),
    Rule("word_length", "word_chars / greatest(n_words, 1)", "{x} < 2.2 OR {x} > 20", "{x} BETWEEN 3 AND 14"),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", "{x} > 0.15", "{x} <= 0.03"),
    Rule("marked_words", "n_marked_words / greatest(n_words, 1)", "{x} > 0.15", "{x} <= 0.03"),
    Rule("marked_lines", "n_marked_lines / greatest(n_lines, 1)", "{x} > 0.5", "{x} <= 0.1"),
    Rule("punctuation", "n_marks / greatest(word_chars, 1)", "{x} > 0.12", "{x} <= 0.07"),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", "{x} > 0.3", "{x} <= 0.1"),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", "{x} > 0.2", "{x} <= 0.05"),
    Rule("capitals", "n_upper / greatest(word_chars, 1)", "{x} > 0.4", "{x} <= 0.15"),
    Rule("shouting", "n_shouts / greatest(n_words, 1)", "{x} > 0.2", "{x} <= 0.05"),
    Rule("digits", "n_digits / greatest(word_chars, 1)", "{x} > 0.4", "{x} <= 0.15"),
    Rule("variety", "n_distinct_words / greatest(n_words, 1)", "{x} < 0.15", "{x} >= 0.25"),
)


def _without(text: Column, chars: str) -> Column:
    """How many characters of ``chars`` the text has."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _marked(text: Column) -> Column:
    return F.translate(text, SYMBOLS, "") != text


def measures(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the counts that the rules read, all long."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = df.select(F.struct(*[F.col(c) for c in keep]).alias("key"), text.alias("t"))
    d = d.withColumn("w", word_array(F.col("t"))).withColumn("ls", F.filter(F.split("t", "\n"), lambda x: F.translate(x, BLANKS, "") != ""))
    d = d.withColumn("windows", F.when(F.size("w") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("w") - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("w"), i + k) for k in range(WINDOW)]))))
    # Only texts in which a window occurs twice go on to sort their windows.
    d = d.withColumn("some", F.size(F.array_distinct("windows")) < F.size("windows"))
    d = d.withColumn("sorted", F.when(F.col("some"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("sorted", lambda x, i: (x.h == F.get(F.col("sorted"), i + 1).h) | ((i > 0) & (x.h == F.get(F.col("sorted"), i - 1).h)))
    d = d.withColumn("starts", F.when(F.col("some"), F.sort_array(F.transform(again, lambda x: x.i))))
    covered = F.aggregate(
        "starts", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s.n + F.least(F.lit(WINDOW), i - s.last)).alias("n")),
        lambda s: s.n)
    counts = {
        "n_words": F.size("w"), "word_chars": F.length(F.translate("t", BLANKS, "")), "n_symbols": _without(F.col("t"), SYMBOLS),
        "n_lines": F.size("ls"), "n_dup_lines": F.size("ls") - F.size(F.array_distinct("ls")), "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_marked_words": F.size(F.filter("w", _marked)), "n_marked_lines": F.size(F.filter("ls", _marked)), "n_marks": _without(F.col("t"), MARKS),
        "n_upper": _without(F.col("t"), UPPER), "n_shouts": _without(F.col("t"), "!"), "n_digits": _without(F.col("t"), DIGITS),
        "n_distinct_words": F.size(F.array_distinct("w")),
    }
    return d.select(*[F.col(f"key.{c}").alias(c) for c in keep], *[c.cast("bigint").alias(n) for n, c in counts.items()])


def votes(rules: Sequence[Rule] = RULES) -> list[Column]:
    """One column ``v0``, ``v1``, ... per rule over :func:`measures`."""
    out = []
    for j, r in enumerate(rules):
        x = f"({r.ratio})"
        out.append(F.expr(f"CASE WHEN {r.bad.format(x=x)} THEN -1 WHEN {r.good.format(x=x)} THEN 1 ELSE 0 END").alias(f"v{j}"))
    return out


@dataclass
class LabelModel:
    """Share of good documents; per rule, how often good and bad documents get a bad (-1) and a good (1) vote."""

    share: float
    good: list[tuple[float, float]]
    bad: list[tuple[float, float]]

    @classmethod
    def start(cls, rules: int) -> LabelModel:
        return cls(0.5, [START_GOOD] * rules, [START_BAD] * rules)

    def accuracies(self) -> list[float]:
        """Per rule, the probability that a vote (not an abstention) is right."""
        out = []
        for (gn, gp), (bn, bp) in zip(self.good, self.bad, strict=True):
            right = self.share * gp + (1 - self.share) * bn
            out.append(right / (right + self.share * gn + (1 - self.share) * bp))
        return out

    def posterior(self) -> Column:
        """Probability that a row with votes ``v0``, ``v1``, ... is good.  Rules are held to be no
        worse than chance: a bad vote never speaks for a document, a good one never against it."""
        odds = F.lit(math.log(self.share / (1 - self.share)))
        for j, ((gn, gp), (bn, bp)) in enumerate(zip(self.good, self.bad, strict=True)):
            v = F.col(f"v{j}")
            against, speaks = min(0.0, math.log(gn / bn)), max(0.0, math.log(gp / bp))
            odds = odds + F.when(v == -1, F.lit(against)).when(v == 1, F.lit(speaks)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rules: int, steps: int = STEPS) -> LabelModel:
    """Expectation-maximisation over the counted vote patterns (``v0``.., ``n``); one aggregate row per step."""
    model = LabelModel.start(rules)
    for _ in range(steps):
        sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("g")]
        for j in range(rules):
            for vote, name in ((-1, "n"), (1, "p")):
                hit = F.when(F.col(f"v{j}") == vote, F.col("n"))
                sums += [F.sum(hit).alias(f"a{name}{j}"), F.sum(hit * F.col("p")).alias(f"g{name}{j}")]
        s = patterns.withColumn("p", model.posterior()).agg(*sums).first()
        if not s["n"]:
            break
        good_n, bad_n = s["g"], s["n"] - s["g"]

        def rates(j: int, is_good: bool) -> tuple[float, float]:
            start, total = (START_GOOD, good_n) if is_good else (START_BAD, bad_n)
            hits = [(s[f"g{v}{j}"] or 0.0) if is_good else (s[f"a{v}{j}"] or 0.0) - (s[f"g{v}{j}"] or 0.0) for v in "np"]
            return tuple((max(0.0, h) + START_WEIGHT * p) / (max(0.0, total) + START_WEIGHT) for h, p in zip(hits, start, strict=True))

        model = LabelModel((good_n + 1) / (s["n"] + 2), [rates(j, True) for j in range(rules)], [rates(j, False) for j in range(rules)])
    return model


def judge(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES) -> DataFrame:
    """``keep`` columns, the counts, the votes and ``posterior`` of every document."""
    voted = materialize(measures(df, text_col, keep).select("*", *votes(rules)), "quality_votes")
    names = [f"v{j}" for j in range(len(rules))]
    patterns = materialize(voted.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n")), "quality_patterns")
    model = fit(patterns, len(rules))
    return voted.withColumn("posterior", model.posterior())


def base_failed() -> Column:
    """Too short, or over a fifth of the words lie in windows that the text repeats."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
