"""Expressions over mined rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_hash(antecedents: Column, consequents: Column) -> Column:
    """sha256 of the ', '-joined sorted antecedents directly followed by the consequents.

    Kept bit-compatible with the published rule table.  There is no separator between the two
    sides, so {1}->{23} and {12}->{3} share a hash: never dedupe on it, use :func:`rule_id`.
    """
    a = F.array_join(F.sort_array(antecedents).cast("array<string>"), ", ")
    c = F.array_join(F.sort_array(consequents).cast("array<string>"), ", ")
    return F.sha2(F.concat(a, c), 256)


def rule_id(antecedents: Column, consequents: Column) -> Column:
    """Unambiguous rule identity: sha256 of 'a1, a2 => c1'."""
    a = F.array_join(F.sort_array(antecedents).cast("array<string>"), ", ")
    c = F.array_join(F.sort_array(consequents).cast("array<string>"), ", ")
    return F.sha2(F.concat(a, F.lit(" => "), c), 256)
