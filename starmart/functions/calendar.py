"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(d: Column) -> Column:
    """Week of year with weeks starting on Sunday, 0..53 (days before the first Sunday are week 0).

    ``weekofyear`` is ISO-8601 (Monday start, 1..53) and gives different numbers.
    """
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("bigint")


def season(month: Column) -> Column:
    """Northern-hemisphere meteorological season of a month number."""
    return (
        F.when(month.isin(12, 1, 2), F.lit("Winter"))
        .when(month.isin(3, 4, 5), F.lit("Spring"))
        .when(month.isin(6, 7, 8), F.lit("Summer"))
        .otherwise(F.lit("Autumn"))
    )
