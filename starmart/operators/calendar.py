"""Date dimension (O-39)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import season, sunday_week
from ..functions.keys import date_key

# Fixed spine bounds of the calendar dimension; the end is exclusive.
SPINE_START = "1990-01-01"
SPINE_END = "2050-12-31"


def date_spine(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per day in [start, end), generated by a distributed ``range``."""
    days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days
    return spark.range(0, max(days, 0)).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))


def covering_spine(dates: DataFrame, column: str, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """Spine over [start, end) widened to every date found in ``dates[column]``: the bounds come
    from one aggregate over the data, the days from ``sequence`` (at most the calendar span)."""
    bounds = dates.agg(F.min(F.to_date(column)).alias("lo"), F.max(F.to_date(column)).alias("hi"))
    first = F.least(F.lit(start).cast("date"), F.coalesce(F.col("lo"), F.lit(start).cast("date")))
    last = F.greatest(F.date_sub(F.lit(end).cast("date"), 1), F.coalesce(F.col("hi"), F.lit(start).cast("date")))
    return bounds.select(F.explode(F.sequence(first, last)).alias("date_day"))


def date_dim(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END,
             cover: DataFrame | None = None, cover_column: str | None = None) -> DataFrame:
    """Calendar dimension over the fixed spine [start, end); with ``cover`` the spine is widened to
    include every date of ``cover[cover_column]`` so no fact date is missing from the dimension."""
    d = F.col("date_day")
    month = F.month(d)
    spine = date_spine(spark, start, end) if cover is None else covering_spine(cover, cover_column, start, end)
    return spine.select(
        date_key(d).alias("DateKey"),
        d.alias("Date"),
        F.dayofmonth(d).cast("bigint").alias("Day"),
        sunday_week(d).alias("Week"),
        month.cast("bigint").alias("Month"),
        F.quarter(d).cast("bigint").alias("Quarter"),
        season(month).alias("Season"),
        F.year(d).cast("bigint").alias("Year"),
    )
