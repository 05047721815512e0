"""Staging: casts, renames, cleaning (O-10 .. O-13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_bigint(c: Column) -> Column:
    """Integer cast that rounds half away from zero (warehouse semantics) instead of truncating."""
    return F.round(c).cast("bigint")


def stage_order_detail(detail: DataFrame) -> DataFrame:
    """Cast, take absolute values, then keep lines with a positive total (drops 0 and NULL only)."""
    return detail.select(
        F.col("SalesOrderID").cast("bigint").alias("SalesOrderID"),
        F.col("ProductID").cast("bigint").alias("ProductID"),
        F.col("ModifiedDate").cast("timestamp_ntz").alias("ModifiedDate"),
        F.abs(to_bigint(F.col("OrderQty"))).alias("OrderQty"),
        F.abs(F.col("UnitPrice").cast("double")).alias("UnitPrice"),
        F.abs(F.col("LineTotal").cast("double")).alias("LineTotal"),
    ).filter(F.col("LineTotal") > 0)


def stage_order_header(header: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Cast header columns; the online flag becomes 0/1; a missing territory becomes 0 (unknown)."""
    return header.select(
        F.col("SalesOrderID").cast("bigint").alias("SalesOrderID"),
        F.col("OrderDate").cast("timestamp_ntz").alias("OrderDate"),
        F.col("OnlineOrderFlag").cast("int").cast("bigint").alias("OnlineOrderFlag"),
        F.coalesce(F.col("TerritoryID").cast("bigint"), F.lit(0).cast("bigint")).alias("TerritoryID"),
        *extra,
    )


def stage_territory(territory: DataFrame) -> DataFrame:
    return territory.select(
        F.col("TerritoryID").cast("bigint").alias("TerritoryID"),
        F.col("Name").cast("string").alias("TerritoryName"),
        F.col("Group").cast("string").alias("TerritoryGroup"),
        F.col("CountryRegionCode").cast("string").alias("CountryRegionCode"),
    )


def select_except(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """All columns but ``exclude`` (case-insensitive, like the warehouse); unknown names are an error."""
    lower = {c.lower() for c in exclude}
    known = {c.lower() for c in df.columns}
    missing = lower - known
    if missing:
        raise ValueError(f"columns not in relation: {sorted(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])
