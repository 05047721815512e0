"""Market baskets: scope filter, basket build, item support, adaptive minimum support
(O-14, O-16, O-25 .. O-27, O-29, O-31).

Every mining scope (each territory, plus "all territories") is computed in the same pass: a line
is exploded into its own territory's scope and the overall scope, and every aggregate is keyed
by scope.  The overall scope is the heaviest group, so nothing is ever keyed by scope alone until
the per-scope results are a handful of rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import date_key

# Internal scope value for "all territories"; restored to NULL on output (a NULL join key would
# be dropped by equi-joins).
ALL_SCOPE = -1
SCOPE, BASKET, ITEM = "scope", "basket", "item"


def parse_date_key(value: int) -> dt.date:
    """Validate a YYYYMMDD integer by parsing it as a real date."""
    try:
        return dt.datetime.strptime(str(int(value)), "%Y%m%d").date()
    except ValueError as e:
        raise ValueError(f"invalid YYYYMMDD date key: {value}") from e


def scope_filter(
    df: DataFrame,
    date_key_col: str = "OrderDateKey",
    territory_col: str = "TerritoryID",
    territory_id: int | None = None,
    date_filter: int | None = None,
    window: int | None = None,
) -> DataFrame:
    """Rows of one territory (or all) strictly before ``date_filter`` and, with ``window``, strictly
    after ``date_filter - window`` days.  A window without a date is an error."""
    cond: Column = F.lit(True)
    if territory_id is not None:
        cond = cond & (F.col(territory_col) == F.lit(territory_id))
    if window is not None and date_filter is None:
        raise ValueError("window needs date_filter")
    if date_filter is not None:
        end = parse_date_key(date_filter)
        cond = cond & (F.col(date_key_col) < F.lit(int(end.strftime("%Y%m%d"))))
        if window is not None:
            start = end - dt.timedelta(days=int(window))
            cond = cond & (F.col(date_key_col) > F.lit(int(start.strftime("%Y%m%d"))))
    return df.filter(cond)


def basket_arrays(df: DataFrame, basket: str, item: str) -> DataFrame:
    """One row per basket with its sorted distinct items (``ARRAY_AGG`` with set semantics; NULL
    items are dropped).  The array of a basket is bounded by the item catalogue, not by the rows."""
    return (
        df.select(basket, item)
        .filter(F.col(item).isNotNull())
        .distinct()
        .groupBy(basket)
        .agg(F.sort_array(F.collect_list(item)).alias("products"))
    )


def scoped_items(df: DataFrame, basket: str, item: str, territory: str | None = "TerritoryID", overall: bool = True) -> DataFrame:
    """Distinct (scope, basket, item) triples.  Each row belongs to its territory's scope and, with
    ``overall``, to the all-territories scope ``ALL_SCOPE``.

    Lines are exchanged by basket, once, before they are repeated for their scopes."""
    if territory is None:
        scopes = F.array(F.lit(ALL_SCOPE).cast("bigint"))
    elif overall:
        scopes = F.array(F.col(territory).cast("bigint"), F.lit(ALL_SCOPE).cast("bigint"))
    else:
        scopes = F.array(F.col(territory).cast("bigint"))
    return (
        df.filter(F.col(item).isNotNull() & F.col(basket).isNotNull())
        .select(*dict.fromkeys([c for c in (territory, basket, item) if c is not None]))
        .repartition(F.col(basket))
        .select(F.explode(scopes).alias(SCOPE), F.col(basket).alias(BASKET), F.col(item).alias(ITEM))
        .filter(F.col(SCOPE).isNotNull())
        .distinct()
    )


def scope_stats(items: DataFrame) -> DataFrame:
    """Per scope: number of baskets, distinct items and basket-item pairs (two aggregates: the
    basket count per scope and the item counts are each partial-aggregated)."""
    n_baskets = items.groupBy(SCOPE).agg(F.countDistinct(BASKET).alias("n_baskets"))
    per_item = item_counts(items)
    agg = per_item.groupBy(SCOPE).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("item_count").alias("n_pairs"),
        F.max("item_count").alias("max_item_count"),
    )
    return agg.join(n_baskets, SCOPE)


def item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy(SCOPE, ITEM).agg(F.count(F.lit(1)).alias("item_count"))


def item_support(items: DataFrame) -> DataFrame:
    """(scope, item, item_count, n_baskets, support)."""
    n = items.groupBy(SCOPE).agg(F.countDistinct(BASKET).alias("n_baskets"))
    return with_scope_figures(item_counts(items), n).withColumn("support", F.col("item_count") / F.col("n_baskets"))


#: Scopes whose figures become literals of a plan; a territory table has a few dozen.
MAX_SCOPES = 10_000


def with_scope_figures(df: DataFrame, figures: DataFrame) -> DataFrame:
    """``df`` with the columns of ``figures`` (one row per scope); rows of other scopes go.

    Half of all rows are in the overall scope, so they are never exchanged by scope: the figures, at
    most :data:`MAX_SCOPES` rows, are read once and joined as a local table that each task has.  More
    scopes than that are spread widely enough for an ordinary join."""
    rows = figures.limit(MAX_SCOPES + 1).collect()
    if len(rows) > MAX_SCOPES:
        return df.join(figures, SCOPE)
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, figures.schema)), SCOPE)


LN2 = 0.6931471805599453


def adaptive_min_support(stats: DataFrame) -> DataFrame:
    """Initial minimum support per scope from item statistics:

        N_avg = basket-item pairs / distinct items,  max_sup = largest item support,
        R = 2^n - 1,  min_sup = max_sup * (1 - (1/sqrt(R))^(1/N_avg))

    evaluated in log space (ln R = n ln 2 + ln(1 - 2^-n)) so it stays finite for any number of items.
    """
    n = F.col("n_items").cast("double")
    ln_r = n * F.lit(LN2) + F.log1p(-F.exp(-n * F.lit(LN2)))
    n_avg = F.col("n_pairs") / F.col("n_items")
    max_sup = F.col("max_item_count") / F.col("n_baskets")
    min_sup = max_sup * (F.lit(1.0) - F.exp(-0.5 * ln_r / n_avg))
    return stats.withColumn("n_avg", n_avg).withColumn("max_support", max_sup).withColumn("min_support", min_sup)


def output_scope(col: str = SCOPE) -> Column:
    """Internal scope -> territory id, NULL for all territories."""
    return F.when(F.col(col) == ALL_SCOPE, F.lit(None).cast("bigint")).otherwise(F.col(col)).alias("territory_id")


def mining_scopes(dim_territory: DataFrame, territory: str = "TerritoryID") -> DataFrame:
    """The scopes the miner runs for: every distinct territory id and NULL (all)."""
    ids = dim_territory.select(F.col(territory).cast("bigint").alias("territory_id")).distinct()
    return ids.unionByName(dim_territory.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("territory_id")))


def with_order_date_key(df: DataFrame, order_date: str = "OrderDate") -> DataFrame:
    return df.withColumn("OrderDateKey", date_key(order_date))
