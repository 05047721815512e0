"""Mining input and the per-territory rule jobs (O-14, O-16, O-24 .. O-27, O-31, O-46).

Lines are the fact's: sales with the product version valid at the order date and a known territory,
plus the order's customer, which gives customer baskets: the published job's order baskets (about four lines each) yield no rule at the
0.65 confidence threshold on these tables, so the registered queries mine customer baskets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import date_key
from ..operators.as_of import window_bounds
from ..operators.baskets import parse_date_key, scoped_items
from ..operators.temporal import pit_join
from ..session import materialize
from . import mart


def mining_lines(spark: SparkSession, root: str, load_ts=None, where: Column | None = None) -> DataFrame:
    """:func:`sold_lines`, written, for those who read them several times."""
    return materialize(sold_lines(spark, root, where), "mining_lines")


def sold_lines(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """``where``: a filter over the sales (OrderDate, TerritoryID, ...), which reaches the scans before any join with a dimension.

    The product version's names are attached while the fact rows are built, and the customer comes with the
    order header, so nothing is joined back on a surrogate key."""
    sales = mart.int_sales_join(mart.stg_order_detail(spark, root), mart.stg_order_header(spark, root, ("CustomerID",)))
    if where is not None:
        sales = sales.filter(where)
    dim_prod, dim_terr = mart.dimensions(spark, root)
    sold = pit_join(sales.select("SalesOrderID", "CustomerID", "ProductID", "OrderDate", "TerritoryID"), dim_prod, "ProductID", "OrderDate",
                    ["Name", "Subcategory", "Category"], valid_from="ValidFrom", valid_to="ValidTo")
    sold = sold.join(dim_terr.select("TerritoryID"), "TerritoryID")
    return sold.select("SalesOrderID", "CustomerID", "ProductID", F.col("Name").alias("ProductName"), F.col("Subcategory").alias("ProductBrand"),
                       F.col("Category").alias("ProductType"), "TerritoryID", date_key("OrderDate").alias("OrderDateKey"))


def sales_in_window(territory_id: int | None = None, date_filter: int | None = None, window: int | None = None) -> Column:
    """:func:`baskets.scope_filter` as a filter over the raw order date."""
    cond = F.lit(True) if territory_id is None else F.col("TerritoryID") == territory_id
    if date_filter is not None:
        [(start, end)] = window_bounds([date_filter], window)
        day = lambda k: F.lit(parse_date_key(k).isoformat()).cast("timestamp_ntz")
        cond = cond & (F.col("OrderDate") < day(end))
        if start is not None:
            cond = cond & (F.col("OrderDate") >= day(start))
    return cond


def customer_items(spark: SparkSession, root: str, item: str = "ProductName") -> DataFrame:
    """(scope, basket = customer, item) for every territory and the overall scope."""
    return materialize(scoped_items(sold_lines(spark, root), "CustomerID", item, "TerritoryID"), "mining_items")
