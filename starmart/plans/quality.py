"""The configured data checks of the warehouse, mapped onto this repository's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import date_dim
from ..operators.checks import LOCAL_KINDS, CheckSpec, scd_time_range
from ..operators.history import latest_per_key
from ..session import materialize
from ..sources.catalog import source
from . import mart

# Audit of the joined product history: (history column, snapshot column) per snapshot.
SCD_RANGES = {
    "category": [("ProductSubcategorySnapshot__ProductCategoryID", "ProductCategoryID"), ("ProductCategorySnapshot__Name", "Name")],
    "model": [("ProductModelID", "ProductModelID"), ("ProductModelSnapshot__Name", "Name")],
    "subcategory": [("ProductSubcategoryID", "ProductSubcategoryID"), ("ProductSubcategorySnapshot__Name", "Name"),
                    ("ProductSubcategorySnapshot__ProductCategoryID", "ProductCategoryID")],
}

# Source, dimension, history and fact checks (tags: 'dedupe', 'value', 'scd' select subsets).
SUITE = [
    CheckSpec("src_header_id_not_null", "header", "not_null", "SalesOrderID"),
    CheckSpec("src_header_id_unique", "header", "unique", "SalesOrderID"),
    CheckSpec("src_detail_order_not_null", "detail", "not_null", "SalesOrderID"),
    CheckSpec("src_detail_order_fk", "detail", "relationships", "SalesOrderID", args={"to": "header", "field": "SalesOrderID"}),
    CheckSpec("src_detail_product_fk", "detail", "relationships", "ProductID", args={"to": "product_latest", "field": "ProductID"}),
    CheckSpec("src_territory_id_not_null", "territory", "not_null", "TerritoryID"),
    CheckSpec("src_territory_id_unique", "territory", "unique", "TerritoryID"),
    CheckSpec("src_product_id_not_null", "product_latest", "not_null", "ProductID", tags=("dedupe",)),
    CheckSpec("src_product_id_unique", "product_latest", "unique", "ProductID", tags=("dedupe",)),
    CheckSpec("src_product_subcategory_fk", "product_latest", "relationships", "ProductSubcategoryID",
              args={"to": "subcategory", "field": "ProductSubcategoryID"}),
    CheckSpec("src_subcategory_id_not_null", "subcategory", "not_null", "ProductSubcategoryID"),
    CheckSpec("src_subcategory_id_unique", "subcategory", "unique", "ProductSubcategoryID"),
    CheckSpec("src_subcategory_category_fk", "subcategory", "relationships", "ProductCategoryID",
              args={"to": "category", "field": "ProductCategoryID"}),
    CheckSpec("dim_product_id_not_null", "dim_product", "not_null", "ProductID"),
    CheckSpec("dim_product_key_not_null", "dim_product", "not_null", "ProductKey"),
    CheckSpec("dim_product_key_unique", "dim_product", "unique", "ProductKey"),
    CheckSpec("dim_date_key_not_null", "dim_date", "not_null", "DateKey"),
    CheckSpec("dim_date_key_unique", "dim_date", "unique", "DateKey"),
    CheckSpec("dim_territory_id_not_null", "dim_territory", "not_null", "TerritoryID"),
    CheckSpec("fact_unit_price_not_null", "fact", "not_null", "UnitPrice"),
    CheckSpec("fact_unit_price_range", "fact", "accepted_range", "UnitPrice", ("value",), {"min_value": 0, "inclusive": True}),
    CheckSpec("fact_order_qty_not_null", "fact", "not_null", "OrderQty"),
    CheckSpec("fact_order_qty_range", "fact", "accepted_range", "OrderQty", ("value",), {"min_value": 1, "inclusive": True}),
    CheckSpec("fact_line_total_not_null", "fact", "not_null", "LineTotal"),
    CheckSpec("fact_line_total_range", "fact", "accepted_range", "LineTotal", ("value",), {"min_value": 0, "inclusive": True}),
    CheckSpec("fact_date_fk", "fact", "relationships", "OrderDateKey", args={"to": "dim_date", "field": "DateKey"}),
    CheckSpec("fact_product_fk", "fact", "relationships", "ProductKey", args={"to": "dim_product", "field": "ProductKey"}),
    CheckSpec("fact_territory_fk", "fact", "relationships", "TerritoryKey", args={"to": "dim_territory", "field": "TerritoryKey"}),
    *[CheckSpec(f"scd_range_{name}", "product_history", "scd_time_range", "ProductID", ("scd",), {"to": f"snap_{name}", "on": on})
      for name, on in SCD_RANGES.items()],
]


#: The fact's row-local checks, with one that finds rows.
FACT_LEDGER_SUITE = [*[s for s in SUITE if s.table == "fact" and s.kind in LOCAL_KINDS],
                     CheckSpec("fact_order_qty_max", "fact", "accepted_range", "OrderQty", ("value",), {"max_value": 45})]


def suite_tables(spark: SparkSession, root: str, load_ts=None) -> dict[str, DataFrame]:
    """The tables that the suite checks; history and fact are written once, since several checks read them."""
    snaps = mart.snapshots(spark, root)
    history = materialize(mart.product_history(snaps), "product_history")
    dim_product = materialize(mart.dim_product(history), "dim_product")
    dim_territory = materialize(mart.dim_territory(mart.stg_territory(spark, root)), "dim_territory")
    sales = mart.int_sales_join(mart.stg_order_detail(spark, root), mart.stg_order_header(spark, root))
    header = source(spark, root, "raw_Sales", "SalesOrderHeader")
    return {
        "header": header,
        "detail": source(spark, root, "raw_Sales", "SalesOrderDetail"),
        "territory": source(spark, root, "raw_Sales", "SalesTerritory"),
        "product_latest": materialize(latest_per_key(source(spark, root, "raw_Production", "Product"), "ProductID", "ModifiedDate"), "product_latest"),
        "subcategory": source(spark, root, "raw_Production", "ProductSubcategory"),
        "category": source(spark, root, "raw_Production", "ProductCategory"),
        "dim_product": dim_product,
        "dim_date": date_dim(spark, cover=header, cover_column="OrderDate"),
        "dim_territory": dim_territory,
        "fact": materialize(mart.fact_sales(sales, dim_product, dim_territory, load_ts), "fact"),
        "product_history": history,
        "snap_category": snaps.category,
        "snap_model": snaps.model,
        "snap_subcategory": snaps.subcategory,
    }


def scd_audit(spark: SparkSession, root: str, seed: bool = False) -> DataFrame:
    """Product-history segments not covered by the snapshot version they took attributes from.

    ``seed`` moves the start of every 50th product a day back, so that there is something to find."""
    s = mart.snapshots(spark, root)
    h = materialize(mart.product_history(s), "product_history")
    if seed:
        early = F.col("valid_from") - F.expr("INTERVAL 1 DAY")
        h = h.withColumn("valid_from", F.when(F.col("ProductID") % 50 == 0, early).otherwise(F.col("valid_from")))
    out = None
    for name, on in SCD_RANGES.items():
        part = scd_time_range(h, getattr(s, name), on).select(F.lit(name).alias("check_name"), "ProductID", "valid_from", "valid_to")
        out = part if out is None else out.unionByName(part)
    return out
