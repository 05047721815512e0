"""Star-schema build: raw tables -> staging -> snapshots -> dims -> fact (O-10 .. O-21, O-38 .. O-41).

Functions take and return DataFrames.  ``snapshots``, ``build_mart`` and what is built on them write the
tables that the reference keeps (snapshots, dimensions, the stored fact) while the query is built; the
rest is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import date_key, surrogate_key
from ..operators.history import OPEN_END, open_end, scd2_from_raw
from ..operators.keys import assign_keys, with_unknown_member
from ..operators.membership import write_summary
from ..operators.staging import stage_order_detail, stage_order_header, stage_territory
from ..operators.temporal import interval_difference, pit_join, temporal_join
from ..operators.upsert import arrived_orders, lookback_window, stored_high_water_mark, swap_partitions, upsert, upsert_partitions, write_clustered
from ..session import materialize
from ..sources.catalog import source

UNKNOWN_TERRITORY = {"TerritoryKey": 0, "TerritoryID": 0, "TerritoryName": "unknown", "TerritoryGroup": "unknown", "CountryRegionCode": "unknown"}

FACT_KEYS = ["ProductKey", "SalesOrderID"]

# Hash columns of each change-dedupe: all business columns of the raw table except the cursor.
SNAPSHOT_SPECS = {
    "Product": ("raw_Production", "ProductID"),
    "ProductSubcategory": ("raw_Production", "ProductSubcategoryID"),
    "ProductCategory": ("raw_Production", "ProductCategoryID"),
    "ProductModel": ("raw_Production", "ProductModelID"),
}

PRODUCT_ATTR_KEY_COLS = [
    "ProductID",
    "Name",
    "Size",
    "Color",
    "ProductModelSnapshot__Name",
    "ProductCategorySnapshot__Name",
    "ProductSubcategorySnapshot__Name",
    "DiscontinuedDate",
]


def stg_order_detail(spark: SparkSession, root: str) -> DataFrame:
    return stage_order_detail(source(spark, root, "raw_Sales", "SalesOrderDetail"))


def stg_order_header(spark: SparkSession, root: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return stage_order_header(source(spark, root, "raw_Sales", "SalesOrderHeader"), extra)


def stg_territory(spark: SparkSession, root: str) -> DataFrame:
    return stage_territory(source(spark, root, "raw_Sales", "SalesTerritory"))


def int_sales_join(detail: DataFrame, header: DataFrame) -> DataFrame:
    """One row per detail line with the header's columns (left join on the order id)."""
    h = header.withColumnRenamed("SalesOrderID", "_sm_hid")
    j = detail.join(h, detail.SalesOrderID == h._sm_hid, "left").drop("_sm_hid")
    return j


def dim_territory(territory_stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    numbered = assign_keys(territory_stg, ["TerritoryID"], "TerritoryKey", existing)
    return with_unknown_member(numbered, UNKNOWN_TERRITORY)


def snapshot(raw: DataFrame, key: str, ts: str = "ModifiedDate") -> DataFrame:
    """Change dedupe + SCD-2 bounds of one raw history table."""
    return scd2_from_raw(raw, key, ts, [c for c in raw.columns if c != ts])


@dataclass
class Snapshots:
    product: DataFrame
    subcategory: DataFrame
    category: DataFrame
    model: DataFrame


def snapshots(spark: SparkSession, root: str, product: DataFrame | None = None) -> Snapshots:
    """``product``: its raw history, if not that of the catalog."""
    raw = {name: source(spark, root, schema, name) for name, (schema, _) in SNAPSHOT_SPECS.items()}
    if product is not None:
        raw["Product"] = product
    snaps = {name: materialize(snapshot(raw[name], key), f"snapshot_{name}") for name, (_, key) in SNAPSHOT_SPECS.items()}
    return Snapshots(snaps["Product"], snaps["ProductSubcategory"], snaps["ProductCategory"], snaps["ProductModel"])


def product_history(s: Snapshots, gaps: str = "keep") -> DataFrame:
    """Product versions joined through time with subcategory, category and model versions."""
    j = temporal_join(s.product, s.subcategory, "ProductSubcategoryID", "ProductSubcategoryID",
                      ["Name", "ProductCategoryID"], "ProductSubcategorySnapshot", gaps)
    j = temporal_join(j, s.category, "ProductSubcategorySnapshot__ProductCategoryID", "ProductCategoryID",
                      ["Name"], "ProductCategorySnapshot", gaps)
    j = temporal_join(j, s.model, "ProductModelID", "ProductModelID", ["Name"], "ProductModelSnapshot", gaps)
    return j


def dim_product(history: DataFrame) -> DataFrame:
    """Product dimension.  ``ProductKey`` identifies a version (attributes + ValidFrom);
    ``ProductAttrKey`` is the 8-attribute hash alone, which repeats across versions."""
    return history.select(
        surrogate_key(history, PRODUCT_ATTR_KEY_COLS + ["valid_from"]).alias("ProductKey"),
        surrogate_key(history, PRODUCT_ATTR_KEY_COLS).alias("ProductAttrKey"),
        F.col("ProductID").cast("bigint").alias("ProductID"),
        F.col("Name").cast("string").alias("Name"),
        F.col("Size").cast("string").alias("ProductSize"),
        F.col("Color").cast("string").alias("Color"),
        F.col("ProductModelSnapshot__Name").cast("string").alias("Model"),
        F.col("ProductCategorySnapshot__Name").cast("string").alias("Category"),
        F.col("ProductSubcategorySnapshot__Name").cast("string").alias("Subcategory"),
        F.col("DiscontinuedDate").cast("timestamp_ntz").alias("DiscontinuedDate"),
        F.col("valid_from").alias("ValidFrom"),
        F.col("valid_to").alias("ValidTo"),
        F.when(F.col("valid_to") == open_end(), 1).otherwise(0).cast("bigint").alias("IsCurrentFlag"),
    )


def fact_sales(new_records: DataFrame, dim_prod: DataFrame, dim_terr: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Fact rows: point-in-time product version, territory key, order date key, load time."""
    with_product = pit_join(new_records, dim_prod, "ProductID", "OrderDate", ["ProductKey"],
                            valid_from="ValidFrom", valid_to="ValidTo").drop("ProductID")
    terr = dim_terr.select("TerritoryID", "TerritoryKey")
    with_terr = with_product.join(terr, "TerritoryID", "inner").drop("TerritoryID")
    load = load_ts if load_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    return with_terr.withColumn("OrderDateKey", date_key("OrderDate")).drop("OrderDate").withColumn("LoadDatetime", load)


@dataclass
class Mart:
    detail: DataFrame
    header: DataFrame
    territory: DataFrame
    sales: DataFrame
    dim_territory: DataFrame
    dim_product: DataFrame


def dimensions(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The product and the territory dimension, written."""
    dim_terr = materialize(dim_territory(stg_territory(spark, root)), "dim_territory")
    return materialize(dim_product(product_history(snapshots(spark, root))), "dim_product"), dim_terr


def build_mart(spark: SparkSession, root: str) -> Mart:
    detail = stg_order_detail(spark, root)
    header = stg_order_header(spark, root)
    terr = stg_territory(spark, root)
    sales = int_sales_join(detail, header)
    dim_prod, dim_terr = dimensions(spark, root)
    return Mart(detail, header, terr, sales, dim_terr, dim_prod)


def fact_sales_full(spark: SparkSession, root: str, load_ts: Column | None = None) -> DataFrame:
    m = build_mart(spark, root)
    return fact_sales(m.sales, m.dim_product, m.dim_territory, load_ts)


def fact_incremental(
    new_records: DataFrame,
    target: DataFrame | None,
    dim_prod: DataFrame,
    dim_terr: DataFrame,
    lookback_days: int = 7,
    load_ts: Column | None = None,
    arrived_since: Column | None = None,
) -> DataFrame:
    """One incremental run: select the new rows, build their fact rows, upsert them.

    New rows are those of the look-back window by order date or, with ``arrived_since``, the orders
    with a line that arrived (``ModifiedDate``) since the last run, which also finds late facts."""
    if arrived_since is None:
        window = lookback_window(new_records, target, "OrderDate", "OrderDateKey", lookback_days)
    else:
        window = arrived_orders(new_records, "ModifiedDate", arrived_since)
    batch = fact_sales(window, dim_prod, dim_terr, load_ts)
    if target is None:
        return batch
    batch = materialize(batch, "upsert_batch")  # read for its keys and for its rows
    return upsert(target, batch, FACT_KEYS, on_duplicate="replace")


FACT_PARTITION = "OrderMonth"


def load_fact(spark: SparkSession, path: str, new_records: DataFrame, dim_prod: DataFrame, dim_terr: DataFrame,
              arrived_since: Column | None = None, load_ts: Column | None = None) -> DataFrame:
    """One run of the stored fact table, partitioned by order month: a first load without
    ``arrived_since``, else the orders that arrived since, of which only the months are rewritten (a
    summary of each month's keys says which months may hold rows that they replace)."""
    rows = new_records if arrived_since is None else arrived_orders(new_records, "ModifiedDate", arrived_since)
    month = F.floor(F.col("OrderDateKey") / 100).cast("int").alias(FACT_PARTITION)
    batch = fact_sales(rows, dim_prod, dim_terr, load_ts).select("*", month)
    if arrived_since is None:
        write_clustered(batch, path, ["ProductKey", "SalesOrderID"], [FACT_PARTITION])
        write_summary(spark.read.parquet(path), path, FACT_KEYS, FACT_PARTITION)
        return spark.read.parquet(path)
    return upsert_partitions(spark, path, batch, FACT_KEYS, FACT_PARTITION)


def load_fact_lookback(spark: SparkSession, path: str, new_records: DataFrame, dim_prod: DataFrame, dim_terr: DataFrame,
                       days: int = 7, load_ts: Column | None = None) -> DataFrame:
    """One run of the stored fact by order date: the rows of the look-back window before its newest date, which
    comes from the newest month alone; only the months of the window are rewritten."""
    newest = stored_high_water_mark(spark, path, FACT_PARTITION, "OrderDateKey")
    rows = lookback_window(new_records, None, "OrderDate", days=days, newest=newest)
    month = F.floor(F.col("OrderDateKey") / 100).cast("int").alias(FACT_PARTITION)
    return upsert_partitions(spark, path, fact_sales(rows, dim_prod, dim_terr, load_ts).select("*", month), FACT_KEYS, FACT_PARTITION)


def rekey_fact(spark: SparkSession, path: str, sales: DataFrame, old_dim: DataFrame, new_dim: DataFrame, dim_terr: DataFrame,
               load_ts: Column | None = None) -> DataFrame:
    """Gives the rows of the stored fact the keys of a product dimension that has changed for the past.

    A late product version changes which version was valid in some stretch of time.  The interval
    difference of the two dimensions names these stretches, with the old and the new key; sales inside
    one lose the row with the old key and get one with the new key (or none, where no version is valid).
    Only the months of such sales are read and rewritten; ``sales`` is read from the first changed time on."""
    changed = materialize(interval_difference(old_dim, new_dim, "ProductID", "ProductKey", "ValidFrom", "ValidTo"), "changed_product_keys")
    inside = (F.col("ProductID") == F.col("_sm_pid")) & (F.col("OrderDate") >= F.col("_sm_from")) & (F.col("OrderDate") < F.col("_sm_to"))
    stretches = changed.select(F.col("ProductID").alias("_sm_pid"), F.col("ValidFrom").alias("_sm_from"), F.col("ValidTo").alias("_sm_to"), F.col("old_value").alias("_sm_old"))
    since = sales.filter(F.col("OrderDate") >= changed.agg(F.min("ValidFrom")).scalar())
    affected = materialize(since.join(stretches, inside).drop("_sm_pid", "_sm_from", "_sm_to"), "affected_sales")
    stale = affected.filter(F.col("_sm_old").isNotNull()).select(F.col("_sm_old").alias("ProductKey"), "SalesOrderID").distinct()
    month = F.floor(F.col("OrderDateKey") / 100).cast("int").alias(FACT_PARTITION)
    batch = materialize(fact_sales(affected.drop("_sm_old"), new_dim, dim_terr, load_ts).select("*", month), "rekeyed_rows")
    touched = [r[0] for r in affected.select(date_key("OrderDate").alias("OrderDateKey")).select(month).distinct().collect()]
    target = spark.read.parquet(path)
    if not touched:
        return target
    kept = target.filter(F.col(FACT_PARTITION).isin(touched)).join(stale, FACT_KEYS, "left_anti")
    return swap_partitions(spark, path, kept.unionByName(batch.select(*target.columns)), FACT_PARTITION, touched, FACT_KEYS, batch)


__all__ = [
    "OPEN_END",
    "build_mart",
    "dim_product",
    "dim_territory",
    "fact_incremental",
    "fact_sales",
    "fact_sales_full",
    "int_sales_join",
    "product_history",
    "rekey_fact",
    "snapshots",
    "stg_order_detail",
    "stg_order_header",
    "stg_territory",
]
