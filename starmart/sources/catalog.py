"""Logical table names -> DataFrames.

``source(spark, root, schema, table)`` resolves the raw replicated tables of the retail model
(``raw_Sales.*``, ``raw_Production.*``).  In this repository they are derived from the driver's
TPC-H-like Parquet tables (mapping in FIXTURES.md §3); on a real deployment register real paths
with :func:`register_path` and the same code reads them directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import dense_ids

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Fixed values of the stand-in mapping (FIXTURES.md §3).
ONLINE_PRIORITY = "1-URGENT"          # o_orderpriority that marks an online order
NULL_TERRITORY_EVERY = 50             # every 50th order has no territory (exercises the NULL -> 0 rule)
PRODUCT_VERSION_DATES = ("1990-01-01", "1997-01-01", "1999-07-01")
PRICE_CHANGE_EVERY = 3                # every third part changes its list price between versions
PRICE_STEP = 10.0
REFERENCE_START = "1990-01-01"

_registered: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A driver table by name (one Parquet file or folder per table)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def register_path(schema: str, name: str, path: str) -> None:
    """Point a logical raw table at real Parquet data (overrides the stand-in mapping)."""
    _registered[(schema, name)] = path


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def sales_order_header(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders")
    c = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    # nation has 25 rows by definition of the schema: a fixed-size broadcast.
    n = table(spark, root, "nation").select("n_nationkey", "n_regionkey")
    cn = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select("c_custkey", "n_regionkey")
    h = o.join(cn, o.o_custkey == cn.c_custkey, "left")
    return h.select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").alias("OrderDate"),
        (F.col("o_orderpriority") == F.lit(ONLINE_PRIORITY)).alias("OnlineOrderFlag"),
        F.when(F.col("o_orderkey") % NULL_TERRITORY_EVERY == 0, F.lit(None))
        .otherwise(F.col("n_regionkey").cast("bigint") + 1)
        .alias("TerritoryID"),
        F.col("o_orderdate").alias("ModifiedDate"),
    )


def sales_order_detail(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").cast("bigint").alias("SalesOrderLineNumber"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_shipdate").alias("ModifiedDate"),
        F.col("l_quantity").alias("OrderQty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
        F.col("l_extendedprice").alias("LineTotal"),
    )


def sales_territory(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "region")
    return r.select(
        (F.col("r_regionkey").cast("bigint") + 1).alias("TerritoryID"),
        F.col("r_name").alias("Name"),
        F.col("r_name").alias("Group"),
        F.substring("r_name", 1, 2).alias("CountryRegionCode"),
        _ts(REFERENCE_START).alias("ModifiedDate"),
    )


_ID_TABLES: dict[tuple[str, str], tuple[DataFrame, DataFrame, DataFrame]] = {}


def _part_ids(spark: SparkSession, root: str):
    """Category / subcategory / model ids of the part table, written once per session and state of its files."""
    from ..session import materialize

    p = table(spark, root, "part")
    files = p.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct().collect()
    key = (spark.sparkContext.applicationId, str(sorted(map(tuple, files))))
    cached = _ID_TABLES.get(key)
    if cached is None or any(df.sparkSession is not spark for df in cached):
        _ID_TABLES[key] = (
            materialize(dense_ids(p, ["p_type"], "ProductCategoryID"), "category_ids"),
            materialize(dense_ids(p, ["p_type", "p_brand"], "ProductSubcategoryID"), "subcategory_ids"),
            materialize(dense_ids(p, ["p_name"], "ProductModelID"), "model_ids"),
        )
    cat, sub, model = _ID_TABLES[key]
    return p, cat, sub, model


def forget_ids() -> None:
    _ID_TABLES.clear()


def product_category(spark: SparkSession, root: str) -> DataFrame:
    _, cat, _, _ = _part_ids(spark, root)
    return cat.select("ProductCategoryID", F.col("p_type").alias("Name"), _ts(REFERENCE_START).alias("ModifiedDate"))


def product_subcategory(spark: SparkSession, root: str) -> DataFrame:
    _, cat, sub, _ = _part_ids(spark, root)
    return sub.join(cat, "p_type").select(
        "ProductSubcategoryID", "ProductCategoryID", F.col("p_brand").alias("Name"), _ts(REFERENCE_START).alias("ModifiedDate")
    )


def product_model(spark: SparkSession, root: str) -> DataFrame:
    _, _, _, model = _part_ids(spark, root)
    return model.select("ProductModelID", F.col("p_name").alias("Name"), _ts(REFERENCE_START).alias("ModifiedDate"))


def product(spark: SparkSession, root: str) -> DataFrame:
    """Product change history: every part in three versions; every third part changes price."""
    p, _, sub, model = _part_ids(spark, root)
    p = p.join(sub, ["p_type", "p_brand"], "left").join(model, ["p_name"], "left")
    versions = F.array(*[F.struct(F.lit(i).alias("v"), _ts(d).alias("d")) for i, d in enumerate(PRODUCT_VERSION_DATES)])
    p = p.withColumn("_ver", F.explode(versions))
    changes = F.col("p_partkey") % PRICE_CHANGE_EVERY == 0
    return p.select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("ProductNumber"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("Color"),
        F.when(changes, F.col("p_retailprice") + F.col("_ver.v") * PRICE_STEP).otherwise(F.col("p_retailprice")).alias("ListPrice"),
        F.col("p_size").cast("string").alias("Size"),
        "ProductSubcategoryID",
        "ProductModelID",
        _ts(REFERENCE_START).alias("SellStartDate"),
        F.lit(None).cast("timestamp_ntz").alias("DiscontinuedDate"),
        F.col("_ver.d").alias("ModifiedDate"),
    )


_BUILDERS: dict[tuple[str, str], Callable[[SparkSession, str], DataFrame]] = {
    ("raw_Sales", "SalesOrderHeader"): sales_order_header,
    ("raw_Sales", "SalesOrderDetail"): sales_order_detail,
    ("raw_Sales", "SalesTerritory"): sales_territory,
    ("raw_Production", "Product"): product,
    ("raw_Production", "ProductSubcategory"): product_subcategory,
    ("raw_Production", "ProductCategory"): product_category,
    ("raw_Production", "ProductModel"): product_model,
}


def source(spark: SparkSession, root: str, schema: str, name: str) -> DataFrame:
    """Resolve a raw table by logical (schema, table) name."""
    key = (schema, name)
    if key in _registered:
        return spark.read.parquet(_registered[key])
    if key not in _BUILDERS:
        raise KeyError(f"unknown source {schema}.{name}")
    return _BUILDERS[key](spark, root)


# Change histories on the events table (key = user_id, ts = ModifiedDate, tiebreak = event_id).
ACTIVITY_TYPES = ("view", "click", "purchase")
STATUS_TYPES = ("signup", "error")
STATUS_BAND_WIDTH = 40.0


def events(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events")


def activity_history(spark: SparkSession, root: str) -> DataFrame:
    """Left history for temporal joins: the user's activity type."""
    return events(spark, root).filter(F.col("event_type").isin(*ACTIVITY_TYPES))


def status_history(spark: SparkSession, root: str) -> DataFrame:
    """Right history for temporal joins: a value band of signup/error events."""
    e = events(spark, root).filter(F.col("event_type").isin(*STATUS_TYPES))
    return e.select("user_id", "ts", "event_id", F.floor(F.col("value") / STATUS_BAND_WIDTH).cast("string").alias("band"))
