"""
the DuckDB oracle SQL for each.  All read the driver tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators.calendar import date_dim
from ..operators.staging import select_except
from ..sources import catalog
from . import mart
from . import oracle as O

LOAD_TS = "2026-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_ts():
    return F.lit(LOAD_TS).cast("timestamp_ntz")


# --- staging (O-10 .. O-13) ------------------------------------------------------------------

@register("stg_order_detail", O.with_ctes(["stg_detail"], "SELECT * FROM stg_detail"))
def q_stg_order_detail(spark, d):
    return mart.stg_order_detail(spark, d)


@register("stg_order_header", O.with_ctes(["stg_header"], "SELECT * FROM stg_header"))
def q_stg_order_header(spark, d):
    return mart.stg_order_header(spark, d)


@register("stg_territory", O.with_ctes(["stg_territory"], "SELECT * FROM stg_territory"))
def q_stg_territory(spark, d):
    return mart.stg_territory(spark, d)


@register("project_except", "SELECT * EXCLUDE (l_discount, l_tax, l_returnflag, l_linestatus) FROM lineitem")
def q_project_except(spark, d):
    return select_except(catalog.table(spark, d, "lineitem"), ["l_discount", "l_tax", "l_returnflag", "l_linestatus"])


# --- joins and the star schema (O-17, O-19 .. O-21, O-38 .. O-42) -----------------------------

@register("int_sales_join", O.with_ctes(["int_sales"], "SELECT * FROM int_sales"))
def q_int_sales_join(spark, d):
    return mart.int_sales_join(mart.stg_order_detail(spark, d), mart.stg_order_header(spark, d))


@register("sample_first_n", O.with_ctes(["int_sales"], """
    SELECT * FROM int_sales
    ORDER BY OrderDate, SalesOrderID, ProductID, ModifiedDate, OrderQty, UnitPrice, LineTotal LIMIT 10000"""))
def q_sample_first_n(spark, d):
    # The development-target sample: the first 10,000 lines by order date (the feature is the limit).
    s = q_int_sales_join(spark, d)
    return s.orderBy("OrderDate", "SalesOrderID", "ProductID", "ModifiedDate", "OrderQty", "UnitPrice", "LineTotal").limit(10000)


@register("dim_territory", O.with_ctes(["dim_territory"], "SELECT * FROM dim_territory"))
def q_dim_territory(spark, d):
    return mart.dim_territory(mart.stg_territory(spark, d))


@register("dim_date", """
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS DateKey, d AS Date, CAST(day(d) AS BIGINT) AS Day,
           CAST(strftime(d, '%U') AS BIGINT) AS Week, CAST(month(d) AS BIGINT) AS Month,
           CAST(quarter(d) AS BIGINT) AS Quarter,
           CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
                WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS Season,
           CAST(year(d) AS BIGINT) AS Year
    FROM (SELECT CAST(range AS DATE) AS d FROM range(
            (SELECT least(DATE '1990-01-01', CAST(min(o_orderdate) AS DATE)) FROM orders),
            (SELECT greatest(DATE '2050-12-31', CAST(max(o_orderdate) AS DATE) + 1) FROM orders),
            INTERVAL 1 DAY))""")
def q_dim_date(spark, d):
    # The calendar spine, widened to every order date in the data.
    return date_dim(spark, cover=catalog.table(spark, d, "orders"), cover_column="o_orderdate")


@register("surrogate_key", f"""
    SELECT p_partkey, {O.skey([("p_partkey", "int"), ("p_name", "str"), ("p_brand", "str"), ("p_retailprice", "double"), ("p_size", "int")])} AS part_key
    FROM part""")
def q_surrogate_key(spark, d):
    p = catalog.table(spark, d, "part")
    return p.select("p_partkey", surrogate_key(p, ["p_partkey", "p_name", "p_brand", "p_retailprice", "p_size"]).alias("part_key"))


@register("temporal_join_chain", O.with_ctes(["product_history"], "SELECT * FROM product_history"))
def q_temporal_join_chain(spark, d):
    return mart.product_history(mart.snapshots(spark, d))


@register("dim_product", O.with_ctes(["dim_product"], "SELECT * FROM dim_product"))
def q_dim_product(spark, d):
    return mart.dim_product(mart.product_history(mart.snapshots(spark, d)))


@register("fact_sales_full", O.with_ctes(["fact_full"], "SELECT * FROM fact_full"))
def q_fact_sales_full(spark, d):
    return mart.fact_sales_full(spark, d, load_ts())


# --- ingest and change history (O-3, O-4, O-18, O-20, O-32, O-34, O-35) -----------------------

from . import histories as H  # noqa: E402


@register("ingest_cursor_increment", f"SELECT * FROM events WHERE ts > TIMESTAMP '{H.CURSOR_HWM}'")
def q_ingest_cursor_increment(spark, d):
    return H.events_increment(spark, d)


@register("ingest_latest_per_key", """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    ) WHERE rn = 1""")
def q_ingest_latest_per_key(spark, d):
    return H.events_latest(spark, d)


@register("dedupe_changes", O.with_ctes(["events_dedup"], "SELECT * FROM events_dedup"))
def q_dedupe_changes(spark, d):
    return H.events_deduped(spark, d)


@register("scd2_from_history", O.with_ctes(["events_scd2"], "SELECT * FROM events_scd2"))
def q_scd2_from_history(spark, d):
    return H.events_scd2(spark, d)


# Merging the later half of the history into the SCD-2 table of the earlier half must equal the
# rebuild from the whole history: the oracle is the rebuild.
@register("scd2_merge", O.with_ctes(["events_scd2"], "SELECT * FROM events_scd2"))
def q_scd2_merge(spark, d):
    return H.events_scd2_merged(spark, d)


@register("scd2_stored_merge", O.with_ctes(["events_scd2"], "SELECT * FROM events_scd2"))
def q_scd2_stored_merge(spark, d):
    return H.events_scd2_stored(spark, d)


@register("temporal_join_overlap", O.with_ctes(["activity_status_drop"], "SELECT * FROM activity_status_drop"))
def q_temporal_join_overlap(spark, d):
    return H.activity_status(spark, d, "drop")


@register("temporal_join_gap_preserving", O.with_ctes(["activity_status_keep"], "SELECT * FROM activity_status_keep"))
def q_temporal_join_gap_preserving(spark, d):
    return H.activity_status(spark, d, "keep")


@register("pit_join_fact_dim", O.with_ctes(["status_scd2"], """
    SELECT p.event_id, p.ts, p.user_id, p.value, s.band
    FROM (SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase') p
    JOIN status_scd2 s ON p.user_id = s.user_id AND p.ts >= s.valid_from AND p.ts < s.valid_to"""))
def q_pit_join_fact_dim(spark, d):
    return H.purchases_with_status(spark, d, "asof")


# --- data checks (O-22, O-23, O-30, O-47 .. O-52) ----------------------------------------------

from ..operators import checks as C  # noqa: E402
from ..operators.upsert import lookback_window  # noqa: E402
from . import quality as Q  # noqa: E402


@register("check_not_null", O.with_ctes(["raw_header"], "SELECT * FROM raw_header WHERE TerritoryID IS NULL"))
def q_check_not_null(spark, d):
    return C.not_null(catalog.source(spark, d, "raw_Sales", "SalesOrderHeader"), "TerritoryID")


@register("check_unique", O.with_ctes(["stg_detail"], """
    SELECT SalesOrderID, ProductID, count(*) AS n_records FROM stg_detail
    WHERE SalesOrderID IS NOT NULL AND ProductID IS NOT NULL GROUP BY SalesOrderID, ProductID HAVING count(*) > 1"""))
def q_check_unique(spark, d):
    return C.unique(mart.stg_order_detail(spark, d), ["SalesOrderID", "ProductID"])


@register("check_relationships", O.with_ctes(["stg_detail", "stg_header", "raw_product"], """
    SELECT 'detail_order' AS check_name, c.SalesOrderID AS from_field FROM stg_detail c
      WHERE NOT EXISTS (SELECT 1 FROM stg_header p WHERE p.SalesOrderID = c.SalesOrderID)
    UNION ALL
    SELECT 'detail_product', c.ProductID FROM stg_detail c
      WHERE NOT EXISTS (SELECT 1 FROM raw_product p WHERE p.ProductID = c.ProductID)
    UNION ALL
    SELECT 'order_has_lines', c.SalesOrderID FROM stg_header c
      WHERE NOT EXISTS (SELECT 1 FROM stg_detail p WHERE p.SalesOrderID = c.SalesOrderID)"""))
def q_check_relationships(spark, d):
    detail, header = mart.stg_order_detail(spark, d), mart.stg_order_header(spark, d)
    product = catalog.source(spark, d, "raw_Production", "Product")
    parts = {
        "detail_order": C.relationships(detail, "SalesOrderID", header, "SalesOrderID"),
        "detail_product": C.relationships(detail, "ProductID", product, "ProductID"),
        "order_has_lines": C.relationships(header, "SalesOrderID", detail, "SalesOrderID"),
    }
    out = None
    for name, df in parts.items():
        p = df.select(F.lit(name).alias("check_name"), "from_field")
        out = p if out is None else out.unionByName(p)
    return out


@register("check_accepted_range", O.with_ctes(["stg_detail"], """
    SELECT 'unit_price' AS check_name, UnitPrice AS value FROM stg_detail WHERE NOT (UnitPrice >= 0)
    UNION ALL SELECT 'order_qty', CAST(OrderQty AS DOUBLE) FROM stg_detail WHERE NOT (OrderQty >= 1)
    UNION ALL SELECT 'line_total', LineTotal FROM stg_detail WHERE NOT (LineTotal >= 0)
    UNION ALL SELECT 'discount_max', l_discount FROM lineitem WHERE NOT (l_discount >= 0 AND l_discount <= 0.08)"""))
def q_check_accepted_range(spark, d):
    detail = mart.stg_order_detail(spark, d)
    parts = [
        ("unit_price", C.accepted_range(detail, "UnitPrice", min_value=0)),
        ("order_qty", C.accepted_range(detail, "OrderQty", min_value=1)),
        ("line_total", C.accepted_range(detail, "LineTotal", min_value=0)),
        ("discount_max", C.accepted_range(catalog.table(spark, d, "lineitem"), "l_discount", 0, 0.08)),
    ]
    out = None
    for name, df in parts:
        p = df.select(F.lit(name).alias("check_name"), F.col(df.columns[0]).cast("double").alias("value"))
        out = p if out is None else out.unionByName(p)
    return out


@register("check_scd_time_range", O.with_ctes(["seeded", "snap_category", "snap_model", "snap_subcategory"], """
    SELECT 'category' AS check_name, h.ProductID, h.valid_from, h.valid_to FROM seeded h
      WHERE h.ProductSubcategorySnapshot__ProductCategoryID IS NOT NULL AND h.ProductCategorySnapshot__Name IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM snap_category s WHERE s.ProductCategoryID = h.ProductSubcategorySnapshot__ProductCategoryID
                        AND s.Name = h.ProductCategorySnapshot__Name AND s.valid_from <= h.valid_from AND s.valid_to >= h.valid_to)
    UNION ALL
    SELECT 'model', h.ProductID, h.valid_from, h.valid_to FROM seeded h
      WHERE h.ProductModelID IS NOT NULL AND h.ProductModelSnapshot__Name IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM snap_model s WHERE s.ProductModelID = h.ProductModelID
                        AND s.Name = h.ProductModelSnapshot__Name AND s.valid_from <= h.valid_from AND s.valid_to >= h.valid_to)
    UNION ALL
    SELECT 'subcategory', h.ProductID, h.valid_from, h.valid_to FROM seeded h
      WHERE h.ProductSubcategoryID IS NOT NULL AND h.ProductSubcategorySnapshot__Name IS NOT NULL
        AND h.ProductSubcategorySnapshot__ProductCategoryID IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM snap_subcategory s WHERE s.ProductSubcategoryID = h.ProductSubcategoryID
                        AND s.Name = h.ProductSubcategorySnapshot__Name
                        AND s.ProductCategoryID = h.ProductSubcategorySnapshot__ProductCategoryID
                        AND s.valid_from <= h.valid_from AND s.valid_to >= h.valid_to)"""))
def q_check_scd_time_range(spark, d):
    return Q.scd_audit(spark, d, seed=True)


_SUITE_TABLE_CTES = {"header": "raw_header", "detail": "raw_detail", "territory": "raw_territory",
                     "product_latest": "product_latest", "subcategory": "raw_subcategory", "category": "raw_category",
                     "dim_product": "dim_product", "dim_date": "dim_date", "dim_territory": "dim_territory", "fact": "fact_full",
                     "product_history": "product_history", "snap_category": "snap_category", "snap_model": "snap_model",
                     "snap_subcategory": "snap_subcategory"}


def _suite_sql() -> str:
    parts = []
    for s in Q.SUITE:
        args = dict(s.args)
        if "to" in args:
            args["to"] = _SUITE_TABLE_CTES[args["to"]]
        parts.append(O.check_sql(s.name, _SUITE_TABLE_CTES[s.table], s.kind, s.column, args, label=s.table))
    return O.with_ctes(sorted(set(_SUITE_TABLE_CTES.values())), "\nUNION ALL\n".join(parts))


@register("check_suite_summary", _suite_sql())
def q_check_suite_summary(spark, d):
    return C.run_suite(Q.SUITE, Q.suite_tables(spark, d, load_ts()))


# --- incremental fact loads (O-7, O-15, O-44) ---------------------------------------------------

# Fixed parameters: the state of the fact table before the incremental run.
INCREMENTAL_TARGET_BEFORE = "2001-07-01 00:00:00"   # target = fact of orders placed before this
REPLAY_LOADED_BEFORE = "2001-09-01 00:00:00"        # target = fact of lines shipped before this
LOOKBACK_DAYS = 7


def _target_by_order_date(m: mart.Mart) -> DataFrame:
    loaded = m.sales.filter(F.col("OrderDate") < F.lit(INCREMENTAL_TARGET_BEFORE).cast("timestamp_ntz"))
    return mart.fact_sales(loaded, m.dim_product, m.dim_territory, load_ts())


def _target_by_ship_date(m: mart.Mart) -> DataFrame:
    loaded = m.sales.filter(F.col("ModifiedDate") < F.lit(REPLAY_LOADED_BEFORE).cast("timestamp_ntz"))
    return mart.fact_sales(loaded, m.dim_product, m.dim_territory, load_ts())


def _incremental_sql(target_filter: str, final: str) -> str:
    target = O.fact_sql(f"(SELECT * FROM int_sales WHERE {target_filter})")
    window = f"""
      SELECT * FROM int_sales WHERE OrderDate >= (
        SELECT CAST(strptime(CAST(max(OrderDateKey) AS VARCHAR), '%Y%m%d') AS DATE) - INTERVAL {LOOKBACK_DAYS} DAY
        FROM target)"""
    batch = O.fact_sql("win")
    body = O.with_ctes(["int_sales", "dim_product", "dim_territory"], "SELECT 1")
    body = body[: body.rindex("SELECT 1")].rstrip()
    return f"""{body},
target AS ({target}),
win AS ({window}),
batch AS ({batch}),
merged AS (
  SELECT t.* FROM target t WHERE NOT EXISTS (
    SELECT 1 FROM batch b WHERE b.ProductKey = t.ProductKey AND b.SalesOrderID = t.SalesOrderID)
  UNION ALL SELECT * FROM batch)
{final}"""


@register("fact_incremental_window", _incremental_sql(f"OrderDate < TIMESTAMP '{INCREMENTAL_TARGET_BEFORE}'", "SELECT * FROM win"))
def q_fact_incremental_window(spark, d):
    m = mart.build_mart(spark, d)
    return lookback_window(m.sales, _target_by_order_date(m), "OrderDate", "OrderDateKey", LOOKBACK_DAYS)


@register("fact_upsert", _incremental_sql(f"OrderDate < TIMESTAMP '{INCREMENTAL_TARGET_BEFORE}'", "SELECT * FROM merged"))
def q_fact_upsert(spark, d):
    m = mart.build_mart(spark, d)
    return mart.fact_incremental(m.sales, _target_by_order_date(m), m.dim_product, m.dim_territory, LOOKBACK_DAYS, load_ts())


# The replay has to end where a full load ends, so that is its oracle.
@register("fact_late_arrival_replay", O.with_ctes(["fact_full"], "SELECT * FROM fact_full"))
def q_fact_late_arrival_replay(spark, d):
    m = mart.build_mart(spark, d)
    return mart.fact_incremental(m.sales, _target_by_ship_date(m), m.dim_product, m.dim_territory, LOOKBACK_DAYS, load_ts(),
                                 arrived_since=F.lit(REPLAY_LOADED_BEFORE).cast("timestamp_ntz"))


@register("fact_stored_incremental", O.with_ctes(["fact_full"], "SELECT * FROM fact_full"))
def q_fact_stored_incremental(spark, d):
    """Two runs over the stored, month-partitioned fact: the lines shipped before the cut, then the
    orders with lines that arrived since.  The table has to equal a full build."""
    import uuid

    from ..session import scratch_path

    m = mart.build_mart(spark, d)
    path, cut = scratch_path(spark, f"fact-{uuid.uuid4().hex[:12]}"), F.lit(REPLAY_LOADED_BEFORE).cast("timestamp_ntz")
    mart.load_fact(spark, path, m.sales.filter(F.col("ModifiedDate") < cut), m.dim_product, m.dim_territory, load_ts=load_ts())
    return mart.load_fact(spark, path, m.sales, m.dim_product, m.dim_territory, cut, load_ts()).drop(mart.FACT_PARTITION)


@register("fact_stored_lookback", _incremental_sql(f"OrderDate < TIMESTAMP '{INCREMENTAL_TARGET_BEFORE}'", "SELECT * FROM merged"))
def q_fact_stored_lookback(spark, d):
    """The look-back run over the stored fact, with the newest date from its layout."""
    import uuid

    from ..session import scratch_path

    m = mart.build_mart(spark, d)
    path = scratch_path(spark, f"fact-{uuid.uuid4().hex[:12]}")
    loaded = m.sales.filter(F.col("OrderDate") < F.lit(INCREMENTAL_TARGET_BEFORE).cast("timestamp_ntz"))
    mart.load_fact(spark, path, loaded, m.dim_product, m.dim_territory, load_ts=load_ts())
    return mart.load_fact_lookback(spark, path, m.sales, m.dim_product, m.dim_territory, LOOKBACK_DAYS, load_ts()).drop(mart.FACT_PARTITION)


# Checked after each of two loads; the second run reads the months that the second load wrote.
@register("check_fact_ledger", O.with_ctes(["fact_full"], "\nUNION ALL\n".join(
    O.check_sql(s.name, "fact_full", s.kind, s.column, s.args, label=s.table) for s in Q.FACT_LEDGER_SUITE)))
def q_check_fact_ledger(spark, d):
    import uuid

    from ..operators.check_ledger import run_changed
    from ..session import scratch_path

    m = mart.build_mart(spark, d)
    path, cut = scratch_path(spark, f"fact-{uuid.uuid4().hex[:12]}"), F.lit(REPLAY_LOADED_BEFORE).cast("timestamp_ntz")
    mart.load_fact(spark, path, m.sales.filter(F.col("ModifiedDate") < cut), m.dim_product, m.dim_territory, load_ts=load_ts())
    run_changed(spark, path, mart.FACT_PARTITION, Q.FACT_LEDGER_SUITE, f"{path}-ledger")
    mart.load_fact(spark, path, m.sales, m.dim_product, m.dim_territory, cut, load_ts())
    return run_changed(spark, path, mart.FACT_PARTITION, Q.FACT_LEDGER_SUITE, f"{path}-ledger")


LAYOUT_DAY = 20000615


# One day's rows from the fact in the interleaved order of product, order and date.
@register("fact_layout_lookup", O.with_ctes(["fact_full"], f"SELECT * FROM fact_full WHERE OrderDateKey = {LAYOUT_DAY}"))
def q_fact_layout_lookup(spark, d):
    import uuid

    from ..operators.upsert import write_interleaved
    from ..session import materialize, scratch_path

    m = mart.build_mart(spark, d)
    fact = materialize(mart.fact_sales(m.sales, m.dim_product, m.dim_territory, load_ts()), "fact")
    path = scratch_path(spark, f"fact-{uuid.uuid4().hex[:12]}")
    write_interleaved(fact, path, ["ProductKey", "SalesOrderID", "OrderDateKey"], files=16)
    return spark.read.parquet(path).filter(F.col("OrderDateKey") == LAYOUT_DAY)


# The dimension that the stored fact was built with lacks every fifth product's versions after the first and
# some products altogether; after the late versions the fact has to equal a full build.
@register("fact_rekeyed_late_versions", O.with_ctes(["fact_full"], "SELECT * FROM fact_full"))
def q_fact_rekeyed_late_versions(spark, d):
    import uuid

    from ..session import materialize, scratch_path

    m = mart.build_mart(spark, d)
    raw = catalog.source(spark, d, "raw_Production", "Product")
    first = F.lit(catalog.PRODUCT_VERSION_DATES[0]).cast("timestamp_ntz")
    early = raw.filter(~((F.col("ProductID") % 5 == 0) & (F.col("ModifiedDate") > first)) & (F.col("ProductID") % 97 != 0))
    old_dim = materialize(mart.dim_product(mart.product_history(mart.snapshots(spark, d, product=early))), "dim_product")
    path = scratch_path(spark, f"fact-{uuid.uuid4().hex[:12]}")
    mart.load_fact(spark, path, m.sales, old_dim, m.dim_territory, load_ts=load_ts())
    return mart.rekey_fact(spark, path, m.sales, old_dim, m.dim_product, m.dim_territory, load_ts()).drop(mart.FACT_PARTITION)


# --- market baskets and association rules (O-9, O-14, O-16, O-24 .. O-27, O-31, O-36, O-46) ---

from ..functions.rules import rule_hash, rule_id  # noqa: E402
from ..operators import baskets as B  # noqa: E402
from ..operators import rules as RU  # noqa: E402
from . import mining as MI  # noqa: E402

PAIR_RULES_MIN_SUPPORT = 0.05
SCOPE_TERRITORY, SCOPE_DATE, SCOPE_WINDOW = 2, 20000101, 365
RULES_DATE_FILTER = 20010802   # after the last order: all data, deterministic update date


def _basket_strings(df: DataFrame) -> DataFrame:
    arr = B.basket_arrays(df, "SalesOrderID", "ProductID")
    return arr.select("SalesOrderID", F.array_join(F.col("products").cast("array<string>"), ",").alias("products"))


_BASKET_SQL = """SELECT SalesOrderID, array_to_string(list_sort(list_distinct(array_agg(ProductID))), ',') AS products
    FROM mining_lines {where} GROUP BY SalesOrderID"""


@register("baskets", O.with_ctes(["mining_lines"], _BASKET_SQL.format(where="WHERE ProductID IS NOT NULL")))
def q_baskets(spark, d):
    return _basket_strings(MI.mining_lines(spark, d, load_ts()))


@register("basket_scope_window", O.with_ctes(["mining_lines"], _BASKET_SQL.format(
    where=f"WHERE ProductID IS NOT NULL AND TerritoryID = {SCOPE_TERRITORY} AND OrderDateKey < {SCOPE_DATE} AND OrderDateKey > 19990101")))
def q_basket_scope_window(spark, d):
    lines = MI.mining_lines(spark, d, where=MI.sales_in_window(SCOPE_TERRITORY, SCOPE_DATE, SCOPE_WINDOW))
    return _basket_strings(B.scope_filter(lines, "OrderDateKey", "TerritoryID", SCOPE_TERRITORY, SCOPE_DATE, SCOPE_WINDOW))


@register("mining_scopes", O.with_ctes(["dim_territory"], """
    SELECT DISTINCT CAST(TerritoryID AS BIGINT) AS territory_id FROM dim_territory
    UNION ALL SELECT CAST(NULL AS BIGINT)"""))
def q_mining_scopes(spark, d):
    return B.mining_scopes(mart.dim_territory(mart.stg_territory(spark, d)))


@register("item_support", O.with_ctes(["mining_lines"], f"""
    SELECT CASE WHEN i.scope = -1 THEN NULL ELSE i.scope END AS territory_id, i.item, i.item_count, n.n_baskets,
           CAST(i.item_count AS DOUBLE) / n.n_baskets AS support
    FROM (SELECT scope, item, count(*) AS item_count FROM ({O.items_sql('ProductName')}) GROUP BY scope, item) i
    JOIN (SELECT scope, count(DISTINCT basket) AS n_baskets FROM ({O.items_sql('ProductName')}) GROUP BY scope) n
      ON i.scope = n.scope"""))
def q_item_support(spark, d):
    s = B.item_support(MI.customer_items(spark, d))
    return s.select(B.output_scope(), "item", "item_count", "n_baskets", "support")


@register("adaptive_min_support", O.mining_sql("ProductName", """
    SELECT CASE WHEN scope = -1 THEN NULL ELSE scope END AS territory_id, n_baskets, n_items, n_pairs,
           round(max_support, 9) AS max_support, round(min_support, 9) AS min_support
    FROM ms"""))
def q_adaptive_min_support(spark, d):
    st = B.adaptive_min_support(B.scope_stats(MI.customer_items(spark, d)))
    return st.select(B.output_scope(), "n_baskets", "n_items", F.col("n_pairs").cast("bigint").alias("n_pairs"),
                     F.round("max_support", 9).alias("max_support"), F.round("min_support", 9).alias("min_support"))


_RULE_COLS = "antecedent_support, consequent_support, support, confidence, lift"


@register("pair_rules", O.mining_sql("ProductName", f"""
    SELECT CASE WHEN r.scope = -1 THEN NULL ELSE r.scope END AS territory_id, antecedent, consequent, {_RULE_COLS}
    FROM rules r JOIN nb ON r.scope = nb.scope
    WHERE r.pair_count >= CAST(ceil({PAIR_RULES_MIN_SUPPORT} * nb.n_baskets) AS BIGINT) AND r.confidence >= 0.65"""))
def q_pair_rules(spark, d):
    r = RU.pair_rules(MI.customer_items(spark, d), PAIR_RULES_MIN_SUPPORT)
    return r.select(B.output_scope(), "antecedent", "consequent", *_RULE_COLS.split(", "))


@register("rule_hash", O.mining_sql("ProductName", f"""
    SELECT CASE WHEN r.scope = -1 THEN NULL ELSE r.scope END AS territory_id, antecedent, consequent,
           sha256(antecedent || consequent) AS rule_hash, sha256(antecedent || ' => ' || consequent) AS rule_id
    FROM rules r JOIN nb ON r.scope = nb.scope
    WHERE r.pair_count >= CAST(ceil({PAIR_RULES_MIN_SUPPORT} * nb.n_baskets) AS BIGINT) AND r.confidence >= 0.65"""))
def q_rule_hash(spark, d):
    r = RU.pair_rules(MI.customer_items(spark, d), PAIR_RULES_MIN_SUPPORT)
    a, c = F.array("antecedent"), F.array("consequent")
    return r.select(B.output_scope(), "antecedent", "consequent", rule_hash(a, c).alias("rule_hash"), rule_id(a, c).alias("rule_id"))


@register("adaptive_rules", O.mining_sql("ProductName", f"""
    SELECT CASE WHEN scope = -1 THEN NULL ELSE scope END AS territory_id, antecedent, consequent, {_RULE_COLS}, chosen_level
    FROM top"""))
def q_adaptive_rules(spark, d):
    r = RU.adaptive_rules(MI.customer_items(spark, d))
    return r.select(B.output_scope(), "antecedent", "consequent", *_RULE_COLS.split(", "), "chosen_level")


_DECORATED_SQL = f"""
    SELECT antecedent AS antecedents, consequent AS consequents, {_RULE_COLS},
           CASE WHEN scope = -1 THEN NULL ELSE scope END AS territory_id, CAST(NULL AS BIGINT) AS window,
           CAST({RULES_DATE_FILTER} AS BIGINT) AS update_at,
           sha256(antecedent || consequent) AS rule_hash, sha256(antecedent || ' => ' || consequent) AS rule_id
    FROM top"""


def _published(df: DataFrame) -> DataFrame:
    """Decorated rules as compared with the oracle: arrays as text, the random row id left out."""
    return df.select(F.array_join("antecedents", ", ").alias("antecedents"), F.array_join("consequents", ", ").alias("consequents"),
                     *_RULE_COLS.split(", "), "territory_id", "window", "update_at", "rule_hash", "rule_id")


def _brand_rules(spark, d) -> DataFrame:
    lines = MI.sold_lines(spark, d)
    return RU.mine_rules(lines, "CustomerID", "ProductBrand", "TerritoryID", "OrderDateKey", RULES_DATE_FILTER)


@register("rules_by_territory", O.mining_sql("ProductBrand", _DECORATED_SQL))
def q_rules_by_territory(spark, d):
    return _published(_brand_rules(spark, d))


@register("rules_append_idempotent", O.mining_sql("ProductBrand", _DECORATED_SQL))
def q_rules_append_idempotent(spark, d):
    run = _brand_rules(spark, d)
    first = run.checkpoint()              # the table after the first run
    again = RU.upsert_rules(first, run)   # a retried run appends the same rules again
    return _published(again)


ITEMSET_MIN_SUPPORT = 0.01
MULTI_RULES_MIN_SUPPORT = 0.05   # of the orders of a scope: both this and the confidence leave rules out


@register("frequent_itemsets", O.itemsets_sql("ProductName", "SalesOrderID", ITEMSET_MIN_SUPPORT))
def q_frequent_itemsets(spark, d):
    lines = MI.sold_lines(spark, d)
    items = B.scoped_items(lines, "SalesOrderID", "ProductName", "TerritoryID")
    sets = RU.frequent_itemsets(items, ITEMSET_MIN_SUPPORT)
    return sets.select(B.output_scope(), F.array_join("items", ", ").alias("items"), "freq", "size",
                       (F.col("freq") / F.col("n_baskets")).alias("support"))


# Rules with several items per side from the itemsets; the oracle enumerates item bitmasks.
@register("multi_item_rules", O.multi_rules_sql("ProductType", "SalesOrderID", MULTI_RULES_MIN_SUPPORT))
def q_multi_item_rules(spark, d):
    items = B.scoped_items(MI.sold_lines(spark, d), "SalesOrderID", "ProductType", "TerritoryID")
    sets = RU.frequent_itemsets(items, MULTI_RULES_MIN_SUPPORT)
    rules = RU.multi_item_rules(sets)
    return rules.select(B.output_scope(), F.array_join("antecedents", ", ").alias("antecedents"),
                        F.array_join("consequents", ", ").alias("consequents"), *_RULE_COLS.split(", "))


AS_OF_DATES = [20000101 + 100 * k for k in range(12)]   # the first of each month of a year
AS_OF_WINDOW = 365


# Order baskets of brands in the year before each date; the SQL filters the lines once for each date.
@register("supports_as_of", O.as_of_sql("ProductBrand", "SalesOrderID", AS_OF_DATES, AS_OF_WINDOW))
def q_supports_as_of(spark, d):
    from ..operators.as_of import as_of_supports

    s = as_of_supports(MI.mining_lines(spark, d), "SalesOrderID", "ProductBrand", AS_OF_DATES, AS_OF_WINDOW)
    return s.select(B.output_scope(), "as_of", "a", "b", "n", "n_baskets", "support")


# --- streaming ingest (O-43) -------------------------------------------------------------------

from ..session import scratch_path  # noqa: E402
from ..streaming.ingest import buckets_for, ingest_latest_per_key  # noqa: E402

STREAM_FILES = 4


@register("ingest_stream_latest", """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    ) WHERE rn = 1""")
def q_ingest_stream_latest(spark, d):
    """The events table arrives as several files (split by time, as a sync would deliver them);
    the stream consumes one file per micro-batch and keeps the latest row per user."""
    import uuid

    run = scratch_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    ev = catalog.events(spark, d)
    # Arrival bucket = position of ts between the table's first and last timestamp (scalar subqueries).
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    lo = ev.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp")))).scalar()
    hi = ev.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).scalar()
    bucket = F.least(F.lit(STREAM_FILES - 1), F.floor((t - lo) * STREAM_FILES / F.greatest(hi - lo, F.lit(1))))
    arrivals = ev.withColumn("_arrival", bucket.cast("int"))
    arrivals.write.partitionBy("_arrival").parquet(f"{run}/landing")
    return ingest_latest_per_key(spark, f"{run}/landing/*/*.parquet", ev.schema, "user_id", "ts", "event_id",
                                 f"{run}/state", f"{run}/checkpoint", max_files_per_trigger=1, buckets=buckets_for(spark, f"{run}/landing"))
