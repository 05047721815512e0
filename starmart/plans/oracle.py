"""DuckDB SQL for every registered query: the independent oracle the Spark plans are checked against.

Written as plain ANSI-ish SQL over the driver's tables (pre-registered views).  Shared pieces are
CTEs; :func:`with_ctes` pulls in the ones a query needs, in dependency order.  Where the Spark side
uses a skew-safe formulation (chunked neighbours, right-side predecessor links, closed-form level
choice) the SQL here states the textbook one (plain windows, per-row gap windows, per-level
counts), so a match checks the formulation too.
"""

from __future__ import annotations

OPEN_END_SQL = "TIMESTAMP '9999-12-31 23:59:59'"
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def canon(col: str, kind: str) -> str:
    if kind == "double":
        return f"CAST(CAST({col} AS DECIMAL(38,6)) AS VARCHAR)"
    if kind == "ts":
        return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CAST({col} AS VARCHAR)"


def skey(cols: list[tuple[str, str]]) -> str:
    """Surrogate key: md5 of '-'-joined canonical text, NULL -> placeholder."""
    parts = ", ".join(f"COALESCE({canon(c, k)}, '{NULL_PLACEHOLDER}')" for c, k in cols)
    return f"md5(concat_ws('-', {parts}))"


def snapshot_sql(src: str, key: str, hash_cols: list[tuple[str, str]], ts: str = "ModifiedDate", tiebreak: str | None = None) -> str:
    order = f"{ts}, {tiebreak}" if tiebreak else ts
    return f"""
    SELECT * EXCLUDE (_nxt), {ts} AS valid_from, COALESCE(_nxt, {OPEN_END_SQL}) AS valid_to
    FROM (
      SELECT *, LEAD({ts}) OVER (PARTITION BY {key} ORDER BY {order}) AS _nxt
      FROM (
        SELECT * EXCLUDE (_prev) FROM (
          SELECT *, LAG(_dedupe_grain_id) OVER (PARTITION BY {key} ORDER BY {order}) AS _prev
          FROM (SELECT *, {skey(hash_cols)} AS _dedupe_grain_id FROM {src})
        ) WHERE _prev IS NULL OR _prev <> _dedupe_grain_id
      )
    ) WHERE COALESCE(_nxt, {OPEN_END_SQL}) > {ts}"""


def temporal_sql(left: str, left_cols: list[str], right: str, left_key: str, right_key: str,
                 attrs: list[str], prefix: str, gaps: str = "keep") -> str:
    """Temporal left join; gaps from a window over each left row's segments."""
    body = ", ".join(left_cols)
    a_sel = ", ".join(f"r.{a} AS {prefix}__{a}" for a in attrs)
    a_out = ", ".join(f"{prefix}__{a}" for a in attrs)
    a_null = ", ".join(f"NULL AS {prefix}__{a}" for a in attrs)
    lbody = ", ".join(f"l.{c}" for c in left_cols)
    part = ", ".join(left_cols + ["_lf", "_lt"])
    sql = f"""
    WITH j AS (
      SELECT {lbody}, l.valid_from AS _lf, l.valid_to AS _lt, r.{right_key} AS _rk, {a_sel},
             r.valid_from AS _rf, r.valid_to AS _rt
      FROM {left} l LEFT JOIN {right} r
        ON l.{left_key} = r.{right_key} AND r.valid_to > l.valid_from AND r.valid_from < l.valid_to
    ),
    seg AS (
      SELECT {body}, {a_out}, _lf, _lt, greatest(_lf, _rf) AS _sf, least(_lt, _rt) AS _st
      FROM j WHERE _rk IS NOT NULL
    )
    SELECT {body}, {a_out}, _sf AS valid_from, _st AS valid_to FROM seg
    UNION ALL
    SELECT {body}, {a_null}, _lf AS valid_from, _lt AS valid_to FROM j WHERE _rk IS NULL"""
    if gaps == "keep":
        sql += f"""
    UNION ALL
    SELECT {body}, {a_null}, gf AS valid_from, gt AS valid_to FROM (
      SELECT {body}, COALESCE(LAG(_st) OVER w, _lf) AS gf, _sf AS gt FROM seg
      WINDOW w AS (PARTITION BY {part} ORDER BY _sf, _st)
    ) WHERE gf < gt
    UNION ALL
    SELECT {body}, {a_null}, mt AS valid_from, _lt AS valid_to FROM (
      SELECT {body}, _lt, max(_st) AS mt FROM seg GROUP BY {part}
    ) WHERE mt < _lt"""
    return sql


# ---------------------------------------------------------------------------------------------
# Raw tables (stand-in mapping, FIXTURES.md §3) and the star-schema chain.

PRODUCT_COLS = ["ProductID", "Name", "ProductNumber", "Color", "ListPrice", "Size", "ProductSubcategoryID",
                "ProductModelID", "SellStartDate", "DiscontinuedDate", "ModifiedDate", "_dedupe_grain_id"]
PRODUCT_HASH = [("ProductID", "int"), ("Name", "str"), ("ProductNumber", "str"), ("Color", "str"),
                ("ListPrice", "double"), ("Size", "str"), ("ProductSubcategoryID", "int"), ("ProductModelID", "int"),
                ("SellStartDate", "ts"), ("DiscontinuedDate", "ts")]
CHAIN1_COLS = PRODUCT_COLS + ["ProductSubcategorySnapshot__Name", "ProductSubcategorySnapshot__ProductCategoryID"]
CHAIN2_COLS = CHAIN1_COLS + ["ProductCategorySnapshot__Name"]

CTES: dict[str, tuple[list[str], str]] = {
    "raw_header": ([], """
      SELECT o.o_orderkey AS SalesOrderID, o.o_custkey AS CustomerID, o.o_orderdate AS OrderDate,
             (o.o_orderpriority = '1-URGENT') AS OnlineOrderFlag,
             CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE CAST(n.n_regionkey AS BIGINT) + 1 END AS TerritoryID,
             o.o_orderdate AS ModifiedDate
      FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
                    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "raw_detail": ([], """
      SELECT l_orderkey AS SalesOrderID, CAST(l_linenumber AS BIGINT) AS SalesOrderLineNumber,
             l_partkey AS ProductID, l_shipdate AS ModifiedDate, l_quantity AS OrderQty,
             l_extendedprice / l_quantity AS UnitPrice, l_extendedprice AS LineTotal
      FROM lineitem"""),
    "raw_territory": ([], """
      SELECT CAST(r_regionkey AS BIGINT) + 1 AS TerritoryID, r_name AS Name, r_name AS "Group",
             substring(r_name, 1, 2) AS CountryRegionCode, TIMESTAMP '1990-01-01' AS ModifiedDate
      FROM region"""),
    "cat_ids": ([], """
      SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS ProductCategoryID
      FROM (SELECT DISTINCT p_type FROM part)"""),
    "sub_ids": ([], """
      SELECT p_type, p_brand, CAST(row_number() OVER (ORDER BY p_type, p_brand) AS BIGINT) AS ProductSubcategoryID
      FROM (SELECT DISTINCT p_type, p_brand FROM part)"""),
    "model_ids": ([], """
      SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) AS BIGINT) AS ProductModelID
      FROM (SELECT DISTINCT p_name FROM part)"""),
    "raw_product": (["sub_ids", "model_ids"], """
      SELECT p.p_partkey AS ProductID, p.p_name AS Name, 'P-' || CAST(p.p_partkey AS VARCHAR) AS ProductNumber,
             split_part(p.p_name, ' ', 1) AS Color,
             CASE WHEN p.p_partkey % 3 = 0 THEN p.p_retailprice + v.v * 10.0 ELSE p.p_retailprice END AS ListPrice,
             CAST(p.p_size AS VARCHAR) AS Size, s.ProductSubcategoryID, m.ProductModelID,
             TIMESTAMP '1990-01-01' AS SellStartDate, CAST(NULL AS TIMESTAMP) AS DiscontinuedDate, v.d AS ModifiedDate
      FROM part p
      LEFT JOIN sub_ids s ON p.p_type = s.p_type AND p.p_brand = s.p_brand
      LEFT JOIN model_ids m ON p.p_name = m.p_name
      CROSS JOIN (VALUES (0, TIMESTAMP '1990-01-01'), (1, TIMESTAMP '1997-01-01'), (2, TIMESTAMP '1999-07-01')) v(v, d)"""),
    "raw_subcategory": (["sub_ids", "cat_ids"], """
      SELECT s.ProductSubcategoryID, c.ProductCategoryID, s.p_brand AS Name, TIMESTAMP '1990-01-01' AS ModifiedDate
      FROM sub_ids s JOIN cat_ids c ON s.p_type = c.p_type"""),
    "raw_category": (["cat_ids"], """
      SELECT ProductCategoryID, p_type AS Name, TIMESTAMP '1990-01-01' AS ModifiedDate FROM cat_ids"""),
    "raw_model": (["model_ids"], """
      SELECT ProductModelID, p_name AS Name, TIMESTAMP '1990-01-01' AS ModifiedDate FROM model_ids"""),
    "stg_detail": (["raw_detail"], """
      SELECT CAST(SalesOrderID AS BIGINT) AS SalesOrderID, CAST(ProductID AS BIGINT) AS ProductID,
             CAST(ModifiedDate AS TIMESTAMP) AS ModifiedDate, abs(CAST(round(OrderQty) AS BIGINT)) AS OrderQty,
             abs(CAST(UnitPrice AS DOUBLE)) AS UnitPrice, abs(CAST(LineTotal AS DOUBLE)) AS LineTotal
      FROM raw_detail WHERE abs(CAST(LineTotal AS DOUBLE)) > 0"""),
    "stg_header": (["raw_header"], """
      SELECT CAST(SalesOrderID AS BIGINT) AS SalesOrderID, CAST(OrderDate AS TIMESTAMP) AS OrderDate,
             CAST(CAST(OnlineOrderFlag AS INTEGER) AS BIGINT) AS OnlineOrderFlag,
             COALESCE(CAST(TerritoryID AS BIGINT), 0) AS TerritoryID
      FROM raw_header"""),
    "stg_territory": (["raw_territory"], """
      SELECT CAST(TerritoryID AS BIGINT) AS TerritoryID, CAST(Name AS VARCHAR) AS TerritoryName,
             CAST("Group" AS VARCHAR) AS TerritoryGroup, CAST(CountryRegionCode AS VARCHAR) AS CountryRegionCode
      FROM raw_territory"""),
    "int_sales": (["stg_detail", "stg_header"], """
      SELECT d.*, h.OrderDate, h.OnlineOrderFlag, h.TerritoryID
      FROM stg_detail d LEFT JOIN stg_header h ON d.SalesOrderID = h.SalesOrderID"""),
    "dim_territory": (["stg_territory"], """
      SELECT CAST(0 AS BIGINT) AS TerritoryKey, CAST(0 AS BIGINT) AS TerritoryID, 'unknown' AS TerritoryName,
             'unknown' AS TerritoryGroup, 'unknown' AS CountryRegionCode
      UNION ALL
      SELECT CAST(row_number() OVER (ORDER BY TerritoryID) AS BIGINT) AS TerritoryKey, * FROM stg_territory"""),
    "snap_product": (["raw_product"], snapshot_sql("raw_product", "ProductID", PRODUCT_HASH)),
    "snap_subcategory": (["raw_subcategory"], snapshot_sql(
        "raw_subcategory", "ProductSubcategoryID",
        [("ProductSubcategoryID", "int"), ("ProductCategoryID", "int"), ("Name", "str")])),
    "snap_category": (["raw_category"], snapshot_sql("raw_category", "ProductCategoryID", [("ProductCategoryID", "int"), ("Name", "str")])),
    "snap_model": (["raw_model"], snapshot_sql("raw_model", "ProductModelID", [("ProductModelID", "int"), ("Name", "str")])),
    "chain1": (["snap_product", "snap_subcategory"], temporal_sql(
        "snap_product", PRODUCT_COLS, "snap_subcategory", "ProductSubcategoryID", "ProductSubcategoryID",
        ["Name", "ProductCategoryID"], "ProductSubcategorySnapshot")),
    "chain2": (["chain1", "snap_category"], temporal_sql(
        "chain1", CHAIN1_COLS, "snap_category", "ProductSubcategorySnapshot__ProductCategoryID", "ProductCategoryID",
        ["Name"], "ProductCategorySnapshot")),
    "product_history": (["chain2", "snap_model"], temporal_sql(
        "chain2", CHAIN2_COLS, "snap_model", "ProductModelID", "ProductModelID", ["Name"], "ProductModelSnapshot")),
}

PRODUCT_ATTR_KEY = [("ProductID", "int"), ("Name", "str"), ("Size", "str"), ("Color", "str"),
                    ("ProductModelSnapshot__Name", "str"), ("ProductCategorySnapshot__Name", "str"),
                    ("ProductSubcategorySnapshot__Name", "str"), ("DiscontinuedDate", "ts")]

CTES["dim_product"] = (["product_history"], f"""
      SELECT {skey(PRODUCT_ATTR_KEY + [("valid_from", "ts")])} AS ProductKey,
             {skey(PRODUCT_ATTR_KEY)} AS ProductAttrKey,
             CAST(ProductID AS BIGINT) AS ProductID, CAST(Name AS VARCHAR) AS Name, CAST(Size AS VARCHAR) AS ProductSize,
             CAST(Color AS VARCHAR) AS Color, CAST(ProductModelSnapshot__Name AS VARCHAR) AS Model,
             CAST(ProductCategorySnapshot__Name AS VARCHAR) AS Category,
             CAST(ProductSubcategorySnapshot__Name AS VARCHAR) AS Subcategory,
             CAST(DiscontinuedDate AS TIMESTAMP) AS DiscontinuedDate, valid_from AS ValidFrom, valid_to AS ValidTo,
             CAST(CASE WHEN valid_to = {OPEN_END_SQL} THEN 1 ELSE 0 END AS BIGINT) AS IsCurrentFlag
      FROM product_history""")

LOAD_TS_SQL = "TIMESTAMP '2026-01-01 00:00:00'"


def fact_sql(new_records: str) -> str:
    return f"""
      SELECT n.SalesOrderID, n.ModifiedDate, n.OrderQty, n.UnitPrice, n.LineTotal, n.OnlineOrderFlag,
             p.ProductKey, t.TerritoryKey,
             CAST(year(n.OrderDate) * 10000 + month(n.OrderDate) * 100 + day(n.OrderDate) AS BIGINT) AS OrderDateKey,
             {LOAD_TS_SQL} AS LoadDatetime
      FROM {new_records} n
      JOIN dim_product p ON n.ProductID = p.ProductID AND n.OrderDate >= p.ValidFrom AND n.OrderDate < p.ValidTo
      JOIN dim_territory t ON n.TerritoryID = t.TerritoryID"""


CTES["fact_full"] = (["int_sales", "dim_product", "dim_territory"], fact_sql("int_sales"))


def with_ctes(needed: list[str], final: str) -> str:
    """Prefix ``final`` with the CTEs it needs (transitively), dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        deps, _ = CTES[name]
        for d in deps:
            visit(d)
        order.append(name)

    for n in needed:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{final}"


# ---------------------------------------------------------------------------------------------
# Change histories on events (key user_id, cursor ts, tiebreak event_id).

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "_dedupe_grain_id"]
EVENT_HASH = [("user_id", "int"), ("event_type", "str")]
STATUS_SRC = """(SELECT user_id, ts, event_id, CAST(CAST(floor(value / 40.0) AS BIGINT) AS VARCHAR) AS band
                 FROM events WHERE event_type IN ('signup', 'error'))"""
ACTIVITY_SRC = "(SELECT * FROM events WHERE event_type IN ('view', 'click', 'purchase'))"

CTES.update({
    "events_dedup": ([], f"""
      SELECT * EXCLUDE (_prev) FROM (
        SELECT *, LAG(_dedupe_grain_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS _prev
        FROM (SELECT *, {skey(EVENT_HASH)} AS _dedupe_grain_id FROM events)
      ) WHERE _prev IS NULL OR _prev <> _dedupe_grain_id"""),
    "events_scd2": ([], snapshot_sql("events", "user_id", EVENT_HASH, "ts", "event_id")),
    "activity_scd2": ([], snapshot_sql(ACTIVITY_SRC, "user_id", EVENT_HASH, "ts", "event_id")),
    "status_scd2": ([], snapshot_sql(STATUS_SRC, "user_id", [("user_id", "int"), ("band", "str")], "ts", "event_id")),
})
CTES["activity_status_drop"] = (["activity_scd2", "status_scd2"], temporal_sql(
    "activity_scd2", EVENT_COLS, "status_scd2", "user_id", "user_id", ["band"], "status", gaps="drop"))
CTES["activity_status_keep"] = (["activity_scd2", "status_scd2"], temporal_sql(
    "activity_scd2", EVENT_COLS, "status_scd2", "user_id", "user_id", ["band"], "status", gaps="keep"))

CTES["dim_date"] = ([], """
      SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS DateKey, d AS Date, CAST(day(d) AS BIGINT) AS Day,
             CAST(strftime(d, '%U') AS BIGINT) AS Week, CAST(month(d) AS BIGINT) AS Month,
             CAST(quarter(d) AS BIGINT) AS Quarter,
             CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
                  WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS Season,
             CAST(year(d) AS BIGINT) AS Year
      FROM (SELECT CAST(range AS DATE) AS d FROM range(DATE '1990-01-01', DATE '2050-12-31', INTERVAL 1 DAY))""")
CTES["product_latest"] = (["raw_product"], """
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY ModifiedDate DESC) AS rn FROM raw_product
      ) WHERE rn = 1""")


def check_sql(name: str, table: str, kind: str, column, args: dict, label: str | None = None) -> str:
    """SQL of one check returning (check_name, table_name, kind, n_failed)."""
    head = f"SELECT '{name}' AS check_name, '{label or table}' AS table_name, '{kind}' AS kind, CAST(count(*) AS BIGINT) AS n_failed"
    if kind == "not_null":
        return f"{head} FROM {table} WHERE {column} IS NULL"
    if kind == "unique":
        cols = [column] if isinstance(column, str) else list(column)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        return f"{head} FROM (SELECT {', '.join(cols)} FROM {table} WHERE {nn} GROUP BY ALL HAVING count(*) > 1)"
    if kind == "relationships":
        return (f"{head} FROM {table} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {args['to']} p WHERE p.{args['field']} = c.{column})")
    if kind == "accepted_range":
        conds = []
        op_lo, op_hi = (">=", "<=") if args.get("inclusive", True) else (">", "<")
        if args.get("min_value") is not None:
            conds.append(f"{column} {op_lo} {args['min_value']}")
        if args.get("max_value") is not None:
            conds.append(f"{column} {op_hi} {args['max_value']}")
        return f"{head} FROM {table} WHERE NOT ({' AND '.join(conds)})"
    if kind == "scd_time_range":
        filled = " AND ".join(f"h.{h} IS NOT NULL" for h, _ in args["on"])
        equal = " AND ".join(f"p.{p} = h.{h}" for h, p in args["on"])
        return (f"{head} FROM {table} h WHERE {filled} AND NOT EXISTS (SELECT 1 FROM {args['to']} p "
                f"WHERE {equal} AND p.valid_from <= h.valid_from AND p.valid_to >= h.valid_to)")
    raise ValueError(kind)


# The product history with seeded range violations: every 50th product starts a day too early.
CTES["seeded"] = (["product_history"], """
      SELECT * REPLACE (CASE WHEN ProductID % 50 = 0 THEN valid_from - INTERVAL 1 DAY ELSE valid_from END AS valid_from)
      FROM product_history""")


# ---------------------------------------------------------------------------------------------
# Mining.

CTES["mining_lines"] = (["fact_full", "dim_product", "dim_territory", "raw_header"], """
      SELECT f.SalesOrderID, h.CustomerID, p.ProductID, p.Name AS ProductName, p.Subcategory AS ProductBrand,
             p.Category AS ProductType, t.TerritoryID, f.OrderDateKey
      FROM fact_full f JOIN dim_product p ON f.ProductKey = p.ProductKey
      JOIN dim_territory t ON f.TerritoryKey = t.TerritoryKey
      LEFT JOIN raw_header h ON f.SalesOrderID = h.SalesOrderID""")


def items_sql(item: str, basket: str = "CustomerID") -> str:
    return f"""
      SELECT DISTINCT scope, basket, item FROM (
        SELECT CAST(TerritoryID AS BIGINT) AS scope, {basket} AS basket, {item} AS item FROM mining_lines
        UNION ALL
        SELECT CAST(-1 AS BIGINT), {basket}, {item} FROM mining_lines
      ) WHERE item IS NOT NULL AND basket IS NOT NULL AND scope IS NOT NULL"""


def mining_sql(item: str, final: str, max_rules: int = 35, basket: str = "CustomerID") -> str:
    """Adaptive single-item rules stated per level: for each support level the original loop may
    try, count the qualifying rules; take the first level with enough, else the last."""
    enough = int(0.8 * max_rules)
    levels = " UNION ALL ".join(
        f"SELECT scope, n_baskets, {k} AS level, m0{' * 0.75' * k} AS m FROM ms" for k in range(5))
    body = O_with_ctes(["mining_lines"])
    return f"""{body},
items AS ({items_sql(item, basket)}),
nb AS (SELECT scope, count(DISTINCT basket) AS n_baskets FROM items GROUP BY scope),
ic AS (SELECT scope, item, count(*) AS item_count FROM items GROUP BY scope, item),
st AS (SELECT ic.scope, count(*) AS n_items, CAST(sum(item_count) AS BIGINT) AS n_pairs,
              max(item_count) AS max_item_count, any_value(nb.n_baskets) AS n_baskets
       FROM ic JOIN nb ON ic.scope = nb.scope GROUP BY ic.scope),
ms AS (SELECT *, CAST(max_item_count AS DOUBLE) / n_baskets AS max_support,
              (CAST(max_item_count AS DOUBLE) / n_baskets)
                * (1 - pow(1 / sqrt(pow(2.0, n_items) - 1), 1 / (CAST(n_pairs AS DOUBLE) / n_items))) AS min_support,
              CASE WHEN (CAST(max_item_count AS DOUBLE) / n_baskets)
                * (1 - pow(1 / sqrt(pow(2.0, n_items) - 1), 1 / (CAST(n_pairs AS DOUBLE) / n_items))) >= 0.01
                   THEN (CAST(max_item_count AS DOUBLE) / n_baskets)
                * (1 - pow(1 / sqrt(pow(2.0, n_items) - 1), 1 / (CAST(n_pairs AS DOUBLE) / n_items))) ELSE 0.01 END AS m0
       FROM st),
lv AS (SELECT scope, n_baskets, level, m, CAST(ceil(m * n_baskets) AS BIGINT) AS min_count
       FROM ({levels}) WHERE m >= 0.01),
pairs AS (SELECT x.scope, x.item AS a, y.item AS b, count(*) AS pair_count
          FROM items x JOIN items y ON x.scope = y.scope AND x.basket = y.basket AND x.item < y.item
          GROUP BY x.scope, x.item, y.item),
dir AS (SELECT scope, a AS antecedent, b AS consequent, pair_count FROM pairs
        UNION ALL SELECT scope, b, a, pair_count FROM pairs),
rules AS (SELECT d.scope, d.antecedent, d.consequent, d.pair_count,
                 CAST(ia.item_count AS DOUBLE) / nb.n_baskets AS antecedent_support,
                 CAST(ic2.item_count AS DOUBLE) / nb.n_baskets AS consequent_support,
                 CAST(d.pair_count AS DOUBLE) / nb.n_baskets AS support,
                 (CAST(d.pair_count AS DOUBLE) / nb.n_baskets) / (CAST(ia.item_count AS DOUBLE) / nb.n_baskets) AS confidence,
                 ((CAST(d.pair_count AS DOUBLE) / nb.n_baskets) / (CAST(ia.item_count AS DOUBLE) / nb.n_baskets))
                   / (CAST(ic2.item_count AS DOUBLE) / nb.n_baskets) AS lift
          FROM dir d JOIN nb ON d.scope = nb.scope
          JOIN ic ia ON ia.scope = d.scope AND ia.item = d.antecedent
          JOIN ic ic2 ON ic2.scope = d.scope AND ic2.item = d.consequent),
cnt AS (SELECT lv.scope, lv.level, count(r.antecedent) AS n_rules
        FROM lv LEFT JOIN rules r ON r.scope = lv.scope AND r.pair_count >= lv.min_count AND r.confidence >= 0.65
        GROUP BY lv.scope, lv.level),
chosen AS (SELECT scope, COALESCE(min(CASE WHEN least(n_rules, {max_rules}) > {enough} THEN level END), max(level)) AS chosen_level
           FROM cnt GROUP BY scope),
top AS (SELECT * FROM (
          SELECT r.*, c.chosen_level,
                 row_number() OVER (PARTITION BY r.scope ORDER BY r.support DESC, r.lift DESC, r.antecedent, r.consequent) AS rk
          FROM rules r JOIN chosen c ON r.scope = c.scope
          JOIN lv ON lv.scope = r.scope AND lv.level = c.chosen_level
          WHERE r.pair_count >= lv.min_count AND r.confidence >= 0.65) WHERE rk <= {max_rules})
{final}"""


def O_with_ctes(needed: list[str]) -> str:
    body = with_ctes(needed, "SELECT 1")
    return body[: body.rindex("SELECT 1")].rstrip()


def itemsets_sql(item: str, basket: str, min_support: float) -> str:
    """Frequent itemsets of one to three items per scope (count >= ceil(min_support * baskets))."""
    body = O_with_ctes(["mining_lines"])
    need = f"CAST(ceil({min_support} * nb.n_baskets) AS BIGINT)"
    return f"""{body},
items AS ({items_sql(item, basket)}),
nb AS (SELECT scope, count(DISTINCT basket) AS n_baskets FROM items GROUP BY scope),
s1 AS (SELECT scope, item AS items, count(*) AS freq, 1 AS size FROM items GROUP BY scope, item),
s2 AS (SELECT x.scope, x.item || ', ' || y.item AS items, count(*) AS freq, 2 AS size
       FROM items x JOIN items y ON x.scope = y.scope AND x.basket = y.basket AND x.item < y.item
       GROUP BY x.scope, x.item, y.item),
s3 AS (SELECT x.scope, x.item || ', ' || y.item || ', ' || z.item AS items, count(*) AS freq, 3 AS size
       FROM items x JOIN items y ON x.scope = y.scope AND x.basket = y.basket AND x.item < y.item
       JOIN items z ON z.scope = x.scope AND z.basket = x.basket AND y.item < z.item
       GROUP BY x.scope, x.item, y.item, z.item),
al AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)
SELECT CASE WHEN al.scope = -1 THEN NULL ELSE al.scope END AS territory_id, al.items, al.freq, al.size,
       CAST(al.freq AS DOUBLE) / nb.n_baskets AS support
FROM al JOIN nb ON al.scope = nb.scope WHERE al.freq >= {need}"""


def as_of_sql(item: str, basket: str, dates: list[int], window: int) -> str:
    """Item and pair supports per scope, with the lines filtered for each date by itself."""
    body = O_with_ctes(["mining_lines"])
    values = ", ".join(f"({d})" for d in dates)
    return f"""{body},
dates AS (SELECT as_of, CAST(strftime(strptime(CAST(as_of AS VARCHAR), '%Y%m%d') - INTERVAL {window} DAY, '%Y%m%d') AS BIGINT) AS lo FROM (VALUES {values}) v(as_of)),
items AS (SELECT DISTINCT as_of, scope, basket, item FROM (
  SELECT d.as_of, CAST(TerritoryID AS BIGINT) AS scope, {basket} AS basket, {item} AS item FROM mining_lines l JOIN dates d ON l.OrderDateKey < d.as_of AND l.OrderDateKey > d.lo
  UNION ALL
  SELECT d.as_of, CAST(NULL AS BIGINT), {basket}, {item} FROM mining_lines l JOIN dates d ON l.OrderDateKey < d.as_of AND l.OrderDateKey > d.lo)
  WHERE item IS NOT NULL AND basket IS NOT NULL),
nb AS (SELECT as_of, scope, count(DISTINCT basket) AS n_baskets FROM items GROUP BY as_of, scope),
c AS (SELECT as_of, scope, item AS a, CAST(NULL AS VARCHAR) AS b, count(*) AS n FROM items GROUP BY as_of, scope, item
      UNION ALL
      SELECT x.as_of, x.scope, x.item, y.item, count(*) FROM items x JOIN items y
      ON x.as_of = y.as_of AND x.scope IS NOT DISTINCT FROM y.scope AND x.basket = y.basket AND x.item < y.item GROUP BY x.as_of, x.scope, x.item, y.item)
SELECT c.scope AS territory_id, CAST(c.as_of AS BIGINT) AS as_of, a, b, n, n_baskets, CAST(n AS DOUBLE) / n_baskets AS support
FROM c JOIN nb ON nb.as_of = c.as_of AND nb.scope IS NOT DISTINCT FROM c.scope"""


def multi_rules_sql(item: str, basket: str, min_support: float, min_conf: float = 0.65) -> str:
    """Rules with any number of items per side, by brute force over item bitmasks: every subset of
    a scope's items is a mask, its support is the number of baskets whose mask contains it, and
    every frequent itemset is split into all (antecedent, consequent) mask pairs.  Only usable for
    small item universes (the registered query has six)."""
    body = O_with_ctes(["mining_lines"])
    return f"""{body},
items AS ({items_sql(item, basket)}),
nb AS (SELECT scope, count(DISTINCT basket) AS n_baskets FROM items GROUP BY scope),
idx AS (SELECT scope, item, CAST(row_number() OVER (PARTITION BY scope ORDER BY item) - 1 AS INTEGER) AS i
        FROM (SELECT DISTINCT scope, item FROM items)),
nitems AS (SELECT scope, count(*) AS n FROM idx GROUP BY scope),
bm AS (SELECT it.scope, it.basket, CAST(sum(CAST(1 AS BIGINT) << idx.i) AS BIGINT) AS m
       FROM items it JOIN idx ON it.scope = idx.scope AND it.item = idx.item GROUP BY it.scope, it.basket),
masks AS (SELECT scope, CAST(r.range AS BIGINT) AS s FROM nitems, range(1, CAST(1 AS BIGINT) << n) r(range)),
sup AS (SELECT masks.scope, masks.s, count(bm.m) AS freq FROM masks LEFT JOIN bm ON bm.scope = masks.scope AND (bm.m & masks.s) = masks.s
        GROUP BY masks.scope, masks.s),
freq AS (SELECT sup.* FROM sup JOIN nb ON sup.scope = nb.scope WHERE sup.freq >= CAST(ceil({min_support} * nb.n_baskets) AS BIGINT)),
splits AS (SELECT f.scope, f.s, f.freq, a.s AS a FROM freq f JOIN freq a ON a.scope = f.scope AND (a.s & f.s) = a.s AND a.s <> f.s
           WHERE bit_count(f.s) >= 2),
named AS (SELECT scope, s, string_agg(item, ', ' ORDER BY item) AS items
          FROM (SELECT f.scope, f.s, idx.item FROM freq f JOIN idx ON idx.scope = f.scope AND ((f.s >> idx.i) & 1) = 1)
          GROUP BY scope, s),
r AS (SELECT sp.scope, na.items AS antecedents, nc.items AS consequents,
             CAST(fa.freq AS DOUBLE) / nb.n_baskets AS antecedent_support,
             CAST(fc.freq AS DOUBLE) / nb.n_baskets AS consequent_support,
             CAST(sp.freq AS DOUBLE) / nb.n_baskets AS support,
             (CAST(sp.freq AS DOUBLE) / nb.n_baskets) / (CAST(fa.freq AS DOUBLE) / nb.n_baskets) AS confidence,
             ((CAST(sp.freq AS DOUBLE) / nb.n_baskets) / (CAST(fa.freq AS DOUBLE) / nb.n_baskets)) / (CAST(fc.freq AS DOUBLE) / nb.n_baskets) AS lift
      FROM splits sp JOIN nb ON nb.scope = sp.scope
      JOIN freq fa ON fa.scope = sp.scope AND fa.s = sp.a
      JOIN freq fc ON fc.scope = sp.scope AND fc.s = xor(sp.s, sp.a)
      JOIN named na ON na.scope = sp.scope AND na.s = sp.a
      JOIN named nc ON nc.scope = sp.scope AND nc.s = xor(sp.s, sp.a))
SELECT CASE WHEN scope = -1 THEN NULL ELSE scope END AS territory_id, antecedents, consequents,
       antecedent_support, consequent_support, support, confidence, lift
FROM r WHERE confidence >= {min_conf}"""
