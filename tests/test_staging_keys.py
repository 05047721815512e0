import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.functions.keys import date_from_key, date_key, length_prefixed_key, surrogate_key
from starmart.operators.calendar import date_dim
from starmart.operators.keys import assign_keys, with_unknown_member
from starmart.operators.staging import select_except, stage_order_detail, stage_order_header


def test_order_detail_abs_then_positive(spark):
    df = spark.createDataFrame(
        [(1, 10, dt.datetime(2001, 1, 1), 2.0, 1.0, -5.0), (2, 10, dt.datetime(2001, 1, 1), 1.0, 1.0, 0.0),
         (3, 10, dt.datetime(2001, 1, 1), 1.0, 1.0, None), (4, 10, dt.datetime(2001, 1, 1), -2.5, -1.0, 3.0)],
        "SalesOrderID long, ProductID long, ModifiedDate timestamp_ntz, OrderQty double, UnitPrice double, LineTotal double")
    out = {r.SalesOrderID: r for r in stage_order_detail(df).collect()}
    assert set(out) == {1, 4}
    assert out[1].LineTotal == 5.0 and out[4].UnitPrice == 1.0
    assert out[4].OrderQty == 3  # half away from zero, then ABS


def test_order_header_unknown_territory(spark):
    df = spark.createDataFrame([(1, None, True), (2, 0, False), (3, 4, True)],
                               "SalesOrderID long, TerritoryID long, OnlineOrderFlag boolean")
    df = df.withColumn("OrderDate", F.lit("2001-01-01").cast("timestamp_ntz"))
    rows = sorted((r.SalesOrderID, r.TerritoryID, r.OnlineOrderFlag) for r in stage_order_header(df).collect())
    assert rows == [(1, 0, 1), (2, 0, 0), (3, 4, 1)]


def test_select_except_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, B int, c int")
    assert select_except(df, ["b"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        select_except(df, ["zz"])


def test_surrogate_key_null_and_separator(spark):
    df = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), (None, "c")], "x string, y string")
    rows = df.select(surrogate_key(df, ["x", "y"]).alias("k"), length_prefixed_key(df, ["x", "y"]).alias("l")).collect()
    assert rows[0].k == rows[1].k          # documented collision of the '-' join
    assert rows[0].l != rows[1].l          # the length-prefixed form separates them
    import hashlib
    assert rows[2].k == hashlib.md5(b"_dbt_utils_surrogate_key_null_-c").hexdigest()


def test_surrogate_key_formats_doubles(spark):
    df = spark.createDataFrame([(1e7,)], "v double")
    import hashlib
    assert df.select(surrogate_key(df, ["v"])).first()[0] == hashlib.md5(b"10000000.000000").hexdigest()


def test_date_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 13, 5),)], "t timestamp_ntz")
    assert df.select(date_key("t")).first()[0] == 20240229
    k = spark.createDataFrame([(20240229,), (20251332,)], "k long")
    got = [r[0] for r in k.select(date_from_key("k")).collect()]
    assert got == [dt.date(2024, 2, 29), None]


def test_date_dim_weeks_and_size(spark):
    d = date_dim(spark)
    assert d.count() == 22279
    rows = {r.Date: r for r in d.filter(F.col("Date").isin(dt.date(2022, 1, 1), dt.date(2023, 1, 1), dt.date(2024, 2, 29))).collect()}
    assert rows[dt.date(2022, 1, 1)].Week == 0      # Saturday before the first Sunday
    assert rows[dt.date(2023, 1, 1)].Week == 1      # a Sunday starts week 1
    assert rows[dt.date(2024, 2, 29)].DateKey == 20240229 and rows[dt.date(2024, 2, 29)].Season == "Winter"


def test_assign_keys_stable_for_new_ids(spark):
    dim = spark.createDataFrame([(5, "e"), (9, "i")], "TerritoryID long, Name string")
    first = assign_keys(dim, ["TerritoryID"], "TerritoryKey")
    assert sorted((r.TerritoryID, r.TerritoryKey) for r in first.collect()) == [(5, 1), (9, 2)]
    grown = spark.createDataFrame([(2, "b"), (5, "e"), (9, "i")], "TerritoryID long, Name string")
    again = assign_keys(grown, ["TerritoryID"], "TerritoryKey", existing=first)
    assert sorted((r.TerritoryID, r.TerritoryKey) for r in again.collect()) == [(2, 3), (5, 1), (9, 2)]
    withu = with_unknown_member(first, {"TerritoryKey": 0, "TerritoryID": 0, "Name": "unknown"})
    assert withu.filter("TerritoryKey = 0").first().Name == "unknown"


def test_date_dim_covers_data_dates(spark):
    dates = spark.createDataFrame([(dt.datetime(1985, 6, 1),), (dt.datetime(2001, 1, 1),)], "d timestamp_ntz")
    d = date_dim(spark, cover=dates, cover_column="d")
    assert d.agg(F.min("Date")).first()[0] == dt.date(1985, 6, 1)
    assert d.agg(F.max("Date")).first()[0] == dt.date(2050, 12, 30)


def test_cluster_settings_sizes_partitions():
    from starmart.session import cluster_settings

    conf = cluster_settings(100 * 2**40, 8000)           # 100 TiB over 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_settings(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 128
