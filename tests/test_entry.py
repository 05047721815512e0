import __spark_entry__ as E
from starmart.plans import registry


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"SalesOrderID", "ProductKey", "TerritoryKey", "OrderDateKey", "LoadDatetime"}
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(registry.QUERIES) == set(registry.ORACLE) <= set(sql)


def test_some_queries_run_on_smoke_data(spark):
    qs = E.queries()
    for name in ("stg_territory", "dim_territory", "mining_scopes", "scd2_from_history", "pit_join_fact_dim"):
        assert qs[name](spark, E.SMOKE_DIR).count() >= 0
