"""Driver contract: entry runs, every oracle key is a query key."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "total_profit_erosion" in df.columns


def test_oracle_keys_subset():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def test_some_queries_run_at_sf0001(spark):
    q = E.queries()
    for name in ["a12_customer_rfm_features", "w3_pareto_table", "t4_kruskal_erosion_by_category"]:
        assert q[name](spark, "/root/testdata/sf0.001").count() > 0
