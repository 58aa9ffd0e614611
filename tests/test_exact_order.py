"""Typed order keys, exact sample counts, raw sources, deep clean."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from losslens.operators import concentration as C
from losslens.operators import ols as O
from losslens.operators import quality as QL
from losslens.operators import reshape as R
from losslens.sources import raw


def test_pareto_ids_above_2_53(spark):
    ids = [2**53, 2**53 + 1, 2**53 + 2, 2**53 + 3]
    df = spark.createDataFrame([(i, 5.0) for i in ids], "user_id long, v double")
    out = {r.user_id: (r["rank"], r.cum_value) for r in C.pareto_table(df, "v").collect()}
    assert out == {i: (k, 5.0 * k) for k, i in enumerate(ids, 1)}


def test_pareto_string_and_repeated_ids(spark):
    df = spark.createDataFrame([("user_b", 1.0), ("user_a", 1.0), ("user_a", 1.0), ("user_c", 2.0)], "user_id string, v double")
    rows = sorted((r["rank"], r.user_id) for r in C.pareto_table(df, "v").collect())
    assert rows == [(1, "user_c"), (2, "user_a"), (3, "user_a"), (4, "user_b")]


def test_sample_keeps_m_rows_with_repeated_ids(spark):
    df = spark.createDataFrame([("g", 7)] * 5 + [("h", i) for i in range(10)] + [(None, 1)], "grp string, id long")
    n = {r.grp: r.n for r in R.sample_per_group(df, "grp", "id", 3).groupBy("grp").agg(F.count("*").alias("n")).collect()}
    assert n == {"g": 3, "h": 3, None: 1}


def test_split_counts_are_exact(spark):
    df = spark.createDataFrame([(2**53 + i, i % 3) for i in range(999)], "id long, y int")
    out = R.stratified_split(df, "y", "id").groupBy("y").agg(F.sum("is_test").alias("t")).collect()
    assert {r.y: r.t for r in out} == {0: 67, 1: 67, 2: 67}
    folds = R.fold_column(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    assert all(r["count"] in (66, 67) for r in folds) and len(folds) == 15


def test_durbin_watson_on_string_ids(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=60), rng.normal(size=60)
    rows = [(f"customer-{i:05d}", 1.0, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "user_id string, const double, x double, y double")
    fit = O.fit_ols_hc3(df, ["const", "x"])
    e = y - np.column_stack([np.ones(60), x]) @ np.linalg.lstsq(np.column_stack([np.ones(60), x]), y, rcond=None)[0]
    assert O.durbin_watson(df, fit, "user_id") == pytest.approx((np.diff(e) ** 2).sum() / (e**2).sum())


def test_columns_and_types(spark):
    df = spark.createDataFrame([(1, "2.5", "x", "2024-01-02 03:04:05", "bad")],
                               "user_id long, sale_price string, sku string, order_created_at string, cost string")
    out = raw.standardize_types(df)
    assert dict(out.dtypes) == {"user_id": "string", "sale_price": "double", "sku": "string",
                                "order_created_at": "timestamp", "cost": "double"}
    assert out.first().cost is None and out.first().sale_price == 2.5
    kept, report = raw.select_columns(df, drop=["sku"], keep=["cost", "zz"])
    assert kept.columns == ["cost"]
    assert {(r.column, r.status) for r in report.collect()} >= {("cost", "kept"), ("sku", "dropped"), ("zz", "missing")}
    assert raw.select_columns(df, drop=["sku", "zz"])[0].columns == ["user_id", "sale_price", "order_created_at", "cost"]


def test_deep_clean_keeps_equal_items_with_other_ids(spark):
    rows = [("a", 1.0, 2.0, 1), ("b", 1.0, 2.0, 1), ("b", 1.0, 2.0, 1), ("c", 9.0, 2.0, 1), ("d", 8.0, 2.0, 1)]
    df = spark.createDataFrame(rows, "order_item_id string, sale_price double, cost double, flat int")
    out, report = QL.deep_clean(df, variance_threshold=0.01, price_action="remove", status_action=None)
    assert sorted(r.order_item_id for r in out.collect()) == ["c", "d"] and "flat" not in out.columns
    metrics = {(r.step, r.metric): r.value for r in report.collect()}
    assert metrics["duplicates", "rows_removed"] == 1 and metrics["price", "cost_exceeds_sale"] == 2
