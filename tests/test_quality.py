"""Data-quality operators."""
import pytest

from losslens.operators import quality as QL


def test_duplicates_report_and_remove(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")],
                               "k int, v string")
    out, rep = QL.detect_duplicates(df, action="remove")
    r = rep.first()
    assert r["total_duplicates_found"] == 5 and r["unique_duplicate_groups"] == 2 and r["rows_removed"] == 3
    assert out.count() == 3
    flagged, _ = QL.detect_duplicates(df, action="flag")
    assert sorted(x["is_duplicate"] for x in flagged.collect()) == [0, 1, 1, 1, 1, 1]


def test_missing_and_fills(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "x"), (3.0, None), (5.0, "y")], "a double, s string")
    rep = {r["column"]: r for r in QL.missing_report(df).collect()}
    assert rep["a"]["missing_count"] == 1 and rep["a"]["missing_pct"] == 25.0
    filled = QL.fill_numeric_median(df, ["a"]).collect()
    assert filled[1]["a"] == 3.0
    modes = QL.fill_categorical_mode(df, ["s"]).collect()
    assert modes[2]["s"] == "x"


def test_iqr_flags(spark):
    df = spark.createDataFrame([(float(x), 1.0) for x in [1, 2, 3, 4, 5, 100]], "p double, q double")
    out, rep = QL.detect_outliers_iqr(df, ["p", "q"])
    r = rep.first()
    assert r["total_outlier_rows"] == 1 and r["p"] == 1
    row = [x for x in out.collect() if x["is_outlier"] == 1][0]
    assert row["outlier_columns"] == "p" and row["outlier_values"] == "p=100.0"


def test_rules(spark):
    df = spark.createDataFrame([(10.0, 12.0, 11.0), (-1.0, 5.0, None)], "sale_price double, retail_price double, cost double")
    _, rep = QL.validate_price_consistency(df)
    r = rep.first()
    assert r["total_inconsistent_rows"] == 2 and r["cost_exceeds_sale"] == 1 and r["negative_price"] == 1


def test_feature_quality_bias_corrected(spark):
    import pandas as pd
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    r = QL.feature_quality_stats(df, ["a"]).first()
    s = pd.Series(vals)
    assert r["skewness"] == pytest.approx(s.skew()) and r["kurtosis"] == pytest.approx(s.kurt())
