"""Segmentation invariants, model metrics, external operators, streaming."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from losslens.operators import external as EX
from losslens.operators import model as M
from losslens.operators import segment as SG


def _blobs(spark, n=120, seed=5):
    rng = np.random.default_rng(seed)
    c = rng.integers(0, 3, n)
    centers = np.array([[0, 0], [8, 8], [-8, 8]])
    x = centers[c] + rng.normal(size=(n, 2))
    return spark.createDataFrame([(int(i), float(a), float(b), float(k * 10 + 1)) for i, ((a, b), k)
                                  in enumerate(zip(x, c))], "user_id long, f1 double, f2 double, total_profit_erosion double")


def test_standardize_ddof0_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    r = SG.standardize(df, ["a", "b"]).collect()
    assert [x["a"] for x in r] == [-1.0, 1.0] and all(x["b"] == 0.0 for x in r)


def test_kmeans_diagnostics_invariants(spark):
    df = _blobs(spark)
    z = SG.standardize(df, ["f1", "f2"], keep=["user_id", "total_profit_erosion"])
    diag = {r["k"]: r for r in SG.diagnostics_over_k(z, ["f1", "f2"], [1, 2, 3, 4]).collect()}
    assert diag[1]["inertia"] == pytest.approx(2 * 120)  # n x features for z-scores
    assert diag[1]["inertia"] > diag[2]["inertia"] > diag[3]["inertia"]
    assert SG.choose_k_silhouette(SG.diagnostics_over_k(z, ["f1", "f2"], [2, 3, 4])) == 3
    lab = SG.kmeans_fit_predict(z, ["f1", "f2"], 3, order_by="total_profit_erosion")
    s = SG.summarize_clusters(lab).collect()
    assert sum(r["Count"] for r in s) == 120
    assert [r["Mean_Erosion"] for r in s] == sorted(r["Mean_Erosion"] for r in s)  # relabelled


def test_leakage_refused(spark):
    df = _blobs(spark)
    with pytest.raises(ValueError):
        SG.select_numeric_features(df, ["f1", "total_profit_erosion"])
    x, used = SG.select_numeric_features(df, None)
    assert "total_profit_erosion" not in used


def test_exact_auc_and_metrics(spark):
    rows = [(0.9, 1.0), (0.8, 1.0), (0.8, 0.0), (0.1, 0.0), (0.5, 1.0), (0.2, 0.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    exp = np.mean([1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg])
    assert M.exact_auc(df) == pytest.approx(exp)
    perfect = spark.createDataFrame([(float(i), float(i > 4)) for i in range(10)], "score double, label double")
    assert M.exact_auc(perfect) == 1.0
    m = M.classification_metrics(df.withColumn("prediction", (F.col("score") >= 0.5).cast("double")))
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (3, 1, 0, 2)


def test_stratified_split_exact_counts(spark):
    from losslens.operators.reshape import stratified_split
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "id long, y int")
    s = {r["y"]: r for r in stratified_split(df, "y", "id", 0.2).groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_test").alias("t")).collect()}
    assert s[1]["t"] == 10 and s[0]["t"] == 30


def test_external_preprocess_and_label(spark):
    df = spark.createDataFrame(
        [(1, -2.0, -10.0, 5.0, "P", None, "D"), (1, 3.0, 0.0, -7.0, None, "M", "D"), (2, 1.0, 0.0, None, "P", "M", None)],
        "`Bill To Act #` long, `Ordered Qty` double, `CreditReturn Sales` double, total_loss double, "
        "Pillar string, `Major Market Cat` string, Department string")
    p = EX.preprocess(df).collect()
    assert len(p) == 2 and [r["Returns"] for r in p] == [True, False] and p[1]["total_loss"] == 7.0
    base = EX.canonical_base(EX.preprocess(df)).collect()
    assert base[0]["category"] == "P-Unknown-D"
    acc = spark.createDataFrame([(i, float(i)) for i in range(1, 9)], "account_id long, total_loss double")
    t = EX.targets(acc).collect()
    assert sum(r["is_high_erosion_customer"] for r in t) == 2  # >= P75 (6.25): 7, 8


def test_streaming_monthly_matches_batch(spark):
    from losslens.streaming.monthly import monthly_return_rate_stream
    s = {str(r["month"])[:7]: r["items"] for r in monthly_return_rate_stream(spark, "/root/testdata/sf0.001").collect()}
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    b = {str(r["m"])[:7]: r["n"] for r in li.join(o, li.l_orderkey == o.o_orderkey).groupBy(
        F.date_trunc("month", "o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert s == b
