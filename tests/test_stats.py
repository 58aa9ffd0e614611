"""Tests and distribution tails against closed forms / numpy."""
import math

import numpy as np
import pytest

from losslens.functions import dist
from losslens.operators import stats as S


def _groups(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = [("a", float(x)) for x in rng.normal(10, 2, 40)] + \
           [("b", float(x)) for x in rng.normal(12, 2, 30)] + [("c", float(x)) for x in np.round(rng.lognormal(2, 1, 25))]
    return rows, spark.createDataFrame(rows, "g string, x double")


def test_anova_matches_numpy(spark):
    rows, df = _groups(spark)
    r = S.anova(df, "g", "x")
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    allv = np.concatenate([np.array(v) for v in groups.values()])
    m = allv.mean()
    ssb = sum(len(v) * (np.mean(v) - m) ** 2 for v in groups.values())
    ssw = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in groups.values())
    f = (ssb / 2) / (ssw / (len(allv) - 3))
    assert r["f_stat"] == pytest.approx(f) and r["eta_squared"] == pytest.approx(ssb / (ssb + ssw))
    assert r["p_value"] == pytest.approx(dist.f_sf(f, 2, len(allv) - 3))


def test_kruskal_matches_formula(spark):
    import pandas as pd
    rows, df = _groups(spark)
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    pdf["r"] = pdf["x"].rank()
    n = len(pdf)
    h = 12 / (n * (n + 1)) * sum(gr["r"].sum() ** 2 / len(gr) for _, gr in pdf.groupby("g")) - 3 * (n + 1)
    t = pdf["x"].value_counts()
    h /= 1 - ((t ** 3 - t).sum() / (n ** 3 - n))
    r = S.kruskal(df, "g", "x")
    assert r["h_stat"] == pytest.approx(h) and r["epsilon_squared"] == pytest.approx((h - 2) / (n - 3))


def test_distribution_tails():
    assert dist.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-6)
    assert dist.t_sf2(2.2281388519649385, 10) == pytest.approx(0.05, rel=1e-6)
    assert dist.f_sf(4.9646027437307145, 1, 10) == pytest.approx(0.05, rel=1e-6)
    assert dist.norm_ppf(0.975) == pytest.approx(1.959963984540054, rel=1e-9)
    assert dist.tukey_sf(3.877, 3, 10) == pytest.approx(0.05, abs=2e-3)


def test_run_factor_branches(spark):
    one = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0)], "category string, profit_erosion double")
    rec, post = S.run_factor(one, "category")
    r = rec.first()
    assert r["test_used"] == "n/a" and post is None
    _, df = _groups(spark)
    rec, post = S.run_factor(df.withColumnRenamed("g", "category").withColumnRenamed("x", "profit_erosion"),
                             "category")
    r = rec.first()
    assert r["test_used"] in ("anova", "kruskal") and r["n_groups"] == 3 and post.count() in (3, 9)


def test_dunn_symmetric_with_unit_diagonal(spark):
    _, df = _groups(spark)
    d = {(r["group_a"], r["group_b"]): r["p_adj"] for r in S.dunn(df, "g", "x").collect()}
    assert d[("a", "a")] == 1.0 and d[("a", "b")] == pytest.approx(d[("b", "a")])
    assert all(0 <= v <= 1 for v in d.values())


def test_spearman_perfect(spark):
    df = spark.createDataFrame([(i, float(i), float(i ** 3)) for i in range(30)], "id int, x double, y double")
    r = S.spearman(df, "x", "y", "id").first()
    assert r["spearman"] == pytest.approx(1.0) and r["pearson"] < 1.0


def test_bootstrap_ci_contains_mean(spark):
    _, df = _groups(spark)
    df = df.withColumn("id", __import__("pyspark.sql.functions", fromlist=["x"]).monotonically_increasing_id())
    r = {x["g"]: x for x in S.bootstrap_mean_ci(df, "g", "x", "id", n_boot=200, min_n=20).collect()}
    for g in ("a", "b"):
        assert r[g]["ci_lower"] < r[g]["mean"] < r[g]["ci_upper"]


def test_bootstrap_is_its_weights(spark, monkeypatch):
    """Intervals from the weights written out; large groups in parts, rows in any order."""
    rng = np.random.default_rng(4)
    rows = [(int(i), f"g{i % 3}" if i % 50 else "few", float(rng.exponential())) for i in range(1200)]
    rows += [(5000, None, 1.0), (5001, "g1", None)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    got = {r.g: r for r in S.bootstrap_mean_ci(df, "g", "x", "id", n_boot=60, min_n=30).collect()}
    assert set(got) == {"g0", "g1", "g2"}
    for g, r in got.items():
        ids, x = (np.array(v) for v in zip(*[(i, v) for i, k, v in rows if k == g and v is not None]))
        w = S.poisson_weights(ids, 60, 42)
        mean = (w * x[:, None]).sum(0) / w.sum(0)
        assert r.n == len(x) and r["mean"] == pytest.approx(x.mean())
        assert (r.ci_lower, r.ci_upper) == pytest.approx(tuple(np.quantile(mean, [.025, .975])))
    monkeypatch.setattr(S, "ROWS_A_CELL", 50)
    again = {r.g: r for r in S.bootstrap_mean_ci(df.repartition(6), "g", "x", "id", n_boot=60, min_n=30).collect()}
    for g, r in got.items():
        assert again[g].ci_lower == pytest.approx(r.ci_lower) and again[g].ci_upper == pytest.approx(r.ci_upper)


def test_bootstrap_of_many_groups(spark):
    df = spark.range(20_000).selectExpr("id", "concat('g', id % 5000) AS g", "cast(id % 17 AS double) AS x")
    out = S.bootstrap_mean_ci(df, "g", "x", "id", n_boot=20, min_n=4)
    assert out.count() == 5000 and out.where("ci_lower <= mean AND mean <= ci_upper").count() > 3500
