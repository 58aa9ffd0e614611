"""Distributed exact quantiles / ranks against numpy and pandas."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from losslens.operators import ordered as O
from losslens.operators.ordered import average_ranks, feature_ranks, group_quantiles, positions


def _frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))  # one hot key
    v = np.round(rng.lognormal(3, 1, n), 1)  # many ties
    v[rng.random(n) < 0.2] = 7.0  # one hot value
    return pd.DataFrame({"g": g, "v": v, "id": np.arange(n)}), spark.createDataFrame(
        pd.DataFrame({"g": g, "v": v, "id": np.arange(n)}))


@pytest.mark.parametrize("nb", [1, 3, 64])
def test_group_quantiles_match_pandas(spark, nb):
    pdf, df = _frame(spark)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = group_quantiles(df, ["g"], [(f"q{i}", "v", p) for i, p in enumerate(probs)],
                          n_buckets=nb).toPandas().set_index("g").sort_index()
    exp = pdf.groupby("g")["v"].quantile(probs).unstack().sort_index()
    for i, p in enumerate(probs):
        np.testing.assert_allclose(got[f"q{i}"].values, exp[p].values, rtol=1e-12)


def test_global_quantile_and_empty(spark):
    pdf, df = _frame(spark)
    got = group_quantiles(df, [], [("m", "v", 0.5)]).first()["m"]
    assert got == pytest.approx(pdf["v"].median())
    empty = df.where("v < -1")
    assert group_quantiles(empty, [], [("m", "v", 0.5)]).first()["m"] is None


def test_average_ranks_match_pandas(spark):
    pdf, df = _frame(spark, 2000)
    got = average_ranks(df, ["g"], "v").select("id", "rank").toPandas().set_index("id").sort_index()
    exp = pdf.groupby("g")["v"].rank(method="average")
    np.testing.assert_allclose(got["rank"].values, exp.sort_index().values)


def test_positions_all_equal(spark):
    df = spark.createDataFrame([(1.0,)] * 50, "v double")
    p = positions(df, [], "v").first()
    assert p["_c"] == 50 and p["_cum"] == 50 and p["_n"] == 50


def test_feature_ranks_linear(spark):
    pdf, df = _frame(spark, 500)
    pdf["w"] = -pdf["v"]
    df = spark.createDataFrame(pdf)
    got = feature_ranks(df, "id", ["v", "w"]).toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(got["_r_v"].values, pdf["v"].rank().values)
    np.testing.assert_allclose(got["_r_w"].values, pdf["w"].rank().values)


def test_approx_method(spark):
    pdf, df = _frame(spark)
    r = group_quantiles(df, [], [("m", "v", 0.5)], method="approx").first()["m"]
    assert abs(r - pdf["v"].median()) < 2


@pytest.mark.parametrize("in_key", [1 << 17, 16])
def test_column_quantiles_group_only_values_near_them(spark, monkeypatch, in_key):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=20_000), np.round(rng.normal(size=20_000), 1)
    rows = [(float(x), float(y)) for x, y in zip(a, b)] + [(None, float("nan")), (float("nan"), None), (math.inf, -50.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    grouped, counts = [], O.value_counts
    monkeypatch.setattr(O, "IN_KEY", in_key)
    monkeypatch.setattr(O, "value_counts", lambda *x: grouped.append(counts(*x)) or grouped[-1])
    out = O.column_quantiles(df, [("m", "a", 0.5), ("t", "b", 0.5), ("p", "a", 0.9), ("lo", "b", 0.0)]).first()
    a, b = np.append(a, math.inf), np.append(b, -50.0)
    assert out.m == pytest.approx(np.quantile(a, 0.5), abs=1e-12) and out.t == np.quantile(b, 0.5)
    assert out.p == pytest.approx(np.quantile(a, 0.9), abs=1e-12) and out.lo == -50.0
    assert grouped[0].count() < 500  # not 40,000 values


def test_column_quantiles_of_few_or_no_values(spark, monkeypatch):
    df = spark.createDataFrame([(3.0, None), (1.0, None), (2.5, None), (2.5, None)], "a double, b double")
    specs = [("m", "a", 0.5), ("q", "a", 0.1), ("none", "b", 0.5)]
    assert tuple(O.column_quantiles(df, specs).first()) == pytest.approx((2.5, np.quantile([3, 1, 2.5, 2.5], 0.1), None))
    assert tuple(O.column_quantiles(df.where("a > 9"), specs).first()) == (None, None, None)
    wrong = type(df)  # a sketch that brackets the wrong values
    monkeypatch.setattr(wrong, "approxQuantile", lambda self, c, p, e: [[2.9] * len(p), []])
    assert O.column_quantiles(df, specs).first().m == 2.5
