"""OLS / HC3 / VIF / diagnostics against direct numpy formulas."""
import math

import numpy as np
import pytest

from losslens.operators import ols as O


def _fixture(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    y = 10 * x[:, 0] + 5 * x[:, 1] - 3 * x[:, 2] + rng.normal(size=n) * (1 + np.abs(x[:, 3]))
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, y double, " + ", ".join(f"feature_{j} double" for j in range(5)))
    return df, x, y


def test_hc3_matches_numpy(spark):
    df, x, y = _fixture(spark)
    names = ["const"] + [f"feature_{j}" for j in range(5)]
    design = df.select("id", "y", __import__("pyspark.sql.functions", fromlist=["x"]).lit(1.0).alias("const"),
                       *[f"feature_{j}" for j in range(5)])
    fit = O.fit_ols_hc3(design, names)
    X = np.column_stack([np.ones(len(y)), x])
    inv = np.linalg.inv(X.T @ X)
    b = inv @ X.T @ y
    e = y - X @ b
    h = np.einsum("ij,jk,ik->i", X, inv, X)
    V = inv @ (X.T * (e ** 2 / (1 - h) ** 2)) @ X @ inv
    np.testing.assert_allclose([fit["params"][c] for c in names], b, rtol=1e-9)
    np.testing.assert_allclose([fit["bse"][c] for c in names], np.sqrt(np.diag(V)), rtol=1e-7)
    r2 = 1 - (e @ e) / ((y - y.mean()) @ (y - y.mean()))
    assert fit["r_squared"] == pytest.approx(r2)
    n, k = X.shape
    llf = -n / 2 * (math.log(2 * math.pi) + math.log(e @ e / n) + 1)
    assert fit["aic"] == pytest.approx(-2 * llf + 2 * k)
    s = (e - e.mean())
    skew = (s ** 3).mean() / (s ** 2).mean() ** 1.5
    kurt = (s ** 4).mean() / (s ** 2).mean() ** 2
    assert fit["jarque_bera"]["statistic"] == pytest.approx(n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4))
    z = e ** 2
    bz = np.linalg.lstsq(X, z, rcond=None)[0]
    r2a = 1 - ((z - X @ bz) @ (z - X @ bz)) / ((z - z.mean()) @ (z - z.mean()))
    assert fit["breusch_pagan"]["statistic"] == pytest.approx(n * r2a)
    dw = O.durbin_watson(design, fit, "id")
    assert dw == pytest.approx(np.sum(np.diff(e) ** 2) / np.sum(e ** 2))
    vif = dict(O.vif_table(fit))
    Xn = x
    for j in range(5):
        others = np.delete(Xn, j, axis=1)
        bj = np.linalg.lstsq(others, Xn[:, j], rcond=None)[0]
        r = Xn[:, j] - others @ bj
        r2u = 1 - (r @ r) / (Xn[:, j] @ Xn[:, j])  # uncentered: no constant (reference behaviour)
        assert vif[f"feature_{j}"] == pytest.approx(1 / (1 - r2u), rel=1e-6)


def test_prepare_drops_constant_and_dummies(spark):
    rows = [(float(i + 1), float(i % 7), 1.0, ["b", "a", "c"][i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "total_profit_erosion double, x double, k double, cat string")
    d, names, dropped = O.prepare_regression_data(df, "total_profit_erosion", ["x", "k"], ["cat"], True, None)
    assert dropped == ["k"] and names == ["const", "x", "cat_b", "cat_c"]
    r = d.agg({"x": "avg"}).first()[0]
    assert abs(r) < 1e-12


def test_many_levels_are_sparse(spark):
    """1,000 levels: the sparse design's fit is that of the same matrix in numpy; few levels agree with the wide design."""
    rng = np.random.default_rng(8)
    n, levels = 6000, 1000
    g = np.concatenate([np.arange(levels), np.arange(levels), rng.integers(0, levels, n - 2 * levels)])  # two rows a level
    h = rng.integers(0, 3, n)
    x = rng.normal(size=n)
    y = 2 * x + (g % 7) * .5 + h + rng.normal(size=n)
    df = spark.createDataFrame([(i, float(y[i]), float(x[i]), f"l{g[i]:04}", f"h{h[i]}") for i in range(n)],
                               "user_id long, t double, x double, g string, h string").repartition(5)
    design, names, dropped = O.sparse_regression_data(df, "t", ["x"], ["g", "h"], log_transform=False)
    assert len(names) == 2 + 999 + 2 and names[2] == "g_l0001" and names[-1] == "h_h2" and not dropped
    fit = O.fit_ols_hc3(design, names)
    z = (x - x.mean()) / x.std(ddof=1)
    X = np.column_stack([np.ones(n), z, (g[:, None] == np.arange(1, levels)).astype(float),
                         (h[:, None] == np.arange(1, 3)).astype(float)])
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    np.testing.assert_allclose([fit["params"][c] for c in names], b, rtol=1e-6, atol=1e-8)
    inv = np.linalg.inv(X.T @ X)
    e = y - X @ b
    lev = ((X @ inv) * X).sum(1)
    V = inv @ (X.T * (e**2 / (1 - lev) ** 2)) @ X @ inv
    assert np.isfinite(V).all()
    np.testing.assert_allclose([fit["bse"][c] for c in names], np.sqrt(np.diag(V)), rtol=1e-5)
    assert O.durbin_watson(design, fit, "user_id") == pytest.approx((np.diff(e) ** 2).sum() / (e * e).sum())
    few, few_names, _ = O.sparse_regression_data(df, "t", ["x"], ["h"], log_transform=False)
    wide, wide_names, _ = O.prepare_regression_data(df, "t", ["x"], ["h"], log_transform=False)
    a, c = O.fit_ols_hc3(few, few_names), O.fit_ols_hc3(wide, wide_names)
    assert few_names == wide_names
    for name in few_names:
        assert a["params"][name] == pytest.approx(c["params"][name]) and a["bse"][name] == pytest.approx(c["bse"][name])


def test_too_many_levels_raise(spark, monkeypatch):
    monkeypatch.setattr(O, "MAX_COLUMNS", 5)
    df = spark.createDataFrame([(float(i), f"l{i}") for i in range(9)], "t double, g string")
    with pytest.raises(ValueError, match="at most 5"):
        O.sparse_regression_data(df, "t", [], ["g"], False, None)


def test_durbin_watson_of_string_ids(spark):
    rng = np.random.default_rng(1)
    e = rng.normal(size=500)
    df = spark.createDataFrame([(f"id{i:05}", float(e[i]), 1.0) for i in rng.permutation(500)] + [(None, 9.0, 1.0)],
                               "id string, y double, const double")
    from pyspark.sql import functions as F
    got = O.durbin_watson(df, {"residual_expr": F.col("y")}, "id")
    assert got == pytest.approx((np.diff(e) ** 2).sum() / (e * e).sum())
