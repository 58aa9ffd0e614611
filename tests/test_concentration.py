"""Gini / Pareto / Lorenz / top share properties (reference-style fixtures)."""
import numpy as np
import pytest

from losslens.operators import concentration as C


def _cust(spark, vals):
    return spark.createDataFrame([(f"u{i}", float(v)) for i, v in enumerate(vals)],
                                 "user_id string, total_profit_erosion double")


def _np_gini(x):
    x = np.sort(np.asarray(x, float))
    if (x < 0).any():
        x = x - x.min()
    n = len(x)
    return 0.0 if x.sum() == 0 else float(np.sum((2 * np.arange(1, n + 1) - n - 1) * x) / (n * x.sum()))


@pytest.mark.parametrize("vals", [[80, 10, 5, 5], [1, 1, 1, 1], [-3, 2, 2, 9, 0], [5], [3, 3, 7, 7, 7, 1]])
def test_gini_matches_numpy(spark, vals):
    g = C.gini(_cust(spark, vals), "total_profit_erosion").first()["gini"]
    assert g == pytest.approx(_np_gini(vals), abs=1e-12)


def test_gini_empty_is_zero(spark):
    assert C.gini(_cust(spark, [1]).where("1=0"), "total_profit_erosion").first()["gini"] == 0.0


def test_pareto_and_lorenz(spark):
    df = _cust(spark, [80, 10, 5, 5])
    p = C.pareto_table(df).orderBy("rank").collect()
    assert [r["rank"] for r in p] == [1, 2, 3, 4]
    assert p[0]["value_share"] == pytest.approx(0.8) and p[-1]["value_share"] == pytest.approx(1.0)
    assert all(r["concentration_category"] == "Useful Many" for r in p)  # 1/4 > 20%
    assert {r["user_id"] for r in p[2:]} == {"u2", "u3"}  # string ids: hashed tie order
    lz = sorted((r["population_share"], r["value_share"]) for r in C.lorenz_points(df).collect())
    assert len(lz) == 5 and lz[0] == (0.0, 0.0) and lz[-1][1] == pytest.approx(1.0)
    assert lz[1][1] == pytest.approx(0.05)


def test_top_share(spark):
    df = _cust(spark, [80, 10, 5, 5])
    assert C.top_share(df, "total_profit_erosion", 0.25).first()["top_share"] == pytest.approx(0.8)
    assert C.top_share(df, "total_profit_erosion", 0.2).first()["top_share"] == pytest.approx(0.8)
    with pytest.raises(ValueError):
        C.top_share(df, "total_profit_erosion", 0.0)


def test_targets(spark):
    vals = [10, 20, 30, 40, 50, 60, 70, 80]
    t = {r["user_id"]: r for r in C.create_profit_erosion_targets(_cust(spark, vals)).collect()}
    assert sum(r["is_high_erosion_customer"] for r in t.values()) == 2  # > P75 = 62.5
    assert t["u0"]["profit_erosion_quartile"] == 1 and t["u7"]["profit_erosion_quartile"] == 4
    assert t["u7"]["erosion_percentile_rank"] == pytest.approx(100.0)


def test_quartile_duplicate_edges(spark):
    t = C.create_profit_erosion_targets(_cust(spark, [0, 0, 0, 0, 0, 0, 5, 9])).collect()
    assert sorted({r["profit_erosion_quartile"] for r in t}) == [1, 2]


def test_price_tier_collapsed_edges_raise(spark):
    df = spark.createDataFrame([(1.0,)] * 10, "sale_price double")
    with pytest.raises(ValueError):
        C.price_tier(df)
