"""Shapiro-Wilk, pair tests and the Euclidean silhouette against plain versions."""
import math
from statistics import NormalDist

import numpy as np
import pytest

from losslens.functions import dist
from losslens.operators import segment as SG
from losslens.operators import stats as S


def plain_shapiro(x):
    """Royston's algorithm on a sorted list, with the weights written out."""
    x, n = sorted(x), len(x)
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    mm, u = sum(v * v for v in m), 1 / math.sqrt(n)
    a = [0.0] * n
    a[-1] = S._poly(S._LAST, u) + m[-1] / math.sqrt(mm)
    if n > 5:
        a[-2] = S._poly(S._LAST_BUT_ONE, u) + m[-2] / math.sqrt(mm)
        scale = math.sqrt((mm - 2 * m[-1]**2 - 2 * m[-2]**2) / (1 - 2 * a[-1]**2 - 2 * a[-2]**2))
        inner = range(2, n - 2)
        a[1] = -a[-2]
    else:
        scale = math.sqrt((mm - 2 * m[-1]**2) / (1 - 2 * a[-1]**2))
        inner = range(1, n - 1)
    a[0] = -a[-1]
    for i in inner:
        a[i] = m[i] / scale
    mean = sum(x) / n
    return sum(v * w for v, w in zip(a, x))**2 / sum((v - mean)**2 for v in x)


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(6)
    return {"normal": rng.normal(size=300), "skewed": rng.exponential(size=200), "ties": rng.integers(0, 4, 500) * 1.0,
            "mostly one": np.append(np.zeros(9000), rng.normal(size=50)), "five": rng.normal(size=5), "four": rng.normal(size=4),
            "eleven": rng.normal(size=11), "weights": [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]}


def test_shapiro_wilk(spark, samples):
    rows = [(g, float(v)) for g, x in samples.items() for v in x] + [("two", 1.0), ("two", 2.0), ("one value", 3.0)]
    rows += [("one value", 3.0)] * 5 + [("three", 1.0), ("three", 2.0), ("three", 4.0), ("three", None), (None, 1.0)]
    got = {r.g: r for r in S.shapiro_wilk(spark.createDataFrame(rows, "g string, x double"), "g", "x").collect()}
    for g, x in samples.items():
        assert got[g].w == pytest.approx(plain_shapiro(list(map(float, x))), rel=1e-9), g
        assert got[g].n == len(x)
    # published figures of the eleven weights
    assert got["weights"].w == pytest.approx(0.79, abs=5e-3) and got["weights"].p_value == pytest.approx(0.0067, abs=2e-4)
    assert got["normal"].normal and not got["skewed"].normal and not got["ties"].normal and not got["mostly one"].normal
    assert got["three"].n == 3 and got["three"].w == pytest.approx((4 - 1)**2 / 2 / (14 / 3))
    assert not got["two"].normal and got["two"].p_value is None and got["one value"].p_value is None
    assert set(got) == {*samples, "two", "one value", "three"}


def test_shapiro_wilk_of_normal_samples_rejects_rarely(spark):
    rng = np.random.default_rng(9)
    rows = [(g, float(v)) for g in range(300) for v in rng.normal(size=8 + g % 60)]
    out = S.shapiro_wilk(spark.createDataFrame(rows, "g long, x double"), "g", "x").collect()
    assert len(out) == 300 and 3 <= sum(not r.normal for r in out) <= 30


def test_factor_takes_anova_for_normal_groups(spark):
    rng = np.random.default_rng(12)
    normal = [(f"g{k}", float(v)) for k in range(3) for v in rng.normal(k, 1, 60)]
    summary, post = S.run_factor(spark.createDataFrame(normal, "g string, profit_erosion double"), "g")
    assert summary.first().test_used == "anova" and post.count() == 3
    many = [(f"g{k:02}", float(v)) for k in range(15) for v in rng.exponential(1 + k, 30)]
    summary, post = S.run_factor(spark.createDataFrame(many, "g string, profit_erosion double"), "g")
    assert summary.first().test_used == "kruskal" and post.count() == 225  # all groups, not the 12 largest
    _, post = S.run_factor(spark.createDataFrame(many, "g string, profit_erosion double"), "g", max_groups_posthoc=4)
    assert post.count() == 16


def test_tukey_tail_in_blocks():
    q = np.array([0.0, 0.3, 1.0, 2.5, 3.6, 6.0, 15.0, math.nan])
    for k, df in ((3, 10), (8, 177), (40, 900), (5, 10_000)):
        many = dist.tukey_sf_many(q, k, df)
        assert math.isnan(many[-1])
        for x, p in zip(q[:-1], many):
            assert p == pytest.approx(dist.tukey_sf(float(x), k, df), abs=1e-7)


def test_pairs_have_a_bound(spark, monkeypatch):
    monkeypatch.setattr(S, "MAX_GROUPS", 3)
    df = spark.createDataFrame([(f"g{i % 4}", float(i)) for i in range(40)], "g string, x double")
    for test in (S.tukey_hsd, S.dunn):
        with pytest.raises(ValueError, match="too many pairs"):
            test(df, "g", "x")


def plain_silhouette(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][label == c].mean() for c in set(label.tolist()) - {label[i]})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(out)


@pytest.mark.parametrize("block", [17, 2048])
def test_silhouettes(spark, block):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(60, 3)), rng.normal(4, 1, (50, 3)), np.zeros((10, 3))])
    labels = {"two": (x[:, 0] > 2).astype(int), "four": rng.integers(0, 4, len(x)), "lone": np.arange(len(x)) // 119}
    rows = [(i, *map(float, x[i]), *(int(v[i]) for v in labels.values())) for i in range(len(x))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, two int, four int, lone int")
    got = SG.silhouettes(df, ["a", "b", "c"], {"two": 2, "four": 4, "lone": 2}, "id", block)
    for name, v in labels.items():
        assert got[name] == pytest.approx(plain_silhouette(x, v)), name
    assert math.isnan(SG.silhouettes(df.withColumn("one", df["two"] * 0), ["a"], {"one": 1}, "id")["one"])


def test_diagnostics_use_the_euclidean_silhouette(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(40, 2)), rng.normal(5, 1, (40, 2))])
    z = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    diag = {r.k: r for r in SG.diagnostics_over_k(z, ["a", "b"], [1, 2, 3], id_col="id").collect()}
    assert diag[1].silhouette is None and diag[2].silhouette > diag[3].silhouette
    model, out = SG.kmeans_fit(z, ["a", "b"], 2, 42)
    rows = out.select("a", "b", "cluster_id").collect()
    want = plain_silhouette(np.array([[r.a, r.b] for r in rows]), np.array([r.cluster_id for r in rows]))
    assert diag[2].silhouette == pytest.approx(want)
    few = SG.diagnostics_over_k(z, ["a", "b"], [2], id_col="id", silhouette_rows=30).first()
    assert few.silhouette == pytest.approx(diag[2].silhouette, abs=.1)
