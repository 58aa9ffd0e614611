"""Shared-pass forests and boosted trees against recursion over the same bins, and against separate fits."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from losslens.operators import trees as T

FEATURES = [f"f{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 400
    x = np.round(rng.normal(size=(n, 5)), 2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * .5 > .4).astype(int)
    z = (x[:, 3] > .8).astype(int)
    part = rng.integers(-1, 3, n)
    rows = [(int(i), *map(float, x[i]), [int(y[i]), int(z[i])], [int(part[i]), int((part[i] + 2) % 4) - 1]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{f} double" for f in FEATURES)
                               + ", labels array<int>, parts array<int>")
    edges = T.bin_edges(df, FEATURES, 16)
    return T.bin_rows(df.repartition(3), "id", FEATURES, edges).persist()


def as_numpy(rows):
    r = rows.orderBy("id").collect()
    return (np.array([list(x.bins) for x in r]), np.array([x.labels for x in r]), np.array([x.parts for x in r]),
            np.array([x.row_key for x in r]), [x.id for x in r])


def test_bins_follow_the_cuts(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.5), (4, None)], "id long, x double").withColumn(
        "labels", F.array(F.lit(0))).withColumn("parts", F.array(F.lit(0)))
    rows = T.bin_rows(df, "id", ["x"], [np.array([1.0, 2.0])])
    assert {r.id: list(r.bins) for r in rows.collect()} == {1: [0], 2: [1], 3: [2], 4: [T.NULL_BIN]}


def recursive_tree(fit, number, x, y, w, drawn, seed):
    """Chance of label 1 for every row of x, by recursion."""
    chance = np.zeros(len(x))
    path0 = T._mix(T._mix(np.array([seed], np.uint64)) ^ np.array([number], np.uint64))[0]

    def grow(rows, path, depth):
        c = np.array([drawn[rows][y[rows] == k].sum() for k in (0, 1)], float)
        value = c[1] * w[1] / (c @ w) if c @ w else .5
        best = None
        if depth < fit.depth and c.min() > 0 and c.sum() >= 2 * fit.leaf:
            tries = max(1, int(np.sqrt(len(fit.features))))
            for f in T._tried(np.array([path], np.uint64), fit.features, tries)[0]:
                for b in range(T.BINS):
                    low = rows[x[rows, f] <= b]
                    a = np.array([drawn[low][y[low] == k].sum() for k in (0, 1)], float)
                    if a.sum() >= fit.leaf and (c - a).sum() >= fit.leaf:
                        def loss(v):
                            v = v * w
                            return v.sum() - (v @ v) / v.sum() if v.sum() else 0.0
                        gain = loss(c) - loss(a) - loss(c - a)
                        if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, b)
        if best is None:
            chance[rows] = value
            return
        _, f, b = best
        for side, keep in ((1, x[rows, f] <= b), (2, x[rows, f] > b)):
            grow(rows[keep], T._mix(np.array([path], np.uint64) ^ np.uint64(side))[0], depth + 1)
    grow(np.arange(len(x)), path0, 0)
    return chance


def scores(rows, fits, points, **more):
    out = {}
    for trees in T.grow_forests(rows, fits, **more):
        for r in T.score_forests(rows, trees, points, more.get("fills")).collect():
            out[trees.fits[r.fit].name, r.id] = (r.label, *r.scores)
    return out


def test_forest_is_its_recursion(data):
    fit = T.Forest("a", 0, 1, (0, 1, 2, 3, 4), 4, 6, 4)
    x, labels, parts, keys, ids = as_numpy(data)
    got = scores(data, [fit], [(6, 4)])
    y, part = labels[:, 0], parts[:, 0]
    train = (part >= 0) & (part != 1)
    n = np.bincount(y[train], minlength=2)
    w = n.sum() / (2 * n)
    want = np.zeros(len(x))
    for number in range(6):
        drawn = np.searchsorted(T._POISSON, T._uniform(keys, np.array([number], np.uint64))[:, 0], "right") * train
        want += recursive_tree(fit, number, x, y, w, drawn, 42) / 6
    held = [i for i in range(len(x)) if part[i] == 1]
    assert set(got) == {("a", ids[i]) for i in held}
    for i in held:
        assert got["a", ids[i]][1] == pytest.approx(want[i]) and got["a", ids[i]][0] == y[i]


def test_joint_fits_are_separate_fits(data, monkeypatch):
    fits = [T.Forest((s, k, leaf), s, k, f, leaf, 8, 6) for s in (0, 1) for k in (-1, 0) for leaf, f in ((3, (0, 1, 2, 3)), (6, (1, 4)))]
    joint = scores(data, fits, [(8, 6)])
    for f in fits[::3]:
        alone = scores(data.repartition(5), [f], [(8, 6)])
        assert alone == {k: v for k, v in joint.items() if k[0] == f.name}
    monkeypatch.setattr(T, "CELLS", 2000)  # many passes a level
    monkeypatch.setattr(T, "TREES", 17)  # few trees at a time
    assert scores(data, fits, [(8, 6)]) == joint


def test_smaller_forests_are_parts_of_larger(data):
    large = scores(data, [T.Forest("a", 0, 0, (0, 1, 2, 3, 4), 3, 10, 30)], [(5, 2), (5, 30), (10, 2), (10, 30)])
    for at, (n, d) in enumerate([(5, 2), (5, 30), (10, 2), (10, 30)], 1):
        alone = scores(data, [T.Forest("a", 0, 0, (0, 1, 2, 3, 4), 3, n, d)], [(n, d)])
        assert {k: v[1] for k, v in alone.items()} == pytest.approx({k: v[at] for k, v in large.items()})


def boosted(rows, fits, points, **more):
    out, importances = T.boost(rows, fits, points, **more)
    return {(fits[r.fit].name, r.id): tuple(r.scores) for r in out.collect()}, importances


@pytest.mark.parametrize("row_fits", [0, 1 << 21])
def test_boosting_is_its_recursion(data, monkeypatch, row_fits):
    monkeypatch.setattr(T, "ROW_FITS", row_fits)
    fit = T.Boost("b", 0, 2, (0, 1, 2, 3, 4), 2, .3, 1.0, 3)
    got, _ = boosted(data, [fit], [3])
    x, labels, parts, keys, ids = as_numpy(data)
    y, part = labels[:, 0], parts[:, 0]
    n = np.bincount(y[part >= 0], minlength=2)
    w = (n.sum() / (2 * n))[y]
    train = np.flatnonzero((part >= 0) & (part != 2))
    prior = (w * y)[train].sum() / w[train].sum()
    margin = np.full(len(x), np.log(prior / (1 - prior)))
    for _ in range(3):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(x))

        def grow(rows, every, depth):
            best = None
            if depth < 2 and len(rows) > 1:
                for f in range(5):
                    for b in range(T.BINS):
                        low, high = rows[x[rows, f] <= b], rows[x[rows, f] > b]
                        if len(low) and len(high):
                            wl, wh = w[low].sum(), w[high].sum()
                            apart = (w * (y - p))[low].sum() / wl - (w * (y - p))[high].sum() / wh
                            gain = wl * wh / (wl + wh) * apart**2
                            if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                                best = (gain, f, b)
            if best is None:
                step[every] = (w * (y - p))[rows].sum() / (w * p * (1 - p))[rows].sum()
                return
            _, f, b = best
            for keep in (lambda r: x[r, f] <= b, lambda r: x[r, f] > b):
                grow(rows[keep(rows)], every[keep(every)], depth + 1)
        grow(train, np.arange(len(x)), 0)
        margin = margin + .3 * step
    held = np.flatnonzero(part == 2)
    assert len(got) == len(held)
    for i in held:
        assert got["b", ids[i]][0] == pytest.approx(1 / (1 + np.exp(-margin[i])))


def test_rounds_are_prefixes_and_fits_independent(data, monkeypatch):
    fits = [T.Boost((d, s, k), 0, k, (0, 1, 2, 3), d, .2, s, 12) for d in (1, 3) for s in (.7, 1.0) for k in (-1, 0)]
    joint, importances = boosted(data, fits, [6, 12])
    assert importances.shape == (2, 8, 4) and np.allclose(importances.sum(2), 1)
    for f in fits[::3]:
        short = T.Boost(f.name, 0, f.fold, f.features, f.depth, f.rate, f.share, 6)
        alone, _ = boosted(data.repartition(4), [short], [6])
        assert {k: v[0] for k, v in alone.items()} == pytest.approx({k: v[0] for k, v in joint.items() if k[0] == f.name})
    monkeypatch.setattr(T, "ROW_FITS", 0)  # rows stay, every level is a pass over them
    spread, spread_importances = boosted(data, fits, [6, 12])
    assert {k: v[1] for k, v in spread.items()} == pytest.approx({k: v[1] for k, v in joint.items()})
    assert np.allclose(spread_importances, importances)
    monkeypatch.setattr(T, "STEP", 5)
    monkeypatch.setattr(T, "CELLS", 3000)
    again, _ = boosted(data, fits, [6, 12])
    assert {k: v[1] for k, v in again.items()} == pytest.approx({k: v[1] for k, v in joint.items()})


def test_auc_by_point(data):
    trees = next(T.grow_forests(data, [T.Forest("a", 0, 0, (0, 1, 2), 3, 5, 4)]))
    scored = T.score_forests(data, trees, [(2, 1), (5, 4)])
    rows = scored.collect()
    for point, got in T.auc_by_point(scored).items():
        a = [(r.scores[point[1]], r.label) for r in rows]
        ones, zeros = [s for s, y in a if y], [s for s, y in a if not y]
        assert got == pytest.approx(np.mean([(p > q) + (p == q) / 2 for p in ones for q in zeros]))


def test_nulls_take_the_scenario_fill(spark):
    rows = [(i, float(i % 10) if i % 7 else None, [int(i % 10 > 4), int(i % 10 > 6)], [i % 3 - 1, i % 3 - 1]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, x double, labels array<int>, parts array<int>")
    edges = T.bin_edges(df, ["x"], 8)
    null = T.bin_rows(df, "id", ["x"], edges)
    fit = [T.Forest("a", s, 0, (0,), 1, 4, 3) for s in (0, 1)]
    with pytest.raises(Exception, match="nothing to fill"):
        scores(null, fit, [(4, 3)])
    fills = np.array([[2], [5]], np.uint8)
    for s in (0, 1):
        at = edges[0][fills[s, 0]]  # a value of that bin
        filled = T.bin_rows(df.fillna({"x": float(at)}), "id", ["x"], edges)
        assert scores(null, [fit[s]], [(4, 3)], fills=fills) == scores(filled, [fit[s]], [(4, 3)])
