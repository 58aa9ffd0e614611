"""Forests that are measured without their trees in the driver, and boosting of many fits."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from losslens.operators import model as M
from losslens.operators import trees as T

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(300, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + r.normal(size=300) > 0.5).astype(int)
    # every tenth id comes twice
    df = spark.createDataFrame([(i - i % 10 // 9, *map(float, x[i]), [int(y[i]), int(x[i, 3] > 0)],
                                 [T.TEST if i % 5 == 0 else i % 3, T.ABSENT if i % 7 == 0 else i % 3]) for i in range(300)],
                               "id int, a double, b double, c double, d double, labels array<int>, parts array<int>")
    return T.bin_rows(df, "id", NAMES, T.bin_edges(df, NAMES)).cache()


FITS = [T.Forest("x", 0, 1, (0, 1, 2, 3), 5, 8, 30), T.Forest("y", 1, 2, (1, 3), 2, 5, 3), T.Forest("z", 0, T.TEST, (0, 2), 3, 8, 4)]
POINTS = [(4, 2), (4, 30), (8, 2), (8, 30)]


@pytest.mark.parametrize("most, nodes, block", [(1 << 20, 1 << 22, 1 << 16), (1 << 20, 1 << 22, 7), (10, 300, 1 << 16)])
def test_measures_are_those_of_the_trees(rows, monkeypatch, most, nodes, block):
    trees = next(T.grow_forests(rows, FITS))
    scored = T.score_forests(rows, trees, POINTS)
    aucs, held = T.auc_by_point(scored), scored.collect()
    for name, value in (("FOREST_ROWS", most), ("HELD_NODES", nodes), ("BLOCK", block), ("PIECE", 3)):
        monkeypatch.setattr(T, name, value)
    got = T.forest_measures(rows, FITS, POINTS)
    for i, f in enumerate(FITS):
        for k, point in enumerate(POINTS):
            assert got[i][k]["auc"] == pytest.approx(aucs[i, k])
            assert got[i][k]["importances"] == pytest.approx(trees.importances(i, *point))
            assert got[i][k]["counts"] == {(y, p): sum(r.fit == i and r.label == y and (r.scores[k] > .5) == p for r in held)
                                           for y in (0, 1) for p in (0, 1)}
    again = T.forest_scores(rows, FITS, POINTS).collect()
    def key(r):
        return r.fit, r.id, r.label, r.scores
    assert len(again) == len(held)
    for a, b in zip(sorted(again, key=key), sorted(held, key=key)):
        assert key(a)[:3] == key(b)[:3] and a.scores == pytest.approx(b.scores)


def _data(rows, fills=None):
    return M.Scenarios(rows, None, NAMES, [], fills, 3)


def test_grids_keep_no_trees_in_the_driver(rows, monkeypatch):
    for name, value in (("RF_TREES", [2, 4]), ("RF_DEPTH", [2, 5]), ("RF_LEAF", [3, 6])):
        monkeypatch.setattr(M, name, value)
    monkeypatch.setattr(T, "Trees", None)  # the driver's
    got = M.forest_grids(_data(rows), {"all": (0, NAMES), "less": (1, NAMES[:2])})
    assert set(got) == {"all", "less"} and 0.5 < got["all"]["cv_auc"] <= 1
    assert not any(isinstance(v, T.np.ndarray) or "trees" in k for r in got.values() for k, v in r.items())


def test_other_rows_are_scored_by_the_trees_of_the_point(spark, rows):
    fit = T.Forest("z", 0, T.TEST, (0, 2), 3, 6, 4)
    trees = next(T.grow_forests(rows, [fit]))
    others = rows.limit(40).select(F.concat(F.lit("s"), F.monotonically_increasing_id()).alias("id"), "row_key", "bins",
                                   F.array(F.lit(1)).alias("labels"))
    want = {r.id: r.scores[0] for r in T.score_forests(others.withColumn("parts", F.array(F.lit(T.TEST))), trees, [(6, 4)],
                                                       every_row_of=0).collect()}
    got = M.forest_scores(_data(rows), 0, ["a", "c"], (6, 4, 3), others).collect()
    assert {r.id: r.score for r in got} == pytest.approx(want) and all(r.label == 1 for r in got) and len(got) == 40


def test_empty_table_has_no_measures(rows):
    got = T.forest_measures(rows.where("false"), FITS[:1], POINTS[:1])
    assert np.isnan(got[0][0]["auc"]) and not got[0][0]["counts"]


def test_boosting_of_many_rows_and_fits_is_dealt(spark, monkeypatch):
    df = spark.range(50_000).select("id", (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 89).cast("double").alias("b"),
                                    F.array((F.col("id") % 97 > F.col("id") % 89).cast("int")).alias("labels"),
                                    F.array((F.col("id") % 4 - 1).cast("int")).alias("parts"))
    data = T.bin_rows(df, "id", ["a", "b"], T.bin_edges(df, ["a", "b"]))
    monkeypatch.setattr(T, "_passed", None)  # a Spark job for each level of each round
    fits = [T.Boost((i, k), 0, k, (0, 1), 2, .1, 1.0, 2) for i in range(16) for k in (-1, 0, 1)]
    scored, importances = T.boost(data, fits, [1, 2])
    assert scored.count() == 16 * 37_500 and np.allclose(importances.sum(2), 1)


def test_screening_again_reads_nothing(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(200, 3))
    long = spark.createDataFrame([(s, int(x[i, s] > 0), i % 5 - 1, *map(float, x[i]), float(x[i, 0] + x[i, 1] / 9))
                                  for i in range(200) for s in (0, 1)],
                                 "scenario int, label int, part int, a double, b double, c double, d double")
    data = M.Scenarios(None, long, NAMES, [], None, 3)
    subsets = [NAMES, ["d", "a"], ["c", "b"]]
    want = [{s: M.screen_features(long.where(f"scenario = {s} AND part >= 0"), names, "label")[0] for s in (0, 1)} for names in subsets]
    assert data.screened(NAMES) == want[0]
    data.long = None  # the measures are there
    assert [data.screened(names) for names in subsets[1:]] == want[1:]
    assert set(data.screened(use_correlation_gate=False, use_univariate_gate=False)[0]) == set(NAMES)
