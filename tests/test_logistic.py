"""All logistic fits in shared passes against Spark ML, one fit at a time."""
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from losslens.operators import model as M


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 4))
    y = (x[:, 0] - 2 * x[:, 1] + r.normal(size=400) > 1).astype(float)
    w = np.where(y == 1, 200 / max(y.sum(), 1), 200 / (400 - y.sum()))
    return spark.createDataFrame([(i, *map(float, x[i, :3]), 0.0, float(y[i]), float(w[i]), i % 5, int(i % 6 == 0)) for i in range(400)],
                                 "user_id int, _z_a double, _z_b double, _z_c double, _z_d double, label double, w double, "
                                 "fold int, is_test int").repartition(3).cache()


NAMES = ["_z_a", "_z_b", "_z_c", "_z_d"]  # the last is constant


def by_spark(frame, penalty, share):
    d = VectorAssembler(inputCols=NAMES, outputCol="features").transform(frame)
    m = LogisticRegression(weightCol="w", maxIter=2000, tol=1e-13, standardization=False, regParam=penalty, elasticNetParam=share).fit(d)
    return [m.intercept, *m.coefficients], m


def test_coefficients_are_those_of_spark(frame):
    train = frame.where("is_test = 0")
    fits = [(p, a, fold) for p in (0.001, 0.1) for a in (0.0, 1.0) for fold in (2, -1)]
    got = M.logistic_fits(train, NAMES, fits, 5)
    for b, (p, a, fold) in zip(got, fits):
        want, _ = by_spark(train.where(F.col("fold") != fold), p, a)
        assert b == pytest.approx(want, abs=2e-5)
        assert a == 0 or p < .1 or (b[3:] == 0).all()  # L1 drops the features without effect


def test_grid_runs_few_passes(spark, frame, monkeypatch):
    passes, real = [], M._logistic_sums
    monkeypatch.setattr(M, "_logistic_sums", lambda *a: passes.append(1) or real(*a))
    got = M.logistic(frame, ["a", "b", "c", "d"])
    assert 2 <= len(passes) <= 40  # of all 48 fits
    n, best = frame.where("is_test = 0").count(), None
    for c in M.LR_C:
        for a in M.LR_L1:
            aucs = []
            for fold in range(5):
                m = by_spark(frame.where(f"is_test = 0 AND fold <> {fold}"), 1 / (c * n), a)[1]
                held = VectorAssembler(inputCols=NAMES, outputCol="features").transform(frame.where(f"is_test = 0 AND fold = {fold}"))
                s = np.array([(r.probability[1], r.label) for r in m.transform(held).collect()])
                one, zero = s[s[:, 1] == 1, 0], s[s[:, 1] == 0, 0]
                aucs.append(((one[:, None] > zero).mean() + (one[:, None] == zero).mean() / 2))
            if best is None or np.mean(aucs) > best + 1e-9:
                best = np.mean(aucs)
        break  # the smallest C: both penalties
    assert got["cv_auc"] >= best - 1e-9 and got["test_auc"] > .9
    assert got["tp"] + got["fn"] + got["fp"] + got["tn"] == frame.where("is_test = 1").count()
    assert got["importance"]["d"] == 0 and set(got["importance"]) == {"a", "b", "c", "d"}


def test_one_class_ends(frame):
    got = M.logistic_fits(frame.withColumn("label", F.lit(1.0)), NAMES, [(0.1, 0.0, -1), (0.1, 1.0, 0)], 5)
    assert np.isfinite(got).all() and (got[:, 0] > 5).all()
