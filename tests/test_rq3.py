"""The RQ3 job, its label scenarios and ablations on small grids."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from losslens.operators import model as M
from losslens.operators import trees as T
from losslens.plans import rq3

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_grids(monkeypatch):
    for name, value in (("RF_TREES", [4, 8]), ("RF_DEPTH", [2, 6]), ("RF_LEAF", [3, 6]), ("GB_TREES", [3, 6]),
                        ("GB_DEPTH", [2, 3]), ("GB_RATE", [0.1]), ("GB_SHARE", [0.8, 1.0]), ("LR_C", [0.1, 1])):
        monkeypatch.setattr(M, name, value)


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(5)
    n, f = 300, M.RQ3_CANDIDATE_FEATURES
    x = rng.normal(size=(n, len(f))) * 10
    x[:, 5] = x[:, 4] * 2 + rng.normal(size=n) * .1  # one of these two goes
    score = x[:, 1] + x[:, 2] * .5 + rng.normal(size=n) * 4
    y = score > np.quantile(score, .75)
    z = x[:, 3] > 8
    rows = [(int(i), *map(float, x[i]), int(y[i]), int(z[i])) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, " + ", ".join(f"{c} double" for c in f)
                                 + f", {M.RQ3_TARGET} int, other int").persist()


def test_scenarios_split_by_their_own_labels(spark, customers):
    holed = customers.withColumn("total_items", F.when(F.col("user_id") % 9 > 0, F.col("total_items")))
    labels = holed.select(F.lit(0).alias("scenario"), "user_id", F.col(M.RQ3_TARGET).alias("label")).union(
        holed.where("user_id < 200").select(F.lit(1).alias("scenario"), "user_id", "other"))
    data = M.label_scenarios(holed, labels, 2)
    rows = {r.id: r for r in data.rows.collect()}
    assert len(rows) == 300 and all(rows[i].parts[1] == T.ABSENT for i in range(200, 300))
    for s, column, n in ((0, M.RQ3_TARGET, 300), (1, "other", 200)):
        truth = {r.user_id: r[column] for r in holed.where(f"user_id < {n}").collect()}
        for c in (0, 1):
            parts = [rows[i].parts[s] for i, y in truth.items() if y == c]
            assert all(rows[i].labels[s] == c for i, y in truth.items() if y == c)
            assert parts.count(T.TEST) == round(.2 * len(parts))
            sizes = [parts.count(k) for k in range(5)]
            assert max(sizes) - min(sizes) <= 1
        train = [r.total_items for r in holed.collect() if rows[r.user_id].parts[s] >= 0 and r.total_items is not None]
        at = data.features.index("total_items")
        assert data.fills[s, at] == np.searchsorted(data.edges[at], np.median(train), "left")
        assert rows[9].bins[at] == T.NULL_BIN
    # the only scenario's split is that of the prepared frame
    prep = {r.user_id: r.is_test for r in M.prepare_modeling_data(customers).collect()}
    one = {r.id: r.parts[0] for r in rq3.single_scenario(customers).rows.collect()}
    assert {i: int(p == T.TEST) for i, p in one.items()} == prep


def test_scenarios_are_screened_as_alone(spark, customers):
    labels = customers.select(F.lit(0).alias("scenario"), "user_id", F.col(M.RQ3_TARGET).alias("label")).union(
        customers.select(F.lit(1).alias("scenario"), "user_id", "other"))
    data = M.label_scenarios(customers, labels, 2)
    got = data.screened()
    for s in (0, 1):
        alone, _ = M.screen_features(data.long.where(f"scenario = {s} AND part >= 0"), data.features, "label")
        assert got[s] == alone
    assert set(got[0]) != set(got[1])


def test_forest_grid_is_its_points_one_by_one(small_grids, customers):
    """Mean AUC over folds of every point, from forests grown for that point alone."""
    data = rq3.single_scenario(customers)
    feats = ["return_frequency", "customer_return_rate", "total_sales"]
    got = M.forest_grids(data, {"a": (0, feats), "b": (0, feats[:2])})["a"]
    best = None
    for n in M.RF_TREES:
        for d in M.RF_DEPTH:
            for leaf in M.RF_LEAF:
                aucs = []
                for fold in range(5):
                    trees = next(T.grow_forests(data.rows, [T.Forest("x", 0, fold, data.columns(feats), leaf, n, d)]))
                    aucs.append(T.auc_by_point(T.score_forests(data.rows, trees, [(n, d)]))[0, 0])
                if best is None or np.mean(aucs) > best[0] + 1e-12:
                    best = np.mean(aucs), (n, d, leaf)
    assert got["cv_auc"] == pytest.approx(best[0]) and got["point"] == best[1]
    n, d, leaf = best[1]
    trees = next(T.grow_forests(data.rows, [T.Forest("x", 0, T.TEST, data.columns(feats), leaf, n, d)]))
    scored = T.score_forests(data.rows, trees, [(n, d)]).collect()
    assert got["tp"] + got["fn"] == sum(r.label for r in scored) and got["tp"] + got["fp"] == sum(r.scores[0] > .5 for r in scored)
    assert sum(got["importance"].values()) == pytest.approx(1)


def test_rq3_on_a_small_frame(small_grids, customers):
    r = rq3.fit_and_compare(customers)
    assert "return_frequency" in r["survivors"] and len({"avg_order_value", "customer_tenure_days"} & set(r["survivors"])) <= 1
    comp = {x.model: x for x in r["comparison"].collect()}
    assert set(comp) == {"Logistic Regression", "Random Forest", "Gradient Boosting", "Rule Baseline"}
    for name in ("Logistic Regression", "Random Forest", "Gradient Boosting"):
        assert comp[name].test_auc > .7 and comp[name].cv_auc > .7
        res = r["results"][name]
        assert res["tp"] + res["fp"] + res["fn"] + res["tn"] == 60
        assert set(res["importance"]) == set(r["survivors"])
    assert r["hypothesis"]["reject_h0"]
    if r["ablation"] is not None:
        a = r["ablation"].first()
        assert a.auc_drop == pytest.approx(a.auc_full - a.auc_reduced)


def test_boosting_points_are_prefixes(small_grids, customers, monkeypatch):
    data, feats = rq3.single_scenario(customers), ["return_frequency", "customer_return_rate"]
    both = M.boosting_grid(data, 0, feats)
    best = []
    for n in (3, 6):
        monkeypatch.setattr(M, "GB_TREES", [n])
        best.append(M.boosting_grid(data, 0, feats))
    top = max(best, key=lambda b: b["cv_auc"])
    assert both["cv_auc"] == pytest.approx(top["cv_auc"]) and both["test_auc"] == pytest.approx(top["test_auc"])
    assert both["point"] == top["point"]


def test_ablations_and_sensitivity_end(spark, small_grids):
    rows = rq3.ablation_studies(spark, SF).collect()
    assert [r.study for r in rows].count("preprocessing") == 4 and {r.study for r in rows} == {
        "preprocessing", "feature_family", "target_construction", "feature_set", "operational"}
    assert all(r.auc_drop_vs_full == 0 for r in rows if r.variant in ("Full pipeline", "Full model", "Full screened model"))
    costs = {r.base_cost: r for r in rq3.cost_sensitivity(spark, SF).collect()}
    assert sorted(costs) == [8.0, 10.0, 12.0, 14.0, 18.0]
    percents = {r.threshold_percentile: r for r in rq3.threshold_sensitivity(spark, SF).collect()}
    assert percents[0.5].n_positive > percents[0.9].n_positive
    for r in [*costs.values(), *percents.values()]:
        assert r.n_surviving_features == len([f for f in r.surviving_features.split(", ") if f])
        assert (r.best_auc is None) == (r.n_surviving_features == 0) and 0 < r.positive_rate < 1
