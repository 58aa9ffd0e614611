"""RQ3 job (M22): who becomes a high-erosion customer?

customer targets (RFM LEFT erosion, erosion > 0, P75 label, modal
category / source) -> prepare (split, train medians) -> screening on the
training rows -> grid search per model -> rule baseline -> comparison,
importances, hypothesis -> drop-top-n ablation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.operators import aggregates as A
from losslens.operators import concentration as C
from losslens.operators import joins as J
from losslens.operators import model as M
from losslens.operators import sensitivity as SE
from losslens.plans.registry import featured_items, returned_items
from losslens.session import cut_lineage, stored
from losslens.sources.adapter import DRIVER_TIERS, first_orders


def customer_targets(spark: SparkSession, sf: str) -> DataFrame:
    # joined once: the tables below are aggregates of these columns
    f = stored(featured_items(spark, sf, ["order_created_at", "user_created_at", "traffic_source", "age"]).select(
        "order_item_id", "order_id", "user_id", "sale_price", "item_margin", "is_returned_item", "category",
        "order_created_at", "user_created_at", "traffic_source", "age"), "customer-items")
    beh = A.customer_behavioral_features(f)
    # without the customers: a customer that comes twice has each loss once
    ero = A.profit_erosion_by_customer(returned_items(spark, sf)).select(
        "user_id", "total_margin_reversal", "total_process_cost", "total_profit_erosion")
    d = beh.join(ero, ["user_id"], "left").fillna(
        0.0, subset=["total_margin_reversal", "total_process_cost", "total_profit_erosion"])
    d = cut_lineage(d.where(F.col("total_profit_erosion") > 0))
    t = C.create_profit_erosion_targets(d)
    cat = J.dominant_value(f, "user_id", "category", "dominant_return_category")
    src = J.dominant_value(f, "user_id", "traffic_source", "traffic_source")
    # customer-grain stage boundary: reliable checkpoint (shared folder) so the
    # later rank / split / fold passes do not re-plan the item pipeline
    age = f.groupBy("user_id").agg(A.first_non_null("age", "order_item_id").alias("age"))
    return cut_lineage(t.join(cat, ["user_id"], "left").join(src, ["user_id"], "left")
                       .join(age, ["user_id"], "left"))


def prepared(spark: SparkSession, sf: str, features=None) -> DataFrame:
    return cut_lineage(M.prepare_modeling_data(customer_targets(spark, sf),
                                               features or M.RQ3_CANDIDATE_FEATURES))


def single_scenario(customers: DataFrame, features=None, target: str = M.RQ3_TARGET) -> M.Scenarios:
    """Customers with their one label, binned for the tree models."""
    features = list(features or M.RQ3_CANDIDATE_FEATURES)
    labels = customers.select(F.lit(0).alias("scenario"), "user_id", F.col(target).alias("label"))
    return M.label_scenarios(customers, labels, 1, features)


def run_rq3(spark: SparkSession, sf: str, ablation_top_n: int = 3) -> dict:
    return fit_and_compare(customer_targets(spark, sf), ablation_top_n)


def fit_and_compare(customers: DataFrame, ablation_top_n: int = 3, features=None) -> dict:
    """All grids on one customer table; M9 drops the forest's top features and
    grows its grid again."""
    spark, features = customers.sparkSession, list(features or M.RQ3_CANDIDATE_FEATURES)
    prep = cut_lineage(M.prepare_modeling_data(customers, features))
    survivors, screen = M.screen_features(prep.where(F.col("is_test") == 0), features)
    data = single_scenario(customers, features)
    results = {"Logistic Regression": M.logistic(M.model_frame(prep, survivors), survivors),
               "Random Forest": M.forest_grids(data, {"all": (0, survivors)})["all"],
               "Gradient Boosting": M.boosting_grid(data, 0, survivors)}
    rule = M.rule_baseline(prep) if "return_frequency" in prep.columns else None
    if rule:
        results["Rule Baseline"] = rule
    comp = M.comparison_table(spark, results)
    imp = M.importance_table(spark, {k: v for k, v in results.items() if "importance" in v})
    hyp = M.hypothesis_record({k: v for k, v in results.items() if k != "Rule Baseline"})
    full = results["Random Forest"]
    top = [f for f, _ in sorted(full["importance"].items(), key=lambda kv: -kv[1])[:ablation_top_n]]
    reduced = [f for f in survivors if f not in top]
    abl = None
    if reduced:
        less = M.forest_grids(data, {"reduced": (0, reduced)})["reduced"]
        abl = spark.createDataFrame([(",".join(top), full["test_auc"], less["test_auc"], full["test_auc"] - less["test_auc"])],
                                    "dropped string, auc_full double, auc_reduced double, auc_drop double")
    return {"screening": screen, "survivors": survivors, "comparison": comp, "importance": imp,
            "hypothesis": hyp, "ablation": abl, "results": results}


def rq3_tables(spark: SparkSession, sf: str) -> DataFrame:
    """M22 as one long table: (section, subject, metric, value) of the
    comparison (M4, M5, M15), importances (M7, A28), ablation (M9) and the
    hypothesis record (T14) of one run of all grids."""
    r = run_rq3(spark, sf)
    comp, imp, abl, hyp = r["comparison"], r["importance"], r["ablation"], r["hypothesis"]

    def long(df, section, subject):
        values = [c for c, t in df.dtypes if c != subject and t != "string"]
        return df.select(F.lit(section).alias("section"), F.col(subject).alias("subject"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])).alias("m")) \
            .select("section", "subject", "m.*")
    rows = [("hypothesis", hyp["best_model"], "best_auc", float(hyp["best_auc"])),
            ("hypothesis", hyp["best_model"], "reject_h0", float(hyp["reject_h0"]))]
    rows += [("survivor", f, "place", float(i)) for i, f in enumerate(r["survivors"], 1)]
    out = long(comp, "comparison", "model").unionByName(long(imp, "importance", "feature"))
    if abl is not None:
        out = out.unionByName(long(abl, "drop_top", "dropped"))
    return out.unionByName(spark.createDataFrame(rows, "section string, subject string, metric string, value double"))


# ------------------------------------------------------------------ M10-M14 ablations
# fixed values: the feature families and feature sets of the studies
FAMILIES = {
    "return_behavior": ["return_frequency", "customer_return_rate"],
    "purchase_behavior": ["order_frequency", "avg_basket_size", "avg_order_value", "total_items", "total_sales"],
    "margin_structure": ["total_margin", "avg_item_price", "avg_item_margin"],
    "temporal": ["customer_tenure_days", "purchase_recency_days"],
}
BEHAVIORAL = ["order_frequency", "return_frequency", "customer_return_rate", "avg_basket_size",
              "customer_tenure_days", "purchase_recency_days", "total_items"]
ECONOMIC = ["avg_order_value", "total_sales", "total_margin", "avg_item_price", "avg_item_margin"]
# fixed values: the loss columns of the target-construction study
TARGETS = ["total_profit_erosion", "total_margin_reversal", "total_process_cost"]
GATES = {"Full pipeline": {}, "No correlation gate": {"use_correlation_gate": False},
         "No univariate gate": {"use_univariate_gate": False},
         "No screening": {"use_correlation_gate": False, "use_univariate_gate": False}}


def ablation_variants(spark: SparkSession, sf: str) -> tuple[M.Scenarios, list[tuple]]:
    """Rows with a label for each target of M12, and (study, variant, scenario,
    screened features) of M10-M13.  Each variant is screened anew on its own
    training rows, without the variance gate; M12's targets have splits of
    their own."""
    customers = customer_targets(spark, sf)
    base = customers.drop("is_high_erosion_customer", "erosion_percentile_rank", "profit_erosion_quartile")
    targets = [customers] + [C.create_profit_erosion_targets(base, erosion_column=c) for c in TARGETS]
    labels = reduce(DataFrame.unionByName, [t.select(F.lit(i).alias("scenario"), "user_id", F.col(M.RQ3_TARGET).alias("label"))
                                            for i, t in enumerate(targets)])
    data, every = M.label_scenarios(customers, labels, len(targets)), M.RQ3_CANDIDATE_FEATURES

    def screened(columns, scenario=0, **gates):
        return data.screened(columns, use_variance_gate=False, **gates)[scenario]

    out = [("preprocessing", name, 0, screened(every, **off)) for name, off in GATES.items()]
    out.append(("feature_family", "Full model", 0, out[0][3]))
    for name, gone in FAMILIES.items():
        out.append(("feature_family", f"No {name}", 0, screened([c for c in every if c not in gone])))
    own = data.screened(every, use_variance_gate=False)
    out += [("target_construction", column, i, own[i]) for i, column in enumerate(TARGETS, 1)]
    for name, columns in (("Behavioral + economic (full set)", every), ("Behavioral only", BEHAVIORAL),
                          ("Economic only", ECONOMIC)):
        out.append(("feature_set", name, 0, screened(columns)))
    return data, out


def ablation_features(spark: SparkSession, sf: str) -> DataFrame:
    """Screened features of each variant of M10-M13."""
    return spark.createDataFrame([(study, name, len(f), ", ".join(f)) for study, name, _, f in ablation_variants(spark, sf)[1]],
                                 "study string, variant string, n_features int, selected_features string")


def ablation_studies(spark: SparkSession, sf: str) -> DataFrame:
    """The forest's grid for every variant, with the test AUC lost
    against the study's full variant.  M14 takes the first features of the
    full pipeline's importances.  Different feature sets and targets grow
    together; equal ones are one set."""
    data, variants = ablation_variants(spark, sf)
    fitted = M.forest_grids(data, {(i, tuple(f)): (i, f) for _, _, i, f in variants if f})
    full = variants[0][3]
    ranked = [f for f, _ in sorted(fitted[0, tuple(full)]["importance"].items(), key=lambda kv: -kv[1])]
    variants += [("operational", "Full screened model", 0, full), ("operational", "Top-5 operational subset", 0, ranked[:5]),
                 ("operational", "Top-3 operational subset", 0, ranked[:3])]
    more = {(i, tuple(f)): (i, f) for _, _, i, f in variants[-2:] if (i, tuple(f)) not in fitted}
    fitted |= M.forest_grids(data, more) if more else {}
    first, rows = {}, []
    for study, name, i, feats in variants:
        r = fitted.get((i, tuple(feats)), {"cv_auc": float("nan"), "test_auc": float("nan")})  # nothing survived
        first.setdefault(study, r["test_auc"])
        rows.append((study, name, len(feats), ", ".join(feats), float(r["cv_auc"]), float(r["test_auc"]),
                     float(first[study] - r["test_auc"])))
    return spark.createDataFrame(rows, "study string, variant string, n_features int, selected_features string, "
                                       "cv_auc double, test_auc double, auc_drop_vs_full double")


# ------------------------------------------------------------------ M16 / M17: models of the sensitivity scenarios
def _scenario_models(customers: DataFrame, labelled: DataFrame, values: list[float], name: str) -> DataFrame:
    """One row a scenario: label counts, survivors and the forest's test rates.
    ``labelled``: (value of the scenario, user_id, threshold, label)."""
    spark = customers.sparkSession
    at = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(float(v)), F.lit(i))])
    labels = cut_lineage(labelled.withColumn("scenario", at[F.col(name)])
                         .join(customers.select("user_id"), "user_id", "left_semi"))
    counts = {r["scenario"]: r for r in labels.groupBy("scenario").agg(  # one row a scenario
        F.max("threshold").alias("threshold"), F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).collect()}
    data = M.label_scenarios(customers, labels, len(values))
    survivors = data.screened()
    fitted = M.forest_grids(data, {i: (i, f) for i, f in sorted(survivors.items()) if f})
    rows = []
    for i, v in enumerate(values):
        r, c, f = fitted.get(i, {}), counts[i], survivors.get(i, [])
        rows.append((float(v), *[None if k not in r else float(r[k]) for k in ("test_auc", "f1", "precision", "recall")],
                     float(c["threshold"]), int(c["ones"]), int(c["n"]), c["ones"] / c["n"], len(f), ", ".join(f)))
    return spark.createDataFrame(rows, f"{name} double, best_auc double, f1 double, precision double, recall double, "
                                       "threshold_value double, n_positive long, n_total long, positive_rate double, "
                                       "n_surviving_features int, surviving_features string")


def cost_sensitivity(spark: SparkSession, sf: str, base_costs=None) -> DataFrame:
    """Labels at the 75th percentile of the loss under each base cost."""
    costs = list(base_costs or SE.SENSITIVITY_BASE_COSTS)
    customers = cut_lineage(A.customer_behavioral_features(featured_items(spark, sf, ["order_created_at"]),
                                                           customers=first_orders(spark, sf)))
    loss = SE.erosion_under_costs(returned_items(spark, sf), costs, DRIVER_TIERS)
    loss = loss.join(customers.select("user_id"), "user_id", "left_semi")
    return _scenario_models(customers, SE.labels_by_scenario(loss, "base_cost"), costs, "base_cost")


def threshold_sensitivity(spark: SparkSession, sf: str, thresholds=None) -> DataFrame:
    """Labels at several percentiles of the loss at the usual cost."""
    percents = list(thresholds or SE.SENSITIVITY_THRESHOLDS)
    customers = customer_targets(spark, sf)
    scenarios = spark.createDataFrame([(float(p),) for p in percents], "threshold_percentile double")
    each = customers.select("user_id", "total_profit_erosion").crossJoin(F.broadcast(scenarios))  # fixed scenario list
    labelled = SE.labels_by_scenario(each, "threshold_percentile", percentile_col="threshold_percentile")
    return _scenario_models(customers, labelled, percents, "threshold_percentile")
