"""Catalog entries: RQ3 modelling (M-rows), sensitivity."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators import model as M
from losslens.operators import sensitivity as SE
from losslens.plans import rq3
from losslens.plans.registry import register, returned_items
from losslens.plans.q_aggregates import CUSTOMER_EROSION_SQL, RFM_SQL_CTE
from losslens.plans.q_concentration import QUARTILE_SQL
from losslens.plans.sqlkit import tier_case_sql, with_features
from losslens.sources.adapter import DRIVER_TIERS

_CE = CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + ")"
TARGETS_SQL = RFM_SQL_CTE.strip().lstrip(",") + ",\n" + _CE + """,
cd AS (SELECT r.*, coalesce(ce.total_margin_reversal, 0.0) AS total_margin_reversal,
       coalesce(ce.total_process_cost, 0.0) AS total_process_cost,
       coalesce(ce.total_profit_erosion, 0.0) AS total_profit_erosion
       FROM rfm r LEFT JOIN ce ON r.user_id = ce.user_id WHERE coalesce(ce.total_profit_erosion, 0.0) > 0),
e AS (SELECT quantile_cont(total_profit_erosion, 0.0) AS e0, quantile_cont(total_profit_erosion, 0.25) AS e1,
             quantile_cont(total_profit_erosion, 0.5) AS e2, quantile_cont(total_profit_erosion, 0.75) AS e3,
             quantile_cont(total_profit_erosion, 1.0) AS e4 FROM cd),
mc AS (SELECT user_id, arg_min(category, (-n, category)) AS dominant_return_category FROM
       (SELECT user_id, category, count(*) AS n FROM f WHERE user_id IS NOT NULL AND category IS NOT NULL
        GROUP BY ALL) GROUP BY user_id),
ms AS (SELECT user_id, arg_min(traffic_source, (-n, traffic_source)) AS traffic_source FROM
       (SELECT user_id, traffic_source, count(*) AS n FROM f WHERE user_id IS NOT NULL
        AND traffic_source IS NOT NULL GROUP BY ALL) GROUP BY user_id),
tg AS (SELECT cd.*, (rank() OVER (ORDER BY total_profit_erosion)
        + (count(*) OVER (PARTITION BY total_profit_erosion) - 1) / 2.0) / count(*) OVER () * 100
        AS erosion_percentile_rank, CAST(total_profit_erosion > e3 AS INTEGER) AS is_high_erosion_customer,
        CAST(""" + QUARTILE_SQL.replace("v >", "total_profit_erosion >") + """ AS INTEGER) AS profit_erosion_quartile,
        mc.dominant_return_category, ms.traffic_source
       FROM cd CROSS JOIN e LEFT JOIN mc ON cd.user_id = mc.user_id LEFT JOIN ms ON cd.user_id = ms.user_id)"""


def targets_sql(tail: str) -> str:
    return with_features(TARGETS_SQL + "\n" + tail)


_TCOLS = ["user_id"] + M.RQ3_CANDIDATE_FEATURES + [
    "total_profit_erosion", "erosion_percentile_rank", "is_high_erosion_customer",
    "profit_erosion_quartile", "dominant_return_category", "traffic_source"]
register("m0_customer_targets", targets_sql("SELECT " + ", ".join(_TCOLS) + " FROM tg"),
         ["customer_return_rate", "avg_basket_size", "avg_order_value", "total_sales", "total_margin",
          "avg_item_price", "avg_item_margin", "total_profit_erosion", "erosion_percentile_rank"],
         ints=["is_high_erosion_customer", "profit_erosion_quartile"])(
    lambda spark, sf: rq3.customer_targets(spark, sf).select(*_TCOLS))

register("m1_split_counts", targets_sql("""
SELECT is_high_erosion_customer, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS n_test
FROM tg GROUP BY 1"""), ints=["is_high_erosion_customer"])(
    lambda spark, sf: rq3.prepared(spark, sf).groupBy("is_high_erosion_customer").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_test").cast("long").alias("n_test")))

register("m2_screening_report", None)(
    lambda spark, sf: M.screen_features(rq3.prepared(spark, sf).where("is_test = 0"),
                                        M.RQ3_CANDIDATE_FEATURES)[1])

# M6: exact AUC / ROC of a fixed score (return frequency) against the label
register("m6_exact_auc_return_frequency", targets_sql("""
, r AS (SELECT is_high_erosion_customer AS y, rank() OVER (ORDER BY return_frequency)
        + (count(*) OVER (PARTITION BY return_frequency) - 1) / 2.0 AS rk FROM tg)
SELECT (sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
       / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS auc FROM r"""), ["auc"])(
    lambda spark, sf: spark.createDataFrame([(float(M.exact_auc(
        rq3.customer_targets(spark, sf).select(F.col("return_frequency").alias("score"),
                                               F.col("is_high_erosion_customer").alias("label")))),)],
        "auc double"))

register("m6_roc_curve_return_frequency", targets_sql("""
, rg AS (SELECT return_frequency AS s, count(*) AS cnt, sum(is_high_erosion_customer) AS p FROM tg GROUP BY 1),
rc AS (SELECT s, sum(p) OVER (ORDER BY s DESC) AS tp, sum(cnt - p) OVER (ORDER BY s DESC) AS fp,
      sum(p) OVER () AS tp_all, sum(cnt - p) OVER () AS fp_all FROM rg)
SELECT CAST(s AS DOUBLE) AS threshold, fp / fp_all AS fpr, tp / tp_all AS tpr FROM rc"""),
         ["threshold", "fpr", "tpr"])(
    lambda spark, sf: M.roc_curve(rq3.customer_targets(spark, sf).select(
        F.col("return_frequency").alias("score"), F.col("is_high_erosion_customer").alias("label"))))

# M8 / M5 with all rows as the fitting set (deterministic, SQL-checkable)
register("m8_rule_baseline_all_rows", targets_sql("""
, pr AS (SELECT (1.0 - avg(CAST(is_high_erosion_customer AS DOUBLE))) * (count(*) - 1) AS pos FROM tg),
so AS (SELECT CAST(return_frequency AS DOUBLE) AS x, row_number() OVER (ORDER BY return_frequency) - 1 AS i FROM tg),
th AS (SELECT min(x) FILTER (WHERE i = floor(pos)) + (min(x) FILTER (WHERE i = ceil(pos))
       - min(x) FILTER (WHERE i = floor(pos))) * (any_value(pos) - floor(any_value(pos))) AS t
       FROM so CROSS JOIN pr),
p AS (SELECT is_high_erosion_customer AS y, CAST(return_frequency >= t AS INTEGER) AS yhat FROM tg CROSS JOIN th)
SELECT (SELECT t FROM th) AS threshold, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
       count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp, count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn,
       count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn FROM p"""), ["threshold"])(
    lambda spark, sf: _rule_all(spark, sf))


def _rule_all(spark, sf):
    t = rq3.customer_targets(spark, sf).withColumn("is_test", F.lit(0))
    r = M.rule_baseline(t.unionByName(t.withColumn("is_test", F.lit(1))))
    return spark.createDataFrame([(float(r["threshold"]), r["tp"], r["fp"], r["fn"], r["tn"])],
                                 "threshold double, tp long, fp long, fn long, tn long")


# Label part for every scenario in one job
_COSTS = SE.SENSITIVITY_BASE_COSTS
register("m16_cost_sensitivity_labels", with_features(
    "c AS (SELECT * FROM (VALUES " + ", ".join(f"(CAST({c} AS DOUBLE))" for c in _COSTS) +
    ") v(base_cost)),\ne AS (SELECT base_cost, user_id, sum(item_margin + base_cost * " + tier_case_sql() +
    """) AS total_profit_erosion FROM f CROSS JOIN c WHERE is_returned_item = 1 GROUP BY ALL),
t AS (SELECT base_cost, quantile_cont(total_profit_erosion, 0.75) AS thr FROM e GROUP BY 1),
l AS (SELECT e.base_cost, user_id, CAST(total_profit_erosion > thr AS INTEGER) AS label FROM e JOIN t USING (base_cost)),
b AS (SELECT user_id, label AS lb FROM l WHERE base_cost = 12.0)
SELECT l.base_cost, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
       count(*) FILTER (WHERE label <> lb) AS n_flipped, count(*) FILTER (WHERE label <> lb) / count(*) AS flip_rate,
       CASE WHEN count(*) FILTER (WHERE label = 1 OR lb = 1) > 0 THEN
            count(*) FILTER (WHERE label = 1 AND lb = 1) / count(*) FILTER (WHERE label = 1 OR lb = 1) ELSE 1.0 END
       AS jaccard
FROM l JOIN b USING (user_id) GROUP BY l.base_cost"""), ["base_cost", "flip_rate", "jaccard"])(
    lambda spark, sf: SE.stability_vs_baseline(
        SE.labels_by_scenario(SE.erosion_under_costs(returned_items(spark, sf), _COSTS, DRIVER_TIERS),
                              "base_cost"), "base_cost", 12.0))

_PCTS = SE.SENSITIVITY_THRESHOLDS
register("m17_threshold_sensitivity_labels", with_features(
    _CE + ",\np AS (SELECT * FROM (VALUES " + ", ".join(f"(CAST({p} AS DOUBLE))" for p in _PCTS) +
    """) v(pct)),
t AS (""" + " UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS pct, quantile_cont(total_profit_erosion, {p}) AS thr FROM ce"
                          for p in _PCTS) + """),
l AS (SELECT pct, user_id, CAST(total_profit_erosion > thr AS INTEGER) AS label FROM ce CROSS JOIN t),
b AS (SELECT user_id, label AS lb FROM l WHERE pct = 0.75)
SELECT l.pct, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
       count(*) FILTER (WHERE label <> lb) AS n_flipped, count(*) FILTER (WHERE label <> lb) / count(*) AS flip_rate,
       CASE WHEN count(*) FILTER (WHERE label = 1 OR lb = 1) > 0 THEN
            count(*) FILTER (WHERE label = 1 AND lb = 1) / count(*) FILTER (WHERE label = 1 OR lb = 1) ELSE 1.0 END
       AS jaccard
FROM l JOIN b USING (user_id) GROUP BY l.pct"""), ["pct", "flip_rate", "jaccard"])(
    lambda spark, sf: _thr_sens(spark, sf))


def _thr_sens(spark, sf):
    from losslens.operators import aggregates as A
    cust = A.profit_erosion_by_customer(returned_items(spark, sf)).select("user_id", "total_profit_erosion")
    pct = spark.createDataFrame([(p,) for p in _PCTS], "pct double")
    d = cust.crossJoin(F.broadcast(pct))  # fixed scenario list
    lab = SE.labels_by_scenario(d, "pct", percentile_col="pct")
    return SE.stability_vs_baseline(lab, "pct", 0.75)


# model part of M16 / M17: the forest's grid in every scenario
register("m16_cost_sensitivity_models", None)(rq3.cost_sensitivity)
register("m17_threshold_sensitivity_models", None)(rq3.threshold_sensitivity)
register("m22_rq3_job", None)(rq3.rq3_tables)
