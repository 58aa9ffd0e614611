"""Catalog entries: econometrics (E-rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators import ols as O
from losslens.plans import rq4
from losslens.plans.registry import register
from losslens.plans.q_model import targets_sql

_NUM = [c for c in O.RQ4_HYPOTHESIS_PREDICTORS + O.RQ4_BEHAVIORAL_CONTROLS if c != "age"]

register("e1_target_correlations", targets_sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), total_profit_erosion) AS correlation FROM tg"
        for c in _NUM) + ")"), ["correlation"])(
    lambda spark, sf: O.screen_features(rq4.regression_inputs(spark, sf), numeric=_NUM)["correlation_table"])

_CATS = ["traffic_source"]
register("e2_regression_design", targets_sql(
    ", st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _NUM) +
    " FROM tg WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _NUM + _CATS) + """),
lv AS (SELECT min(traffic_source) AS first_level FROM tg)
SELECT user_id, ln(total_profit_erosion) AS y, 1.0 AS const, """ + ", ".join(
        f"({c} - m_{c}) / s_{c} AS {c}" for c in _NUM) + """,
  CAST(traffic_source = 'BUILDING' AS DOUBLE) AS traffic_source_BUILDING,
  CAST(traffic_source = 'FURNITURE' AS DOUBLE) AS traffic_source_FURNITURE,
  CAST(traffic_source = 'HOUSEHOLD' AS DOUBLE) AS traffic_source_HOUSEHOLD,
  CAST(traffic_source = 'MACHINERY' AS DOUBLE) AS traffic_source_MACHINERY
FROM tg CROSS JOIN st WHERE total_profit_erosion > 0"""),
         ["y", "const"] + _NUM + ["traffic_source_BUILDING", "traffic_source_FURNITURE",
                                  "traffic_source_HOUSEHOLD", "traffic_source_MACHINERY"])(
    lambda spark, sf: O.prepare_regression_data(rq4.regression_inputs(spark, sf), O.RQ4_TARGET_COL,
                                                _NUM, _CATS, True)[0])


def _run(spark, sf):
    return rq4.run_rq4(spark, sf)


register("e3_e6_ols_hc3_coefficients", None)(lambda spark, sf: _run(spark, sf)["coefficients"])
register("e4_vif", None)(lambda spark, sf: _run(spark, sf)["vif"])
register("e5_residual_diagnostics", None)(lambda spark, sf: _run(spark, sf)["diagnostics"])
register("e7_fit_summary", None)(lambda spark, sf: _run(spark, sf)["summary"])
register("e12_rq4_job_linear_vs_log", None)(
    lambda spark, sf: (lambda r: r["summary"].withColumn("model", F.lit("log")).unionByName(
        r["linear_summary"].withColumn("model", F.lit("linear"))))(_run(spark, sf)))
