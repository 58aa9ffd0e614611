"""RQ4 job (E12): which behaviours go with the size of the loss?

customer targets -> screening (E1) -> regression frame (E2; constant
numerics dropped first) -> log-linear and linear OLS with HC3 (E3) ->
VIF (E4), diagnostics incl. Durbin-Watson by user id (E5) -> tables (E6, E7).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from losslens.operators import ols as O
from losslens.plans import rq3


def regression_inputs(spark: SparkSession, sf: str):
    return rq3.customer_targets(spark, sf)


def fit_models(spark: SparkSession, sf: str, log_transform: bool = True, data=None, scr: dict | None = None):
    """One fit; ``data`` and their screening are made here unless given."""
    data = regression_inputs(spark, sf) if data is None else data
    scr = scr or O.screen_features(data)
    design, names, dropped = O.prepare_regression_data(
        data, O.RQ4_TARGET_COL, scr["surviving_numeric"], scr["surviving_categorical"], log_transform)
    design = design.persist()
    fit = O.fit_ols_hc3(design, names)
    fit["durbin_watson"] = O.durbin_watson(design, fit, "user_id")
    design.unpersist()
    fit["vif"] = O.vif_table(fit)
    fit["dropped_constant"] = dropped
    fit["screening"] = scr
    return fit, design


def run_rq4(spark: SparkSession, sf: str) -> dict:
    data = regression_inputs(spark, sf)
    scr = O.screen_features(data)  # of both fits
    log_fit, _ = fit_models(spark, sf, True, data, scr)
    lin_fit, _ = fit_models(spark, sf, False, data, scr)
    return {
        "coefficients": O.coefficient_table(spark, log_fit),
        "summary": O.fit_summary(spark, log_fit),
        "linear_summary": O.fit_summary(spark, lin_fit),
        "vif": spark.createDataFrame(log_fit["vif"], "feature string, vif double"),
        "diagnostics": spark.createDataFrame(
            [(m, float(f["jarque_bera"]["statistic"]), float(f["breusch_pagan"]["statistic"]),
              float(f["breusch_pagan"]["pvalue"]), float(f["durbin_watson"]))
             for m, f in (("log", log_fit), ("linear", lin_fit))],
            "model string, jarque_bera double, breusch_pagan_lm double, breusch_pagan_p double, "
            "durbin_watson double"),
        "fit": log_fit,
    }
