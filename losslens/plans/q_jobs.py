"""Catalog entries: jobs and sinks (E13, S4-S7, S12, S13), A17, A32, T15,
W16 and the external validation (E8-E11, M19-M21)."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from losslens.functions import dist

from losslens.operators import aggregates as A
from losslens.operators import concentration as C
from losslens.operators import external as EX
from losslens.operators import joins as J
from losslens.operators import model as M
from losslens.operators import trees as T
from losslens.operators import ols as O
from losslens.operators import quality as QL
from losslens.operators import reshape as R
from losslens.operators.ordered import group_quantiles
from losslens.operators.stats import kruskal, spearman
from losslens.plans import rq1, rq3
from losslens.plans.registry import featured_items, register, returned_items
from losslens.plans.q_aggregates import CUSTOMER_EROSION_SQL
from losslens.plans.q_external import _ACC_SQL, _PRE, _ext_sql, accounts, lines
from losslens.plans.q_ols import _run as rq4_run
from losslens.plans.sqlkit import with_features
from losslens.session import cut_lineage, ensure_checkpoint_dir
from losslens.sources import raw
from losslens.sources.adapter import ITEMS_SQL, items
from losslens.sources.external import EXTERNAL_LINES_SQL


def _scratch(spark, tag):
    return os.path.join(ensure_checkpoint_dir(spark), "jobs", f"{tag}-{uuid.uuid4().hex[:8]}")


register("s4_etl_item_table_roundtrip", "WITH " + ITEMS_SQL + """
SELECT category, count(*) AS n, sum(sale_price) AS sales FROM items GROUP BY category""", ["sales"])(
    lambda spark, sf: spark.read.parquet(rq1.build_analysis_dataset(spark, sf, _scratch(spark, "s4")))
    .groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("sale_price").alias("sales")))

_P2_SQL = "WITH " + ITEMS_SQL + """
SELECT CAST(order_item_id AS VARCHAR) AS order_item_id, CAST(order_id AS VARCHAR) AS order_id,
  CAST(product_id AS VARCHAR) AS product_id, sale_price, retail_price, cost, category FROM items"""
_P2_COLS = ["order_item_id", "order_id", "product_id", "sale_price", "retail_price", "cost", "category"]
register("p2_standard_types", _P2_SQL, ["sale_price", "retail_price", "cost"])(
    lambda spark, sf: raw.standardize_types(items(spark, sf, _P2_COLS).withColumn(
        "sale_price", F.col("sale_price").cast("string"))).select(*_P2_COLS))
_S1_DATES = ["item_shipped_at", "item_delivered_at", "item_returned_at", "order_created_at"]
register("s1_s2_csv_source", _P2_SQL.replace(" FROM items", ", " + ", ".join(_S1_DATES) + " FROM items"),
         ["sale_price", "retail_price", "cost"], ts=_S1_DATES)(lambda spark, sf: _csv_source(spark, sf))
register("s4_etl_csv_roundtrip", "WITH " + ITEMS_SQL + """
SELECT category, count(*) AS n, sum(sale_price) AS sales, max(item_returned_at) AS last_return FROM items GROUP BY category""",
         ["sales"], ts=["last_return"])(lambda spark, sf: _s4_csv(spark, sf))


def _s4_csv(spark, sf):
    """S4's CSV output, read back and typed."""
    path = rq1.build_analysis_dataset(spark, sf, _scratch(spark, "s4")) + ".csv"
    table = raw.standardize_types(raw.read_csv(spark, path, ["category", "sale_price", "item_returned_at"]))
    return table.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("sale_price").alias("sales"),
                                         F.max("item_returned_at").alias("last_return"))


register("p1_column_selection_report", "WITH " + ITEMS_SQL + """
SELECT 'retail_price' AS "column", 'dropped' AS status, CAST(0 AS BIGINT) AS n_values, CAST(0 AS DOUBLE) AS total
UNION ALL SELECT 'sale_price', 'kept', count(sale_price), sum(sale_price) FROM items
UNION ALL SELECT 'cost', 'kept', count(cost), sum(cost) FROM items
UNION ALL SELECT 'no_such_column', 'missing', 0, 0""", ["total"])(lambda spark, sf: _p1(spark, sf))


def _p1(spark, sf):
    """The report with the values that the selected rows hold."""
    table = items(spark, sf, ["retail_price", "sale_price", "cost"]).select("retail_price", "sale_price", "cost")
    rows, report = raw.select_columns(table, keep=["cost", "no_such_column", "sale_price"])
    held = rows.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("n_values"), F.sum(c).alias("total"))
                              for c in rows.columns]).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return report.join(held, ["column"], "left").select(
        "column", "status", F.coalesce("n_values", F.lit(0)).alias("n_values"), F.coalesce("total", F.lit(0.0)).alias("total"))


def _csv_source(spark, sf):
    """S1 + S2: the item table as CSV with a byte-order mark and blanks in its
    header, dates parsed by the reader, all else typed by P2."""
    path = _scratch(spark, "csv")
    cols = _P2_COLS + _S1_DATES
    items(spark, sf, cols).select(F.col(cols[0]).alias("\ufeff" + cols[0]), *[F.col(c).alias(f" {c} ") for c in cols[1:]]) \
        .write.option("header", True).option("compression", "gzip").csv(path)
    return raw.standardize_types(raw.read_csv(spark, path, cols, _S1_DATES)).select(*cols)


register("s6_split_flagged_review", with_features("""
SELECT count(*) FILTER (WHERE cost > sale_price OR sale_price > retail_price OR sale_price < 0 OR cost < 0)
       AS review_rows, count(*) AS cleaned_rows FROM f"""))(
    lambda spark, sf: _s6(spark, sf))


def _s6(spark, sf):
    flagged, _ = QL.validate_price_consistency(featured_items(spark, sf))
    p = rq1.save_cleaned(flagged, ["has_price_inconsistency"], _scratch(spark, "s6"))
    return spark.read.parquet(p["review"]).agg(F.count(F.lit(1)).alias("review_rows")).crossJoin(
        spark.read.parquet(p["cleaned"]).agg(F.count(F.lit(1)).alias("cleaned_rows")))


register("e13_rq1_job_tests", None)(lambda spark, sf: rq1.run_rq1(spark, sf, _scratch(spark, "rq1"))["summary"])

register("a17_customer_erosion_from_raw", with_features(CUSTOMER_EROSION_SQL),
         ["total_margin_reversal", "total_process_cost", "total_profit_erosion", "total_sales",
          "total_margin", "avg_erosion_per_return"])(
    lambda spark, sf: rq1.customer_erosion(
        featured_items(spark, sf).select("order_item_id", "order_id", "user_id", "item_status",
                                         "sale_price", "cost", "category")))

register("a32_external_return_types", _ext_sql("""
SELECT "Sales_Type" AS sales_type, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM ext GROUP BY 1"""), ["share"])(
    lambda spark, sf: A.value_distribution(
        lines(spark, sf).select(F.col("Sales_Type").alias("sales_type")), "sales_type"))

_CE = CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + ")"
_T15_DIST = """count(*) AS n, sum(e) AS total, quantile_cont(e, 0.5) AS median, quantile_cont(e, 0.9) AS p90,
  quantile_cont(e, 0.99) AS p99, max(e) AS max, (SELECT sum(s) FROM (SELECT sum(e) AS s FROM {0} GROUP BY category
  ORDER BY s DESC, category LIMIT 10)) / sum(e) AS top10_category_share"""
register("t15_replication_distributions", with_features(EXTERNAL_LINES_SQL.strip() + ",\n" + _PRE + """,
pr AS (SELECT profit_erosion AS e, category FROM f WHERE is_returned_item = 1 AND profit_erosion IS NOT NULL),
ex AS (SELECT total_loss_abs AS e, concat_ws('-', trim(coalesce(CAST("Pillar" AS VARCHAR), 'Unknown')),
       trim(coalesce(CAST("Major Market Cat" AS VARCHAR), 'Unknown')),
       trim(coalesce(CAST("Department" AS VARCHAR), 'Unknown'))) AS category
       FROM pre WHERE "Returns" AND total_loss_abs IS NOT NULL),
d AS (SELECT 'primary' AS dataset, """ + _T15_DIST.format("pr") + """ FROM pr
      UNION ALL SELECT 'external', """ + _T15_DIST.format("ex") + """ FROM ex)
SELECT *, p99 > median AS heavy_tail, top10_category_share > 0.25 AS concentrated FROM d"""),
         ["total", "median", "p90", "p99", "max", "top10_category_share"])(lambda spark, sf: _t15(spark, sf))


def _returned_sets(spark, sf):
    """Returned items of both sets as (profit_erosion, category)."""
    columns = ["profit_erosion", "category"]
    return {"primary": returned_items(spark, sf, with_orders=False).select(*columns),
            "external": EX.canonical_base(lines(spark, sf)).where("is_returned_item = 1").select(*columns)}


def _t15(spark, sf):
    """A22 of the returned items, and the share of the ten categories
    with the largest erosion, on both sets."""
    out = None
    for name, d in _returned_sets(spark, sf).items():
        d = d.where(F.col("profit_erosion").isNotNull())
        by = d.groupBy("category").agg(F.sum("profit_erosion").alias("s"))
        top = R.top_k(by, "s", 10, "category").agg(F.sum("s").alias("_top"))
        q = group_quantiles(d, [], [("median", "profit_erosion", 0.5), ("p90", "profit_erosion", 0.9),
                                    ("p99", "profit_erosion", 0.99)])
        row = (d.agg(F.count(F.lit(1)).alias("n"), F.sum("profit_erosion").alias("total"),
                     F.max("profit_erosion").alias("max")).crossJoin(q).crossJoin(top)  # one row each
               .select(F.lit(name).alias("dataset"), "n", "total", "median", "p90", "p99", "max",
                       (F.col("_top") / F.col("total")).alias("top10_category_share")))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("heavy_tail", F.col("p99") > F.col("median")) \
              .withColumn("concentrated", F.col("top10_category_share") > 0.25)


def _t15_verdict(spark, sf):
    """T15 verdict: heavy tail, concentration and a significant category test
    on both sets give PASS, anything less PARTIAL."""
    p = {name: kruskal(d, "category", "profit_erosion")["p_value"] for name, d in _returned_sets(spark, sf).items()}
    both = _t15(spark, sf).agg(F.min("heavy_tail").alias("heavy_tail"), F.min("concentrated").alias("concentrated"))
    tested = both.withColumn("p_primary", F.lit(float(p["primary"]))).withColumn("p_external", F.lit(float(p["external"])))
    return tested.withColumn("category_differences", (F.col("p_primary") < 0.05) & (F.col("p_external") < 0.05)) \
        .withColumn("verdict", F.when(F.col("heavy_tail") & F.col("concentrated") & F.col("category_differences"), "PASS")
                    .otherwise("PARTIAL"))


register("t15_replication_verdict", None)(_t15_verdict)


register("w16_cumulative_abs_t", None)(
    lambda spark, sf: C.cumulative_contribution(
        rq4_run(spark, sf)["coefficients"].where("feature <> 'const'"), "t_stat", "feature"))

# ---------------------------------------------------------------- external validation
_EXT_FEATS = ["return_frequency", "avg_basket_size", "purchase_recency_days", "order_frequency",
              "avg_order_value", "customer_tenure_days", "customer_return_rate"]


def _ext_fit(spark, sf, log_transform=True):
    """Least squares on the external accounts; v1 is linear on zero-filled
    features, v2 log-linear on median-filled ones with the modal department."""
    fill = "median" if log_transform else "zero"
    acc = EX.regression_features(accounts(spark, sf), _EXT_FEATS, fill)
    categories = []
    if log_transform:
        modal = J.dominant_value(lines(spark, sf).select(F.col("`Bill To Act #`").alias("account_id"), "Department"),
                                 "account_id", "Department", "dominant_department")
        acc, categories = acc.join(modal, ["account_id"], "left"), ["dominant_department"]
    design, names, _ = O.prepare_regression_data(acc, "total_profit_erosion", _EXT_FEATS, categories, log_transform,
                                                 "account_id")
    return O.fit_ols_hc3(design, names)


register("e8_coefficient_alignment", None)(
    lambda spark, sf: O.coefficient_alignment(rq4_run(spark, sf)["coefficients"],
                                              O.coefficient_table(spark, _ext_fit(spark, sf))))
register("e9_effect_size_generalisation", None)(
    lambda spark, sf: O.effect_size_generalisation(rq4_run(spark, sf)["coefficients"],
                                                   O.coefficient_table(spark, _ext_fit(spark, sf))))


def _e10(spark, sf):
    """Fit summary of both external runs, with the largest VIF."""
    out = None
    for name, log in (("v1 linear", False), ("v2 log-linear", True)):
        fit = _ext_fit(spark, sf, log)
        row = O.fit_summary(spark, fit).withColumn("run", F.lit(name)).withColumn(
            "max_vif", F.lit(float(max(v for _, v in O.vif_table(fit)))))
        out = row if out is None else out.unionByName(row)
    return out


register("e10_e11_external_ols_summary", None)(_e10)


def _pattern(spark, sf, prim):
    """Screen the candidates that both sets have on all external accounts
    and compare with the primary report."""
    acc = accounts(spark, sf)
    shared = [c for c in M.RQ3_CANDIDATE_FEATURES if c in acc.columns]
    ext = M.prepare_modeling_data(EX.targets(acc), shared, id_col="account_id", leakage=[], impute_scope="all")
    _, ext_rep = M.screen_features(ext, shared)
    survivors, prim_rep = M.screen_features(prim.where("is_test = 0"), M.RQ3_CANDIDATE_FEATURES)
    both = J.compare_reports(prim_rep.select("feature", "final_status"), ext_rep.select("feature", "final_status")).where(
        F.col("final_status_external").isNotNull())
    same = F.col("final_status_primary") == F.col("final_status_external")
    return survivors, both.withColumn("both_pass", same & (F.col("final_status_primary") == "selected")) \
        .withColumn("both_fail", same & (F.col("final_status_primary") == "dropped")).withColumn("agreement", same)


register("m19_pattern_validation", None)(lambda spark, sf: _pattern(spark, sf, rq3.prepared(spark, sf))[1])


def _directional(spark, sf, survivors):
    """External accounts scored by the primary forest on its own features
    (missing ones 0, nulls the external median); carries the accounts' actual
    loss.  Trees cut the features as they are, so no scaling is needed."""
    data = rq3.single_scenario(rq3.customer_targets(spark, sf), survivors)
    best = M.forest_grids(data, {"primary": (0, survivors)})["primary"]
    acc = EX.targets(accounts(spark, sf))
    filled = EX.regression_features(acc.withColumn("actual_loss", F.col("total_loss")), survivors, "median")
    ext = cut_lineage(filled.select("account_id", "actual_loss", F.array(F.col("is_high_erosion_customer").cast("int"))
                                    .alias("labels"), F.array(F.lit(T.TEST)).alias("parts"),
                                    *[F.col(c).cast("double").alias(c) for c in survivors]))
    scored = M.forest_scores(data, 0, survivors, best["point"], T.bin_rows(ext, "account_id", survivors, data.edges))
    out = scored.select(F.col("id").alias("account_id"), F.col("label").alias("actual_high_loss"),
                        F.col("score").alias("predicted_probability"))
    return (ext.select("account_id", "actual_loss").join(out, "account_id")
            .select("account_id", "actual_loss", "actual_high_loss",
                    (F.col("predicted_probability") > 0.5).cast("int").alias("predicted_high_risk"), "predicted_probability"))


def validation_summary(spark, pattern, predictions, n_available, n_missing):
    """The 13 metrics of the pattern table and the scored accounts."""
    p = pattern.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col(c).cast("int")), F.lit(0)).alias(c)
                                                    for c in ("agreement", "both_pass", "both_fail")]).first()
    d = predictions.agg(F.count(F.lit(1)).alias("n"),
                        F.avg((F.col("actual_high_loss") == F.col("predicted_high_risk")).cast("double")).alias("acc"),
                        F.avg("predicted_high_risk").alias("ph"), F.avg("actual_high_loss").alias("ah"),
                        (F.min("predicted_probability") < F.max("predicted_probability")).alias("scores_vary"),
                        (F.min("actual_loss") < F.max("actual_loss")).alias("losses_vary")).first()
    rho = None  # not defined where one side is constant
    if d["scores_vary"] and d["losses_vary"]:
        rho = spearman(predictions, "predicted_probability", "actual_loss", "account_id").first()["spearman"]
    n = d["n"]
    pv = None
    if rho is not None and n > 2:
        pv = 0.0 if abs(rho) >= 1 else float(dist.t_sf2(rho * math.sqrt((n - 2) / (1 - rho * rho)), n - 2))
    rows = [("pattern_features_compared", p["n"]), ("pattern_agreement_count", p["agreement"]),
            ("pattern_agreement_pct", round(p["agreement"] / p["n"] * 100, 1) if p["n"] else 0),
            ("pattern_both_pass", p["both_pass"]), ("pattern_both_fail", p["both_fail"]),
            ("directional_accuracy", round(d["acc"] or 0.0, 4)),
            ("directional_rank_correlation", None if rho is None else round(rho, 4)), ("directional_rank_pvalue", pv),
            ("accounts_evaluated", n), ("features_available", n_available), ("features_missing", n_missing),
            ("predicted_high_risk_pct", round((d["ph"] or 0.0) * 100, 1)),
            ("actual_high_loss_pct", round((d["ah"] or 0.0) * 100, 1))]
    return spark.createDataFrame([(m, None if v is None else float(v)) for m, v in rows], "metric string, value double")


def _m20(spark, sf):
    prim = rq3.prepared(spark, sf)
    survivors, _ = M.screen_features(prim.where("is_test = 0"), M.RQ3_CANDIDATE_FEATURES)
    return _directional(spark, sf, survivors)


def _m21(spark, sf):
    prim = rq3.prepared(spark, sf)
    survivors, pattern = _pattern(spark, sf, prim)
    predictions = cut_lineage(_directional(spark, sf, survivors))
    have = [c for c in survivors if c in accounts(spark, sf).columns]
    return validation_summary(spark, pattern, predictions, len(have), len(survivors) - len(have))


register("m20_external_predictions", None)(_m20)
register("m20_m21_directional_validation", None)(_m21)


# ---------------------------------------------------------------- Q-7, S5, S7
register("q7_deep_clean_report", None)(
    lambda spark, sf: QL.deep_clean(
        featured_items(spark, sf, ["item_shipped_at", "item_delivered_at", "item_returned_at"]),
        variance_threshold=0.01)[1])


def _s5_s7(spark, sf):
    """S5 + S7: write the feature table and the three model-ready views
    (item classification, returned-item regression, customer segmentation)
    and read the row counts back."""
    from losslens.operators import features as FE
    out = _scratch(spark, "views")
    f = featured_items(spark, sf, ["item_returned_at", "age", "country", "traffic_source"])
    views = {"feature_table": lambda f: f,
             "rq3_item_classification": FE.item_return_classification_base,
             "rq4_returned_item_regression": FE.returned_item_regression_base,
             "rq2_customer_segmentation": lambda f: A.rq2_customer_segmentation_base(f.drop("profit_erosion"))}
    rows = []
    for name, view in views.items():
        p = os.path.join(out, name)
        view(f).write.mode("overwrite").option("compression", "zstd").parquet(p)
        if name == "feature_table":  # the items are joined once, the views read this table
            f = spark.read.schema(f.schema).parquet(p)
        rows.append((name, spark.read.parquet(p).count()))
    return spark.createDataFrame(rows, "view string, rows long")


register("s5_s7_write_model_views", with_features("""
SELECT 'feature_table' AS view, count(*) AS rows FROM f UNION ALL
SELECT 'rq3_item_classification', count(*) FROM f UNION ALL
SELECT 'rq4_returned_item_regression', count(*) FROM f WHERE is_returned_item = 1 UNION ALL
SELECT 'rq2_customer_segmentation', count(DISTINCT user_id) FROM f"""))(_s5_s7)


register("m10_m14_ablation_studies", None)(rq3.ablation_studies)
register("m10_m13_ablation_features", None)(rq3.ablation_features)


def _s9_s11(spark, sf):
    out = _scratch(spark, "external")
    paths = rq1.build_external_artifacts(spark, sf, out)
    tp = os.path.join(out, "customer_targets")
    rq3.customer_targets(spark, sf).write.mode("overwrite").parquet(tp)
    t = rq1.load_customer_targets(spark, tp)
    rows = [(k, spark.read.parquet(v).count()) for k, v in paths.items()] + [("customer_targets", t.count())]
    return spark.createDataFrame(rows, "artifact string, rows long")


register("s9_s11_external_artifacts_and_targets", None)(_s9_s11)
