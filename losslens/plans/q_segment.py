"""Catalog entries: segmentation (C-rows), cluster tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators.concentration import relative_drop
from losslens.operators import segment as SG
from losslens.operators import stats as S
from losslens.plans import rq2, rq3
from losslens.plans.registry import register
from losslens.plans.q_aggregates import CUSTOMER_EROSION_SQL, RFM_SQL_CTE
from losslens.plans.q_model import targets_sql
from losslens.plans.sqlkit import with_features
from losslens.session import cut_lineage

_CE = CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + ")"
_POP = RFM_SQL_CTE.strip().lstrip(",") + ",\n" + _CE + """,
pop AS (SELECT r.user_id, r.total_items AS total_items_purchased, r.avg_order_value, r.avg_basket_size,
        r.order_frequency, r.customer_return_rate, r.customer_tenure_days, r.purchase_recency_days,
        r.total_sales, r.total_margin, coalesce(ce.total_profit_erosion, 0.0) AS total_profit_erosion,
        coalesce(ce.returned_items, 0) AS returned_items
        FROM rfm r LEFT JOIN ce ON r.user_id = ce.user_id WHERE coalesce(ce.returned_items, 0) > 0)"""
_F = rq2.SEG_FEATURES

register("c1_standardized_features", with_features(_POP + """,
st AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _F) + """ FROM pop)
SELECT user_id, """ + ", ".join(
    f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END AS {c}" for c in _F) +
    " FROM pop CROSS JOIN st"), _F)(
    lambda spark, sf: rq2.scaled_returners(spark, sf)[0])

register("c9_variance_gate", with_features(_POP + """,
v AS (SELECT """ + ", ".join(f"var_pop(CAST({c} AS DOUBLE)) AS {c}" for c in _F) + """ FROM pop)
SELECT feature, variance, variance > 0.01 AS variance_pass
FROM (UNPIVOT v ON """ + ", ".join(_F) + """ INTO NAME feature VALUE variance)"""), ["variance"],
         scale={"variance": 8})(
    lambda spark, sf: SG.screen_clustering_features(
        SG.select_numeric_features(rq2.returners(spark, sf), _F)[0], _F)[1]
    .select("feature", "variance", "variance_pass"))

register("c9_feature_screening", None)(
    lambda spark, sf: SG.screen_clustering_features(
        SG.select_numeric_features(rq2.returners(spark, sf), _F)[0], _F)[1])

register("p14_validate_clustering_matrix", None)(
    lambda spark, sf: SG.validate_matrix(*SG.select_numeric_features(rq2.returners(spark, sf), _F)))


def _diag(spark, sf):
    z, used, _ = rq2.scaled_returners(spark, sf)
    return SG.diagnostics_over_k(z, used, list(range(1, 9)))


register("c3_c6_diagnostics_over_k", None)(_diag)
register("c7_c8_k_choice", None)(
    lambda spark, sf: (lambda d: spark.createDataFrame(
        [(SG.choose_k_silhouette(d), SG.choose_k_robust(d))], "k_silhouette int, k_robust int"))(
        _diag(spark, sf)))
register("w15_relative_inertia_drop", None)(
    lambda spark, sf: relative_drop(_diag(spark, sf)))

# cluster operators on labels that SQL has too: the loss quartiles of the modelled customers
_Z = ["total_sales", "order_frequency", "avg_order_value", "purchase_recency_days"]
register("c4_silhouette_by_quartile", targets_sql(", z AS (SELECT user_id, CAST(profit_erosion_quartile AS INTEGER) AS k, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z{i}" for i, c in enumerate(_Z)) + " FROM tg),\n"
    "d AS (SELECT x.user_id, x.k, y.k AS other, count(*) AS n, sum(sqrt(" + " + ".join(
    f"(x.z{i} - y.z{i}) ^ 2" for i in range(len(_Z))) + """)) AS s FROM z x CROSS JOIN z y GROUP BY ALL),
s AS (SELECT user_id, max(CASE WHEN other = k AND n > 1 THEN s / (n - 1) END) AS own,
      min(CASE WHEN other <> k THEN s / n END) AS near FROM d GROUP BY user_id)
SELECT avg(CASE WHEN own IS NULL OR greatest(own, near) = 0 THEN 0.0 ELSE (near - own) / greatest(own, near) END)
       AS silhouette FROM s"""), ["silhouette"], scale={"silhouette": 0})(lambda spark, sf: _quartile_silhouette(spark, sf))


def _quartile_silhouette(spark, sf):
    t = rq3.customer_targets(spark, sf).withColumn("label", F.col("profit_erosion_quartile").cast("int") - 1)
    z = cut_lineage(SG.standardize(t, _Z, keep=["user_id", "label"]))
    return spark.createDataFrame([(SG.silhouettes(z, _Z, {"label": 4}, "user_id")["label"],)], "silhouette double")


register("a20_cluster_summary_by_quartile", targets_sql("""
SELECT profit_erosion_quartile AS quartile, count(*) AS "Count", round_even(sum(total_profit_erosion), 2) AS "Total_Erosion",
  round_even(avg(total_profit_erosion), 2) AS "Mean_Erosion",
  round_even(quantile_cont(total_profit_erosion, 0.5), 2) AS "Median_Erosion" FROM tg GROUP BY 1"""),
         ['"Total_Erosion"', '"Mean_Erosion"', '"Median_Erosion"'], ints=["quartile"])(
    lambda spark, sf: SG.summarize_clusters(rq3.customer_targets(spark, sf).withColumn(
        "quartile", F.col("profit_erosion_quartile").cast("int")), "quartile"))

register("a21_cluster_profiles_by_quartile", targets_sql(", u AS (" + " UNION ALL ".join(
    f"SELECT profit_erosion_quartile AS quartile, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM tg" for c in _Z) + """)
SELECT quartile, feature, avg(x) AS mean, quantile_cont(x, 0.5) AS median, stddev_samp(x) AS std FROM u GROUP BY ALL"""),
         ["mean", "median", "std"], ints=["quartile"], scale={"mean": 0, "median": 0, "std": 0})(
    lambda spark, sf: SG.cluster_profiles(rq3.customer_targets(spark, sf).withColumn(
        "quartile", F.col("profit_erosion_quartile").cast("int")), _Z, "quartile"))

register("c2_kmeans_segments", None)(lambda spark, sf: SG.summarize_clusters(rq2.clustered(spark, sf, 3)))
register("a20_cluster_summary", None)(lambda spark, sf: SG.summarize_clusters(rq2.clustered(spark, sf, 2)))
register("a21_cluster_profiles", None)(
    lambda spark, sf: SG.cluster_profiles(rq2.clustered(spark, sf, 3), _F))
register("t10_cluster_test_bundle", None)(
    lambda spark, sf: S.cluster_test_bundle(rq2.clustered(spark, sf, 3), "cluster_id",
                                            "total_profit_erosion"))
register("t10_cluster_pairwise_t", None)(
    lambda spark, sf: S.pairwise_t_bonferroni(rq2.clustered(spark, sf, 3), "cluster_id",
                                              "total_profit_erosion"))
register("t11_feature_separation", None)(
    lambda spark, sf: S.add_f_pvalues(S.feature_separation(rq2.clustered(spark, sf, 3), "cluster_id", _F)))
register("c10_rq2_job", None)(
    lambda spark, sf: (lambda r: spark.createDataFrame(
        [(float(r["meta"]["total_erosion"]), float(r["meta"]["gini"]), float(r["meta"]["top_20_share"]),
          int(r["meta"]["k"]))], "total_erosion double, gini double, top_20_share double, k int"))(
        rq2.run_rq2(spark, sf)))
