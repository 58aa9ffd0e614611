"""RQ2 job (C10): concentration of erosion and customer segments.

features (RFM) -> customer erosion -> Gini / Pareto / top-20% share ->
segmentation table (behaviour LEFT erosion) -> returner population ->
screening -> z-scores -> one K-Means fit per k -> k choice -> labels
(joined back by id, D3 fixed) -> cluster summary + tests.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.operators import aggregates as A
from losslens.operators import concentration as C
from losslens.operators import joins as J
from losslens.operators import segment as SG
from losslens.operators import stats as S
from losslens.plans.registry import featured_items, returned_items
from losslens.session import cut_lineage
from losslens.sources.adapter import first_orders

SEG_FEATURES = ["total_items_purchased", "avg_order_value", "avg_basket_size", "order_frequency",
                "customer_return_rate", "customer_tenure_days", "purchase_recency_days",
                "total_sales", "total_margin"]


def behavior(spark: SparkSession, sf: str) -> DataFrame:
    f = featured_items(spark, sf, ["order_created_at"])
    return A.customer_behavioral_features(f, customers=first_orders(spark, sf)).withColumnRenamed(
        "total_items", "total_items_purchased")


def segmentation_table(spark: SparkSession, sf: str) -> DataFrame:
    ero = A.profit_erosion_by_customer(returned_items(spark, sf)).select(
        "user_id", "total_profit_erosion", "returned_items", "total_margin_reversal")
    return J.customer_segmentation_table(behavior(spark, sf), ero)


def returners(spark: SparkSession, sf: str) -> DataFrame:
    # customer-grain stage boundary (reliable checkpoint in the shared folder)
    return cut_lineage(segmentation_table(spark, sf).where(F.col("returned_items") > 0))


def scaled_returners(spark: SparkSession, sf: str, cols=None):
    pop = returners(spark, sf)
    x, used = SG.select_numeric_features(pop, cols or SEG_FEATURES)
    return SG.standardize(x, used, ddof=0, keep=["user_id"]), used, pop


def clustered(spark: SparkSession, sf: str, k: int = 3, seed: int = 42) -> DataFrame:
    z, used, pop = scaled_returners(spark, sf)
    lab = SG.kmeans_fit_predict(z, used, k, seed).select("user_id", "cluster_id")
    out = pop.join(lab, ["user_id"], "inner")  # labels joined back by id (D3)
    return SG.relabel_by(out, "total_profit_erosion")


def run_rq2(spark: SparkSession, sf: str, k_values=range(1, 9), out_dir: str | None = None,
            seed: int = 42) -> dict:
    cust = A.profit_erosion_by_customer(returned_items(spark, sf))
    gini = C.gini(cust, "total_profit_erosion").first()["gini"]
    top20 = C.top_share(cust, "total_profit_erosion", 0.2).first()["top_share"]
    total = cust.agg(F.sum("total_profit_erosion")).first()[0]
    pop = returners(spark, sf)
    x, used = SG.select_numeric_features(pop, SEG_FEATURES)
    survivors, screen = SG.screen_clustering_features(x, used)
    z = SG.standardize(x, survivors, ddof=0, keep=["user_id"])
    diag = SG.diagnostics_over_k(z, survivors, list(k_values), seed)
    k = SG.choose_k_silhouette(diag)
    lab = SG.kmeans_fit_predict(z, survivors, k, seed).select("user_id", "cluster_id")
    seg = SG.relabel_by(pop.join(lab, ["user_id"], "inner"), "total_profit_erosion")
    summary = SG.summarize_clusters(seg)
    tests = S.cluster_test_bundle(seg, "cluster_id", "total_profit_erosion")
    meta = {"total_erosion": total, "gini": gini, "top_20_share": top20, "k": k,
            "features": survivors}
    res = {"diagnostics": diag, "screening": screen, "summary": summary, "tests": tests,
           "segments": seg, "meta": meta}
    if out_dir:
        for name in ("diagnostics", "screening", "summary", "tests"):
            res[name].write.mode("overwrite").option("header", True).csv(
                os.path.join(out_dir, name))
        seg.write.mode("overwrite").parquet(os.path.join(out_dir, "segments"))
        spark.createDataFrame([(json.dumps(meta, default=float),)], "json string") \
            .write.mode("overwrite").text(os.path.join(out_dir, "rq2_summary"))
    return res
