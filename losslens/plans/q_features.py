"""Catalog entries: row-level features (P-rows), views, joins (J), reshape (U, K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.functions.exprs import DEFAULT_COST_COMPONENTS
from losslens.operators.sensitivity import SENSITIVITY_BASE_COSTS, erosion_under_costs
from losslens.operators import aggregates as A
from losslens.operators import features as FE
from losslens.operators import joins as J
from losslens.operators import reshape as R
from losslens.plans.registry import featured_items, register, returned_items
from losslens.plans.q_aggregates import CUSTOMER_EROSION_SQL, RFM_SQL_CTE, rfm
from losslens.plans.sqlkit import FEATURES_SQL, tier_case_sql, with_features
from losslens.sources.adapter import DRIVER_TIERS, items

_FEAT = ["is_returned_item", "is_returned_order", "discount_amount", "discount_pct", "item_margin",
         "item_margin_pct", "margin_reversal", "process_cost", "profit_erosion"]
register("p3_p4_p5_item_features", with_features("SELECT order_item_id, " + ", ".join(_FEAT) + " FROM f"),
         ["discount_amount", "discount_pct", "item_margin", "item_margin_pct", "margin_reversal",
          "process_cost", "profit_erosion"])(
    lambda spark, sf: featured_items(spark, sf).select("order_item_id", *_FEAT))

register("p5_flat_cost_by_category", with_features("""
SELECT category, sum(item_margin + CAST(12.0 AS DOUBLE)) AS total_profit_erosion_flat,
       sum(process_cost) AS total_process_cost_tiered
FROM f WHERE is_returned_item = 1 AND category IS NOT NULL GROUP BY category"""),
         ["total_profit_erosion_flat", "total_process_cost_tiered"])(
    lambda spark, sf: _flat(spark, sf))


def _flat(spark, sf):
    r = returned_items(spark, sf)
    flat = FE.calculate_profit_erosion(r.drop("margin_reversal", "process_cost", "profit_erosion"),
                                       use_category_tiers=False)
    return flat.groupBy("category").agg(
        F.sum("profit_erosion").alias("total_profit_erosion_flat")).join(
        r.groupBy("category").agg(F.sum("process_cost").alias("total_process_cost_tiered")), ["category"])


# Components scaled to each base cost, erosion per customer for all costs in one job
_COSTS = [sum(FE.scale_cost_components(DEFAULT_COST_COMPONENTS, c).values()) for c in SENSITIVITY_BASE_COSTS]
register("p5b_scaled_cost_erosion", with_features(
    "c AS (SELECT * FROM (VALUES " + ", ".join(f"(CAST({c} AS DOUBLE))" for c in _COSTS) +
    ") v(base_cost))\nSELECT base_cost, user_id, sum(item_margin + base_cost * " + tier_case_sql() +
    ") AS total_profit_erosion FROM f CROSS JOIN c WHERE is_returned_item = 1 GROUP BY base_cost, user_id"),
         ["base_cost", "total_profit_erosion"])(
    lambda spark, sf: _scaled(spark, sf))


def _scaled(spark, sf):
    return erosion_under_costs(returned_items(spark, sf), _COSTS, DRIVER_TIERS).select(
        "base_cost", "user_id", "total_profit_erosion")


_TEMP = ["order_day_of_week", "order_month", "order_quarter", "order_year", "is_weekend_order",
         "season", "days_to_delivery", "days_to_return"]
register("p6_temporal_features", with_features("""
SELECT order_item_id, CAST(isodow(order_created_at) - 1 AS INTEGER) AS order_day_of_week,
  month(order_created_at) AS order_month, quarter(order_created_at) AS order_quarter,
  year(order_created_at) AS order_year, isodow(order_created_at) - 1 IN (5, 6) AS is_weekend_order,
  CASE WHEN month(order_created_at) IN (12, 1, 2) THEN 'winter' WHEN month(order_created_at) IN (3, 4, 5)
       THEN 'spring' WHEN month(order_created_at) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
  CAST(floor((epoch_us(item_delivered_at) - epoch_us(order_created_at)) / 86400000000) AS BIGINT) AS days_to_delivery,
  CAST(floor((epoch_us(item_returned_at) - epoch_us(item_delivered_at)) / 86400000000) AS DOUBLE) AS days_to_return
FROM f"""), ["days_to_return"], ints=["order_day_of_week", "order_month", "order_quarter", "order_year"])(
    lambda spark, sf: FE.engineer_temporal_features(
        featured_items(spark, sf, ["order_created_at", "item_delivered_at", "item_returned_at"]))
    .select("order_item_id", *_TEMP))

register("p9_p11_ensure_views", with_features("""
SELECT order_item_id, CAST(item_returned_at IS NOT NULL AS INTEGER) AS is_returned_item,
       sale_price - cost AS item_margin,
       CASE WHEN item_returned_at IS NOT NULL THEN sale_price - cost ELSE 0.0 END AS profit_erosion
FROM items"""), ["item_margin", "profit_erosion"], ints=["is_returned_item"])(
    lambda spark, sf: FE.ensure_profit_erosion(
        items(spark, sf, ["order_item_id", "item_returned_at", "sale_price", "cost"]))
    .select("order_item_id", "is_returned_item", "item_margin", "profit_erosion"))

register("p12_p21_item_classification_base", with_features("""
SELECT order_item_id, is_returned_item, sale_price, cost, category FROM f"""),
         ["sale_price", "cost"], ints=["is_returned_item"])(
    lambda spark, sf: FE.item_return_classification_base(
        featured_items(spark, sf, ["item_returned_at"]))
    .select("order_item_id", "is_returned_item", "sale_price", "cost", "category"))

register("p22_returned_item_regression_base", with_features("""
SELECT order_item_id, category, sale_price, profit_erosion FROM f
WHERE is_returned_item = 1 AND profit_erosion IS NOT NULL"""), ["sale_price", "profit_erosion"])(
    lambda spark, sf: FE.returned_item_regression_base(
        featured_items(spark, sf, ["item_returned_at", "order_created_at"]))
    .select("order_item_id", "category", "sale_price", "profit_erosion"))

register("p20_customer_modeling_dataset", with_features("""
SELECT user_id, count(*) AS return_rows, sum(profit_erosion) AS total_profit_erosion,
       avg(profit_erosion) AS avg_profit_erosion_per_return, CAST(count(*) > 0 AS INTEGER) AS has_returns
FROM f WHERE is_returned_item = 1 AND user_id IS NOT NULL GROUP BY user_id"""),
         ["total_profit_erosion", "avg_profit_erosion_per_return"], ints=["has_returns"])(
    lambda spark, sf: FE.build_customer_modeling_dataset(
        A.customer_profit_erosion_summaries(featured_items(spark, sf)), "return_rows"))

# ---------------------------------------------------------------- J1
_J1 = ["order_item_id", "order_id", "user_id", "product_id", "item_status", "order_status",
       "sale_price", "retail_price", "cost", "category", "brand", "department", "country", "state",
       "traffic_source", "age"]
register("j1_item_table", with_features("SELECT " + ", ".join(_J1) +
                                       ", CAST(user_created_at AS VARCHAR) AS user_created_at FROM items"),
         ["sale_price", "retail_price", "cost", "age"])(
    lambda spark, sf: items(spark, sf, _J1 + ["user_created_at"])
    .withColumn("user_created_at", F.date_format("user_created_at", "yyyy-MM-dd HH:mm:ss")))

# ---------------------------------------------------------------- J3 / J5
_CE = CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + ")"
register("j3_customer_segmentation_table", with_features(
    RFM_SQL_CTE.strip().lstrip(",") + ",\n" + _CE + """
SELECT r.user_id, r.order_frequency, r.customer_return_rate,
       coalesce(ce.total_profit_erosion, 0.0) AS total_profit_erosion,
       coalesce(ce.returned_items, 0) AS returned_items
FROM rfm r LEFT JOIN ce ON r.user_id = ce.user_id"""),
         ["customer_return_rate", "total_profit_erosion"])(
    lambda spark, sf: J.customer_segmentation_table(
        rfm(spark, sf).select("user_id", "order_frequency", "customer_return_rate"),
        A.profit_erosion_by_customer(returned_items(spark, sf))
        .select("user_id", "total_profit_erosion", "returned_items")))

register("j5_behavior_inner_erosion", with_features(
    RFM_SQL_CTE.strip().lstrip(",") + ",\n" + _CE + """
SELECT r.user_id, r.order_frequency, ce.total_profit_erosion FROM rfm r JOIN ce ON r.user_id = ce.user_id"""),
         ["total_profit_erosion"])(
    lambda spark, sf: rfm(spark, sf).select("user_id", "order_frequency").join(
        A.profit_erosion_by_customer(returned_items(spark, sf)).select("user_id", "total_profit_erosion"),
        ["user_id"], "inner"))

# ---------------------------------------------------------------- J4
register("j4_product_modeling_dataset", with_features("""
SELECT category, count(*) AS item_rows, CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
       sum(is_returned_item) / count(*) AS return_rate,
       sum(profit_erosion) FILTER (WHERE is_returned_item = 1) AS total_profit_erosion,
       count(*) AS item_rows_returns, CAST(sum(is_returned_item) AS BIGINT) AS returned_items_returns
FROM f WHERE category IS NOT NULL GROUP BY category HAVING count(*) >= 200
   AND sum(profit_erosion) FILTER (WHERE is_returned_item = 1) IS NOT NULL"""),
         ["return_rate", "total_profit_erosion"])(
    lambda spark, sf: _j4(spark, sf))


def _j4(spark, sf):
    f = featured_items(spark, sf, with_orders=False)
    ero = A.erosion_level(A.product_profit_erosion_metrics(f), "category").select(
        "category", "item_rows", "returned_items", "return_rate", "total_profit_erosion")
    beh = A.return_rates_by_group(f, ["category"], 200)
    return J.product_modeling_dataset(ero, beh, "category").select(
        F.col("category"), F.col("item_rows_erosion").alias("item_rows"),
        F.col("returned_items_erosion").alias("returned_items"), "return_rate",
        "total_profit_erosion", "item_rows_returns", "returned_items_returns")


# ---------------------------------------------------------------- A16 / J9
register("j9_dominant_return_category", with_features("""
, c AS (SELECT user_id, category, count(*) AS n FROM f WHERE is_returned_item = 1
        AND user_id IS NOT NULL AND category IS NOT NULL GROUP BY ALL),
d AS (SELECT user_id, arg_min(category, (-n, category)) AS dominant_return_category FROM c GROUP BY 1)
SELECT r.user_id, d.dominant_return_category FROM (SELECT DISTINCT user_id FROM f) r
LEFT JOIN d ON r.user_id = d.user_id"""))(
    lambda spark, sf: _j9(spark, sf))


def _j9(spark, sf):
    f = featured_items(spark, sf)
    d = J.dominant_value(f.where(F.col("is_returned_item") == 1), "user_id", "category",
                         "dominant_return_category")
    return f.select("user_id").distinct().join(d, ["user_id"], "left")


# ---------------------------------------------------------------- J10 / J11
register("j10_attach_item_erosion", with_features("""
SELECT f.order_item_id, coalesce(r.profit_erosion, 0.0) AS profit_erosion FROM f
LEFT JOIN (SELECT order_item_id, profit_erosion FROM f WHERE is_returned_item = 1) r
  ON f.order_item_id = r.order_item_id"""), ["profit_erosion"])(
    lambda spark, sf: J.attach_own_erosion(featured_items(spark, sf, with_orders=False)).select(
        "order_item_id", "profit_erosion"))

register("j11_keep_large_brands", with_features("""
SELECT brand, count(*) AS n FROM f WHERE brand IN
  (SELECT brand FROM f GROUP BY brand HAVING count(*) >= 2400) GROUP BY brand"""))(
    lambda spark, sf: J.keep_large_groups(featured_items(spark, sf, with_orders=False), "brand", 2400)
    .groupBy("brand").agg(F.count(F.lit(1)).alias("n")))

# ---------------------------------------------------------------- K / U
register("k2_top10_categories_by_erosion", with_features("""
SELECT category, sum(profit_erosion) AS total_profit_erosion FROM f WHERE is_returned_item = 1
GROUP BY category ORDER BY total_profit_erosion DESC, category LIMIT 10"""), ["total_profit_erosion"])(
    lambda spark, sf: R.top_k(returned_items(spark, sf, with_orders=False).groupBy("category").agg(
        F.sum("profit_erosion").alias("total_profit_erosion")), "total_profit_erosion", 10, "category"))

register("k3_largest_brand_groups", with_features("""
, t AS (SELECT brand FROM f GROUP BY brand ORDER BY count(*) DESC, brand LIMIT 12)
SELECT brand, count(*) AS n FROM f WHERE brand IN (SELECT brand FROM t) GROUP BY brand"""))(
    lambda spark, sf: R.largest_groups(featured_items(spark, sf, with_orders=False), "brand", 12)
    .groupBy("brand").agg(F.count(F.lit(1)).alias("n")))

register("k4_segmentation_base_sorted", with_features("""
SELECT user_id, CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
       coalesce(sum(CASE WHEN is_returned_item = 1 THEN profit_erosion ELSE 0.0 END), 0) AS total_profit_erosion
FROM f GROUP BY user_id"""),
         ["total_profit_erosion"])(
    lambda spark, sf: A.rq2_customer_segmentation_base(
        featured_items(spark, sf).withColumn("profit_erosion", F.when(
            F.col("is_returned_item") == 1, F.col("profit_erosion")).otherwise(0.0)))
    .orderBy(F.desc("total_profit_erosion"), F.desc("returned_items"), "user_id")
    .select("user_id", "returned_items", "total_profit_erosion"))

register("u1_dedup_keep_first", with_features("""
SELECT order_id, arg_min(order_item_id, order_item_id) AS order_item_id,
       arg_min(sale_price, order_item_id) AS sale_price FROM f GROUP BY order_id"""), ["sale_price"])(
    lambda spark, sf: _u1(spark, sf))


def _u1(spark, sf):
    from losslens.operators.quality import detect_duplicates
    f = featured_items(spark, sf, with_orders=False).select("order_id", "order_item_id", "sale_price")
    return detect_duplicates(f, subset=["order_id"], action="remove", order_key="order_item_id")[0]


register("u6_sample_per_category", None)(
    lambda spark, sf: R.sample_per_group(featured_items(spark, sf, with_orders=False), "category", "order_item_id", 50)
    .groupBy("category").agg(F.count(F.lit(1)).alias("n")))

register("u7_global_sample", None)(
    lambda spark, sf: R.sample_rows(featured_items(spark, sf, with_orders=False), "order_item_id", 500)
    .select("order_item_id"))

register("u8_stratified_split_counts", with_features("""
SELECT is_returned_item, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS n_test
FROM f GROUP BY is_returned_item"""), ints=["is_returned_item"])(
    lambda spark, sf: R.stratified_split(featured_items(spark, sf, with_orders=False), "is_returned_item", "order_item_id")
    .groupBy("is_returned_item").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum("is_test").cast("long").alias("n_test")))

register("u4_melt_category_measures", with_features("""
, g AS (SELECT category, count(*) AS item_rows, CAST(sum(is_returned_item) AS BIGINT) AS returned_items
        FROM f GROUP BY category)
SELECT category, variable, value FROM (UNPIVOT g ON item_rows, returned_items INTO NAME variable VALUE value)"""))(
    lambda spark, sf: R.melt(A.return_rates_by_group(featured_items(spark, sf, with_orders=False), ["category"], 0)
                             .select("category", "item_rows", "returned_items"),
                             ["category"], ["item_rows", "returned_items"]))


# K5: the category of largest mean erosion, first name on ties; U3: both ends stacked
_CAT_MEAN = "SELECT category, avg(profit_erosion) AS mean_erosion FROM f WHERE is_returned_item = 1 GROUP BY category"
register("k5_argmax_mean_erosion", with_features(_CAT_MEAN + " ORDER BY mean_erosion DESC, category LIMIT 1"),
         ["mean_erosion"])(lambda spark, sf: R.argmax(_category_means(spark, sf), "mean_erosion", "category"))
register("u3_stacked_summary", with_features("""
SELECT category, avg(profit_erosion) AS mean_erosion, CAST(NULL AS DOUBLE) AS returned_items FROM f
WHERE is_returned_item = 1 GROUP BY category UNION ALL
SELECT category, NULL, CAST(count(*) AS DOUBLE) FROM f WHERE is_returned_item = 1 GROUP BY category"""),
         ["mean_erosion", "returned_items"])(
    lambda spark, sf: R.stack_tables(_category_means(spark, sf), returned_items(spark, sf, with_orders=False)
                                     .groupBy("category").agg(F.count(F.lit(1)).cast("double").alias("returned_items"))))


def _category_means(spark, sf):
    return returned_items(spark, sf, with_orders=False).groupBy("category").agg(
        F.avg("profit_erosion").alias("mean_erosion"))
