"""Catalog entries: group aggregations (A-rows) and monthly trend."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators import aggregates as A
from losslens.operators import features as FE
from losslens.plans.registry import featured_items, register, returned_items
from losslens.plans.sqlkit import with_features
from losslens.sources.adapter import first_orders, items
from losslens.session import cut_lineage
from losslens.streaming.monthly import monthly_return_rate_stream

# money columns are exact 4-decimal sums: rounding on that grid (4) is
# robust to summation order, rounding to 2 would hit decimal ties
M2: dict = {}

# ------------------------------------------------------------------ A1 / A5 / A25
for _name, _col, _min in [("a1_return_rate_by_category", "category", 200),
                          ("a5_return_rate_by_brand", "brand", 200),
                          ("a25_return_rate_by_country", "country", 0)]:
    def _mk(col=_col, mn=_min):
        def fn(spark, sf):
            return A.return_rates_by_group(
                featured_items(spark, sf, ["country"] if col == "country" else [], with_orders=col == "country"), [col], mn)
        return fn
    register(_name, with_features(f"""
SELECT {_col}, count(*) AS item_rows, CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
       sum(is_returned_item) / count(*) AS return_rate
FROM f WHERE {_col} IS NOT NULL GROUP BY {_col} HAVING count(*) >= {_min}"""),
             ["return_rate"])(_mk())

# ------------------------------------------------------------------ A2
register("a2_margin_loss_by_category", with_features("""
SELECT category, count(order_id) AS returned_items, sum(sale_price) AS total_lost_sales,
       sum(item_margin) AS total_lost_margin, avg(item_margin) AS avg_margin_per_return,
       quantile_cont(item_margin, 0.5) AS median_margin_per_return
FROM f WHERE is_returned_item = 1 AND category IS NOT NULL GROUP BY category"""),
         ["total_lost_sales", "total_lost_margin", "avg_margin_per_return",
          "median_margin_per_return"], M2)(
    lambda spark, sf: A.margin_loss_by_group(returned_items(spark, sf, with_orders=False), ["category"]))

# ------------------------------------------------------------------ A3
register("a3_customer_margin_exposure", with_features("""
SELECT user_id, count(order_id) AS return_events, sum(item_margin) AS total_lost_margin,
       sum(sale_price) AS total_lost_sales, max(item_margin) AS max_single_return_margin,
       quantile_cont(item_margin, 0.5) AS median_margin_per_return
FROM f WHERE is_returned_item = 1 AND user_id IS NOT NULL GROUP BY user_id"""),
         ["total_lost_margin", "total_lost_sales", "max_single_return_margin",
          "median_margin_per_return"], M2)(
    lambda spark, sf: A.customer_margin_exposure(returned_items(spark, sf)))

# ------------------------------------------------------------------ A4
_A4 = ["avg_cost", "total_cost", "avg_sale_price", "total_sale_price", "avg_margin",
       "total_margin", "median_margin", "min_margin", "max_margin"]
register("a4_price_margin_returned_by_country", with_features("""
SELECT country, count(*) AS item_count,
  round_even(avg(cost), 2) AS avg_cost, round_even(sum(cost), 2) AS total_cost,
  round_even(avg(sale_price), 2) AS avg_sale_price, round_even(sum(sale_price), 2) AS total_sale_price,
  round_even(avg(item_margin), 2) AS avg_margin, round_even(sum(item_margin), 2) AS total_margin,
  round_even(quantile_cont(item_margin, 0.5), 2) AS median_margin,
  round_even(min(item_margin), 2) AS min_margin, round_even(max(item_margin), 2) AS max_margin
FROM f WHERE lower(item_status) = 'returned' AND country IS NOT NULL GROUP BY country"""),
         _A4, {c: 2 for c in _A4})(
    lambda spark, sf: A.price_margin_returned_by_country(featured_items(spark, sf, ["country"])))

# ------------------------------------------------------------------ A7
register("a7_return_behavior_all_levels", with_features("""
, long AS (SELECT 'by_category' AS level, CAST(category AS VARCHAR) AS grp, is_returned_item FROM f
           UNION ALL SELECT 'by_brand', brand, is_returned_item FROM f
           UNION ALL SELECT 'by_department', department, is_returned_item FROM f)
SELECT level, grp, count(*) AS item_rows, CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
       sum(is_returned_item) / count(*) AS return_rate
FROM long WHERE grp IS NOT NULL GROUP BY level, grp HAVING count(*) >= 200""".lstrip()
                                                         .replace(", long", "long", 1)),
         ["return_rate"])(
    lambda spark, sf: A.product_return_behavior_metrics(featured_items(spark, sf, with_orders=False), 200))

register("a7_return_rate_validation", with_features("""
, long AS (SELECT 'by_category' AS level, CAST(category AS VARCHAR) AS grp, is_returned_item FROM f
           UNION ALL SELECT 'by_brand', brand, is_returned_item FROM f
           UNION ALL SELECT 'by_department', department, is_returned_item FROM f),
r AS (SELECT level, grp, count(*) AS item_rows, sum(is_returned_item) AS returned_items,
             sum(is_returned_item) / count(*) AS return_rate
      FROM long WHERE grp IS NOT NULL GROUP BY level, grp HAVING count(*) >= 200)
SELECT count(*) FILTER (WHERE item_rows <= 0) AS non_positive_rows,
       count(*) FILTER (WHERE returned_items < 0) AS negative_returned,
       count(*) FILTER (WHERE returned_items > item_rows) AS returned_exceeds_rows,
       count(*) FILTER (WHERE return_rate < 0 OR return_rate > 1) AS rate_out_of_range
FROM r""".lstrip().replace(", long", "long", 1)))(
    lambda spark, sf: A.validate_return_rate_table(
        A.product_return_behavior_metrics(featured_items(spark, sf, with_orders=False), 200)))

# ------------------------------------------------------------------ A8
register("a8_customer_erosion_summary", with_features("""
SELECT user_id, count(*) AS return_rows, sum(profit_erosion) AS total_profit_erosion,
       avg(profit_erosion) AS avg_profit_erosion_per_return
FROM f WHERE is_returned_item = 1 AND user_id IS NOT NULL GROUP BY user_id HAVING count(*) >= 1"""),
         ["total_profit_erosion", "avg_profit_erosion_per_return"], M2)(
    lambda spark, sf: A.customer_profit_erosion_summaries(returned_items(spark, sf), 1))

# ------------------------------------------------------------------ A9
register("a9_erosion_by_order", with_features("""
SELECT order_id, arg_min(user_id, order_item_id) FILTER (WHERE user_id IS NOT NULL) AS user_id,
       count(order_item_id) AS returned_items, sum(margin_reversal) AS total_margin_reversal,
       sum(process_cost) AS total_process_cost, sum(profit_erosion) AS total_profit_erosion,
       sum(sale_price) AS total_sales, sum(item_margin) AS total_margin,
       sum(item_margin) / count(order_item_id) AS avg_margin_per_return
FROM f WHERE is_returned_item = 1 AND order_id IS NOT NULL GROUP BY order_id"""),
         ["total_margin_reversal", "total_process_cost", "total_profit_erosion", "total_sales",
          "total_margin", "avg_margin_per_return"], M2)(
    lambda spark, sf: A.profit_erosion_by_order(returned_items(spark, sf)))

# ------------------------------------------------------------------ A10
CUSTOMER_EROSION_SQL = """
SELECT user_id, count(DISTINCT order_id) AS total_orders, count(order_item_id) AS returned_items,
       sum(margin_reversal) AS total_margin_reversal, sum(process_cost) AS total_process_cost,
       sum(profit_erosion) AS total_profit_erosion, sum(sale_price) AS total_sales,
       sum(item_margin) AS total_margin,
       sum(profit_erosion) / count(order_item_id) AS avg_erosion_per_return
FROM f WHERE is_returned_item = 1 AND user_id IS NOT NULL GROUP BY user_id"""
register("a10_erosion_by_customer", with_features(CUSTOMER_EROSION_SQL),
         ["total_margin_reversal", "total_process_cost", "total_profit_erosion", "total_sales",
          "total_margin", "avg_erosion_per_return"], M2)(
    lambda spark, sf: A.profit_erosion_by_customer(returned_items(spark, sf)))

# ------------------------------------------------------------------ A11
register("a11_erosion_summary", with_features("""
SELECT count(*) AS total_returned, coalesce(sum(margin_reversal), 0) AS total_margin_reversal,
       coalesce(avg(item_margin), 0) AS avg_margin_per_return,
       coalesce(quantile_cont(item_margin, 0.5), 0) AS median_margin_per_return,
       coalesce(sum(process_cost), 0) AS total_process_costs,
       coalesce(sum(profit_erosion), 0) AS total_profit_erosion,
       coalesce(max(item_margin), 0) AS max_single_margin_loss,
       CASE WHEN count(*) > 0 THEN sum(profit_erosion) / count(*) ELSE 0 END AS avg_erosion_per_return
FROM f WHERE is_returned_item = 1"""),
         ["total_margin_reversal", "avg_margin_per_return", "median_margin_per_return",
          "total_process_costs", "total_profit_erosion", "max_single_margin_loss",
          "avg_erosion_per_return"], M2)(
    lambda spark, sf: A.summarize_profit_erosion(returned_items(spark, sf)))

# ------------------------------------------------------------------ A12 RFM
RFM_EXTRA = ["order_created_at", "user_created_at"]
RFM_SQL_CTE = """
, o AS (SELECT user_id, order_id, sum(sale_price) AS order_total, count(order_item_id) AS order_items
        FROM f WHERE user_id IS NOT NULL GROUP BY user_id, order_id),
ref AS (SELECT max(order_created_at) AS ref FROM f),
c AS (SELECT user_id, count(order_item_id) AS total_items, count(DISTINCT order_id) AS order_frequency,
             CAST(sum(is_returned_item) AS BIGINT) AS return_frequency, sum(sale_price) AS total_sales,
             sum(item_margin) AS total_margin, avg(sale_price) AS avg_item_price,
             avg(item_margin) AS avg_item_margin, max(order_created_at) AS last_order,
             arg_min(user_created_at, order_item_id) FILTER (WHERE user_created_at IS NOT NULL) AS uc
      FROM f WHERE user_id IS NOT NULL GROUP BY user_id),
rfm AS (SELECT c.user_id, total_items, order_frequency, return_frequency, total_sales, total_margin,
       avg_item_price, avg_item_margin, return_frequency / total_items AS customer_return_rate,
       total_items / order_frequency AS avg_basket_size,
       CAST(floor((epoch_us(ref) - epoch_us(last_order)) / 86400000000) AS BIGINT) AS purchase_recency_days,
       CAST(floor((epoch_us(ref) - epoch_us(uc)) / 86400000000) AS BIGINT) AS customer_tenure_days,
       ov.avg_order_value
  FROM c CROSS JOIN ref JOIN (SELECT user_id, avg(order_total) AS avg_order_value FROM o GROUP BY user_id) ov
       ON c.user_id = ov.user_id)"""
RFM_DOUBLES = ["total_sales", "total_margin", "avg_item_price", "avg_item_margin",
               "customer_return_rate", "avg_basket_size", "avg_order_value"]


def rfm_sql(tail: str) -> str:
    return with_features(RFM_SQL_CTE.lstrip().replace(", o AS", "o AS", 1) + "\n" + tail)


def rfm(spark, sf):
    # customer grain, read by several passes (moments, exact quantiles,
    # correlations): materialised once with a reliable checkpoint
    return cut_lineage(A.customer_behavioral_features(featured_items(spark, sf, ["order_created_at"]),
                                                      customers=first_orders(spark, sf)))


register("a12_customer_rfm_features", rfm_sql("SELECT * FROM rfm"), RFM_DOUBLES, M2)(rfm)

# ------------------------------------------------------------------ P23 + A18
register("p23_return_segments", rfm_sql("""
SELECT user_id, customer_return_rate,
  CASE WHEN customer_return_rate = 0 THEN 'no_returns' WHEN customer_return_rate <= 0.05 THEN 'low_returner'
       WHEN customer_return_rate <= 0.15 THEN 'moderate_returner' WHEN customer_return_rate > 0.15
       THEN 'high_returner' ELSE 'unknown' END AS return_segment FROM rfm"""),
         ["customer_return_rate"])(
    lambda spark, sf: FE.segment_by_return_rate(rfm(spark, sf))
    .select("user_id", "customer_return_rate", "return_segment"))

register("a18_return_segment_summary", rfm_sql("""
, seg AS (SELECT *, CASE WHEN customer_return_rate = 0 THEN 'no_returns'
       WHEN customer_return_rate <= 0.05 THEN 'low_returner'
       WHEN customer_return_rate <= 0.15 THEN 'moderate_returner' WHEN customer_return_rate > 0.15
       THEN 'high_returner' ELSE 'unknown' END AS return_segment FROM rfm)
SELECT return_segment, count(*) AS customers, avg(total_items) AS avg_items,
       avg(customer_return_rate) AS avg_return_rate, sum(total_margin) AS total_margin
FROM seg GROUP BY return_segment""".replace("\n, seg AS", ", seg AS", 1)),
         ["avg_items", "avg_return_rate", "total_margin"], M2)(
    lambda spark, sf: A.segment_summary(FE.segment_by_return_rate(rfm(spark, sf))))

# ------------------------------------------------------------------ A13
register("a13_customer_segmentation_base", with_features("""
SELECT user_id, count(order_item_id) AS total_items, CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
  coalesce(sum(CASE WHEN is_returned_item = 1 THEN item_margin ELSE 0.0 END), 0) AS total_profit_erosion,
  arg_min(age, order_item_id) FILTER (WHERE age IS NOT NULL) AS age,
  arg_min(country, order_item_id) FILTER (WHERE country IS NOT NULL) AS country,
  arg_min(state, order_item_id) FILTER (WHERE state IS NOT NULL) AS state,
  arg_min(traffic_source, order_item_id) FILTER (WHERE traffic_source IS NOT NULL) AS traffic_source,
  CASE WHEN count(order_item_id) > 0 THEN sum(is_returned_item) / count(order_item_id) ELSE 0 END AS return_rate,
  CASE WHEN sum(is_returned_item) > 0 THEN coalesce(sum(CASE WHEN is_returned_item = 1 THEN item_margin
       ELSE 0.0 END), 0) / sum(is_returned_item) ELSE 0 END AS avg_profit_erosion_per_return
FROM f GROUP BY user_id"""),
         ["total_profit_erosion", "age", "return_rate", "avg_profit_erosion_per_return"], M2)(
    lambda spark, sf: A.rq2_customer_segmentation_base(
        featured_items(spark, sf, ["age", "country", "state", "traffic_source"])
        .drop("profit_erosion")))

# ------------------------------------------------------------------ A19 / A23 / A32
register("a19_process_cost_distribution", with_features("""
SELECT process_cost, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM f WHERE is_returned_item = 1 GROUP BY process_cost"""), ["process_cost", "share"])(
    lambda spark, sf: A.value_distribution(returned_items(spark, sf, with_orders=False), "process_cost"))

register("a23_item_status_counts", with_features("""
SELECT item_status, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM f GROUP BY item_status"""), ["share"])(
    lambda spark, sf: A.value_distribution(featured_items(spark, sf, with_orders=False), "item_status"))

register("a23_target_balance", with_features(CUSTOMER_EROSION_SQL.replace("SELECT user_id", ", ce AS (SELECT user_id", 1) + """),
th AS (SELECT quantile_cont(total_profit_erosion, 0.75) AS t FROM ce)
SELECT CAST(total_profit_erosion > t AS INTEGER) AS is_high_erosion_customer, count(*) AS count,
       count(*) / sum(count(*)) OVER () AS share
FROM ce CROSS JOIN th GROUP BY 1""".replace(", ce AS", "ce AS", 1)), ["share"])(
    lambda spark, sf: _target_balance(spark, sf))


def _target_balance(spark, sf):
    from losslens.operators.concentration import create_profit_erosion_targets
    t = create_profit_erosion_targets(A.profit_erosion_by_customer(returned_items(spark, sf)))
    return A.value_distribution(t.withColumn("is_high_erosion_customer",
                                             F.col("is_high_erosion_customer").cast("int")),
                                "is_high_erosion_customer")


# ------------------------------------------------------------------ A22
register("a22_customer_erosion_distribution", with_features(
    CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + """)
SELECT count(*) AS n, quantile_cont(total_profit_erosion, 0.5) AS median,
       quantile_cont(total_profit_erosion, 0.9) AS p90, quantile_cont(total_profit_erosion, 0.99) AS p99,
       max(total_profit_erosion) AS max,
       (SELECT sum(total_profit_erosion) FROM (SELECT total_profit_erosion FROM ce
          ORDER BY total_profit_erosion DESC, user_id LIMIT 10)) / sum(total_profit_erosion) AS top10_share
FROM ce"""), ["median", "p90", "p99", "max", "top10_share"])(
    lambda spark, sf: A.distribution_summary(
        A.profit_erosion_by_customer(returned_items(spark, sf)), "total_profit_erosion"))

# ------------------------------------------------------------------ A24
_MISS_COLS = ["order_item_id", "order_id", "user_id", "item_status", "sale_price", "cost",
              "category", "item_delivered_at", "item_returned_at", "country"]
register("a24_missingness_overview", with_features(
    ", m AS (SELECT " + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS {c}"
                                 for c in _MISS_COLS) + " FROM f)\n"
    "SELECT * FROM (UNPIVOT m ON " + ", ".join(_MISS_COLS) +
    " INTO NAME \"column\" VALUE missing_pct) WHERE missing_pct > 0").replace(
        "\n, m AS", ", m AS", 1), ["missing_pct"])(
    lambda spark, sf: A.missingness_overview(
        featured_items(spark, sf, ["item_delivered_at", "item_returned_at", "country"])
        .select(*_MISS_COLS)))

# ------------------------------------------------------------------ A26
register("a26_high_erosion_group", with_features(
    CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + """),
th AS (SELECT quantile_cont(total_profit_erosion, 0.75) AS threshold FROM ce)
SELECT any_value(threshold) AS threshold,
       count(*) FILTER (WHERE total_profit_erosion > threshold) AS high_customers,
       sum(total_profit_erosion) FILTER (WHERE total_profit_erosion > threshold) AS high_total,
       sum(total_profit_erosion) FILTER (WHERE total_profit_erosion > threshold) / sum(total_profit_erosion) AS high_share,
       avg(total_profit_erosion) FILTER (WHERE total_profit_erosion > threshold) AS high_mean
FROM ce CROSS JOIN th"""), ["threshold", "high_total", "high_share", "high_mean"])(
    lambda spark, sf: A.high_erosion_group(A.profit_erosion_by_customer(returned_items(spark, sf))))

# ------------------------------------------------------------------ A27
register("a27_return_rate_matrix_state_department", with_features("""
SELECT state,
  sum(is_returned_item) FILTER (WHERE department = 'Large') / count(*) FILTER (WHERE department = 'Large') AS "Large",
  sum(is_returned_item) FILTER (WHERE department = 'Small') / count(*) FILTER (WHERE department = 'Small') AS "Small"
FROM f WHERE state IS NOT NULL AND department IS NOT NULL GROUP BY state"""), ["Large", "Small"])(
    lambda spark, sf: A.return_rate_matrix(featured_items(spark, sf, ["state"]), "state", "department"))

# ------------------------------------------------------------------ A29
register("a29_volume_severity_by_category", with_features("""
, g AS (SELECT category, count(*) AS n, count(*) FILTER (WHERE is_returned_item = 1) AS r,
        avg(profit_erosion) FILTER (WHERE is_returned_item = 1) AS m FROM f
        WHERE category IS NOT NULL GROUP BY category HAVING count(*) >= 200)
SELECT category, greatest(CAST(coalesce(CASE WHEN r > 0 THEN r END, 0) AS DOUBLE), 0.0) AS volume,
       greatest(coalesce(m, 0.0), 0.0) AS severity,
       greatest(CAST(coalesce(CASE WHEN r > 0 THEN r END, 0) AS DOUBLE), 0.0) * greatest(coalesce(m, 0.0), 0.0) AS total
FROM g""".replace("\n, g AS", ", g AS", 1)), ["volume", "severity", "total"])(
    lambda spark, sf: A.volume_severity(
        A.erosion_level(A.product_profit_erosion_metrics(featured_items(spark, sf, with_orders=False)), "category"),
        "category"))

# ------------------------------------------------------------------ A30
register("a30_customer_erosion_histogram", with_features(
    CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + """),
p AS (SELECT total_profit_erosion AS x FROM ce WHERE total_profit_erosion > 0),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM p)
SELECT CAST(least(floor(60 * (x - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END)) + 1, 60) AS BIGINT) AS bin,
       count(*) AS count
FROM p CROSS JOIN mm GROUP BY 1"""))(
    lambda spark, sf: A.histogram(A.profit_erosion_by_customer(returned_items(spark, sf)),
                                  "total_profit_erosion", 60))

# ------------------------------------------------------------------ A31
_A31 = ["total_items", "order_frequency", "customer_return_rate", "avg_order_value",
        "purchase_recency_days"]
register("a31_rfm_column_summary", rfm_sql(
    ", long AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM rfm" for c in _A31) + ")\n"
    """SELECT "column", count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std,
       min(value) AS min, max(value) AS max, quantile_cont(value, 0.25) AS p25,
       quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75
FROM long GROUP BY 1"""), ["mean", "std", "min", "max", "p25", "p50", "p75"])(
    lambda spark, sf: A.column_summary(rfm(spark, sf), _A31))

# ------------------------------------------------------------------ A33
register("a33_between_group_cv", with_features("""
, a AS (SELECT avg(item_margin) FILTER (WHERE is_returned_item = 1) AS g FROM f GROUP BY category),
b AS (SELECT sum(is_returned_item) / count(*) AS g FROM f WHERE country IS NOT NULL GROUP BY country)
SELECT (SELECT stddev_samp(g) / avg(g) * 100 FROM a) AS margin_cv_by_category_pct,
       (SELECT stddev_samp(g) / avg(g) * 100 FROM b) AS return_rate_cv_by_country_pct
""".replace("\n, a AS", ", a AS", 1)), ["margin_cv_by_category_pct", "return_rate_cv_by_country_pct"])(
    lambda spark, sf: _cv(spark, sf))


def _cv(spark, sf):
    f = featured_items(spark, sf, ["country"])
    a = A.between_group_cv(A.margin_loss_by_group(f, ["category"]), "avg_margin_per_return")
    b = A.between_group_cv(A.return_rates_by_group(f, ["country"], 0), "return_rate")
    return a.withColumnRenamed("cv_pct", "margin_cv_by_category_pct").crossJoin(
        b.withColumnRenamed("cv_pct", "return_rate_cv_by_country_pct"))


# ------------------------------------------------------------------ A34
register("a34_headline_measures", with_features("""
SELECT count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS customers,
       count(DISTINCT product_id) AS products, CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
       quantile_cont(item_margin, 0.5) AS median_margin_all,
       quantile_cont(item_margin, 0.5) FILTER (WHERE is_returned_item = 1) AS median_margin_returned,
       quantile_cont(profit_erosion, 0.5) FILTER (WHERE is_returned_item = 1) AS median_erosion_returned
FROM f"""), ["median_margin_all", "median_margin_returned", "median_erosion_returned"])(
    lambda spark, sf: A.headline_measures(
        featured_items(spark, sf, with_orders=False),
        {"order_id": items(spark, sf, ["order_id"], distinct=True),
         "user_id": items(spark, sf, ["user_id"], distinct=True)}))

# ------------------------------------------------------------------ W14 / A35
MONTHLY_SQL = """
, m AS (SELECT date_trunc('month', order_created_at) AS month, count(*) AS items,
        CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
        sum(is_returned_item) / count(*) AS return_rate FROM f GROUP BY 1)"""
register("w14_monthly_return_rate", with_features(MONTHLY_SQL.replace("\n, m AS", "m AS", 1) + """
SELECT *, avg(return_rate) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
          AS rolling_3m_return_rate FROM m"""), ["return_rate", "rolling_3m_return_rate"], ts=["month"])(
    lambda spark, sf: A.monthly_return_rate(featured_items(spark, sf, ["order_created_at"])))

register("a35_peak_month", with_features(MONTHLY_SQL.replace("\n, m AS", "m AS", 1) + """
SELECT arg_min(month, (-return_rate, month)) AS peak_month, max(return_rate) AS peak_return_rate,
       avg(return_rate) AS mean_monthly_return_rate FROM m"""),
         ["peak_return_rate", "mean_monthly_return_rate"], ts=["peak_month"])(
    lambda spark, sf: A.peak_month(A.monthly_return_rate(featured_items(spark, sf, ["order_created_at"]))))

# ------------------------------------------------------------------ W14 (streaming form)
register("w14_monthly_return_rate_streaming", with_features(MONTHLY_SQL.replace("\n, m AS", "m AS", 1) + """
SELECT month, items, returned_items, return_rate FROM m"""), ["return_rate"], ts=["month"])(
    lambda spark, sf: monthly_return_rate_stream(spark, sf).select("month", "items", "returned_items", "return_rate"))
