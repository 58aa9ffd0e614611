"""Catalog entries: targets, price tiers, Pareto / Lorenz / Gini family."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators import aggregates as A
from losslens.operators import concentration as C
from losslens.operators.ordered import average_ranks, quantiles_of_counts
from losslens.plans.registry import featured_items, register, returned_items
from losslens.plans.q_aggregates import CUSTOMER_EROSION_SQL
from losslens.plans.sqlkit import with_features
from losslens.session import cut_lineage

CE = CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + ")"


def ce_sql(tail: str) -> str:
    return with_features(CE + ",\n" + tail.strip().lstrip(","))


def customers(spark, sf):
    # one row per customer: materialised once (reliable checkpoint) so the
    # several ordered passes of Pareto / Lorenz / Gini / ranks read it
    # instead of re-running the item join
    return cut_lineage(A.profit_erosion_by_customer(returned_items(spark, sf)))


QUARTILE_SQL = ("1 + CAST(e1 > e0 AND v > e1 AS INTEGER) + CAST(e2 > e1 AND v > e2 AS INTEGER)"
                " + CAST(e3 > e2 AND v > e3 AS INTEGER)")

# ---------------------------------------------------------------- W1
register("w1_profit_erosion_targets", ce_sql(f"""
e AS (SELECT quantile_cont(total_profit_erosion, 0.0) AS e0, quantile_cont(total_profit_erosion, 0.25) AS e1,
             quantile_cont(total_profit_erosion, 0.5) AS e2, quantile_cont(total_profit_erosion, 0.75) AS e3,
             quantile_cont(total_profit_erosion, 1.0) AS e4 FROM ce),
r AS (SELECT user_id, total_profit_erosion AS v,
             (rank() OVER (ORDER BY total_profit_erosion)
              + (count(*) OVER (PARTITION BY total_profit_erosion) - 1) / 2.0) AS ar,
             count(*) OVER () AS n FROM ce)
SELECT user_id, v AS total_profit_erosion, ar / n * 100 AS erosion_percentile_rank,
       CAST(v > e3 AS INTEGER) AS is_high_erosion_customer,
       CAST({QUARTILE_SQL} AS BIGINT) AS profit_erosion_quartile
FROM r CROSS JOIN e"""), ["total_profit_erosion", "erosion_percentile_rank"],
         ints=["is_high_erosion_customer"])(
    lambda spark, sf: C.create_profit_erosion_targets(customers(spark, sf)).select(
        "user_id", "total_profit_erosion", "erosion_percentile_rank", "is_high_erosion_customer",
        "profit_erosion_quartile"))

# ---------------------------------------------------------------- W2 + J7
register("j7_w2_product_level_features", with_features("""
cr AS (SELECT category, sum(is_returned_item) / count(*) AS category_return_rate FROM f
       WHERE category IS NOT NULL GROUP BY 1 HAVING count(*) >= 200),
br AS (SELECT brand, sum(is_returned_item) / count(*) AS brand_return_rate FROM f
       WHERE brand IS NOT NULL GROUP BY 1 HAVING count(*) >= 200),
e AS (SELECT quantile_cont(sale_price, 0.0) AS e0, quantile_cont(sale_price, 1.0 / 3) AS e1,
             quantile_cont(sale_price, 2.0 / 3) AS e2 FROM f)
SELECT f.order_item_id, cr.category_return_rate, br.brand_return_rate,
  CASE WHEN f.sale_price IS NULL THEN NULL
       ELSE ['low', 'medium', 'high'][1 + CAST(e1 > e0 AND f.sale_price > e1 AS INTEGER)
                                      + CAST(e2 > e1 AND f.sale_price > e2 AS INTEGER)] END AS price_tier
FROM f LEFT JOIN cr ON f.category = cr.category LEFT JOIN br ON f.brand = br.brand CROSS JOIN e"""),
         ["category_return_rate", "brand_return_rate"])(
    lambda spark, sf: _product_features(spark, sf))


def _product_features(spark, sf):
    """One counting pass for both rate tables and the price terciles, and one
    read of the rows that get them."""
    f = featured_items(spark, sf, with_orders=False)
    melted = f.select("is_returned_item", F.explode(F.array(
        F.struct(F.lit("category").alias("kind"), F.col("category").alias("key"), F.lit(None).cast("double").alias("_v")),
        F.struct(F.lit("brand").alias("kind"), F.col("brand").alias("key"), F.lit(None).cast("double").alias("_v")),
        F.struct(F.lit("price").alias("kind"), F.lit(None).cast("string").alias("key"),
                 F.col("sale_price").cast("double").alias("_v")))).alias("m")).select("is_returned_item", "m.*")
    counts = cut_lineage(melted.groupBy("kind", "key", "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("is_returned_item").alias("returned")))

    def rates(kind):
        rows = counts.where((F.col("kind") == kind) & F.col("key").isNotNull() & (F.col("_c") >= 200))
        return rows.select(F.col("key").alias(kind), (F.col("returned") / F.col("_c")).alias(f"{kind}_return_rate"))
    edges = quantiles_of_counts(counts.where("kind = 'price' AND _v IS NOT NULL").select("_v", "_c"), [],
                                [(f"_e{i}", "_v", i / 3) for i in range(4)])
    # rate tables have one row per group; the planner broadcasts them while
    # they are under the size threshold, else sort-merge (AQE skew-join on)
    out = f.join(rates("category"), ["category"], "left").join(rates("brand"), ["brand"], "left")
    return C.price_tier(out, edges=edges).select("order_item_id", "category_return_rate", "brand_return_rate", "price_tier")


# ---------------------------------------------------------------- W3
PARETO_CTE = """
t AS (SELECT user_id, coalesce(total_profit_erosion, 0.0) AS v FROM ce),
r AS (SELECT user_id, v, row_number() OVER (ORDER BY v DESC, user_id) AS rank, count(*) OVER () AS n,
             sum(v) OVER (ORDER BY v DESC, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_value,
             sum(v) OVER () AS total FROM t),
p AS (SELECT user_id, v AS total_profit_erosion, rank, rank / n AS customer_share, cum_value,
       CASE WHEN total > 0 THEN cum_value / total ELSE 0.0 END AS value_share,
       CASE WHEN rank / n <= 0.2 THEN 'Vital Few' ELSE 'Useful Many' END AS concentration_category,
       n FROM r)"""
register("w3_pareto_table", ce_sql(PARETO_CTE + "\nSELECT * EXCLUDE (n) FROM p"),
         ["total_profit_erosion", "customer_share", "cum_value", "value_share"],
         {"customer_share": 6, "value_share": 6})(
    lambda spark, sf: C.pareto_table(customers(spark, sf)))

# ---------------------------------------------------------------- W4
register("w4_lorenz_points", ce_sql("""
t AS (SELECT user_id, coalesce(total_profit_erosion, 0.0) AS v FROM ce),
r AS (SELECT row_number() OVER (ORDER BY v, user_id) AS i, count(*) OVER () AS n,
             sum(v) OVER (ORDER BY v, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             sum(v) OVER () AS total FROM t)
SELECT 0.0::DOUBLE AS population_share, 0.0::DOUBLE AS value_share
UNION ALL SELECT i / n, CASE WHEN total > 0 THEN cum / total ELSE 0.0 END FROM r"""),
         ["population_share", "value_share"])(
    lambda spark, sf: C.lorenz_points(customers(spark, sf)))

# ---------------------------------------------------------------- W5
GINI_TMPL = """
gt{s} AS (SELECT coalesce({col}, 0.0) AS x0 FROM ce), gm{s} AS (SELECT min(x0) AS mn FROM gt{s}),
gs{s} AS (SELECT CASE WHEN mn < 0 THEN x0 - mn ELSE x0 END AS x FROM gt{s} CROSS JOIN gm{s}),
gr{s} AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM gs{s}),
g{s} AS (SELECT coalesce(CASE WHEN sum(x) = 0 THEN 0.0 ELSE sum((2 * i - n - 1) * x) / (max(n) * sum(x)) END, 0.0)
             AS gini, count(*) AS n FROM gr{s})"""


class _G:
    @staticmethod
    def format(col, s=""):
        return GINI_TMPL.format(col=col, s=s)


GINI_SQL = _G
register("w5_gini_customer_erosion", ce_sql(GINI_SQL.format(col="total_profit_erosion") +
                                           "\nSELECT * FROM g"), ["gini"])(
    lambda spark, sf: C.gini(customers(spark, sf), "total_profit_erosion"))

register("w13_gini_null_test", ce_sql(GINI_SQL.format(col="total_profit_erosion") + """
SELECT gini AS observed_gini, 0.0 AS null_mean_gini, CASE WHEN gini <= 0 THEN 1.0 ELSE 0.0 END AS p_value
FROM g"""), ["observed_gini", "null_mean_gini", "p_value"])(
    lambda spark, sf: C.gini_null_test(customers(spark, sf), "total_profit_erosion"))

# ---------------------------------------------------------------- W6
TOPX_SQL = PARETO_CTE + """,
tx AS (SELECT CASE WHEN count(*) = 0 THEN 0.0 ELSE arg_min(value_share, (abs(customer_share - 0.2), rank)) END
       AS top_share FROM p)"""
register("w6_top20_share", ce_sql(TOPX_SQL + "\nSELECT * FROM tx"), ["top_share"])(
    lambda spark, sf: C.top_share(customers(spark, sf), "total_profit_erosion", 0.2))

# ---------------------------------------------------------------- W7
register("w7_top50_impact", ce_sql("""
top AS (SELECT sum(total_profit_erosion) AS s FROM (SELECT total_profit_erosion FROM ce
        ORDER BY total_profit_erosion DESC, user_id LIMIT 50))
SELECT CAST(50 AS BIGINT) AS count, round_even(top.s, 2) AS absolute_loss,
       round_even(CASE WHEN sum(total_profit_erosion) > 0 THEN top.s / sum(total_profit_erosion) ELSE 0 END * 100, 2)
       AS percentage_of_total
FROM ce CROSS JOIN top GROUP BY top.s"""), ["absolute_loss", "percentage_of_total"],
         {"absolute_loss": 2, "percentage_of_total": 2})(
    lambda spark, sf: C.top_n_impact(customers(spark, sf), "total_profit_erosion", 50))

# ---------------------------------------------------------------- W8
register("w8_business_summary", ce_sql(GINI_SQL.format(col="total_profit_erosion") + "," + TOPX_SQL + """
SELECT round_even(gini, 3) AS gini_index,
  CASE WHEN gini > 0.7 THEN 'Extreme' WHEN gini > 0.5 THEN 'High' ELSE 'Moderate' END AS concentration_level,
  '20% of customers = ' || CAST(round_even(top_share * 100, 1) AS VARCHAR) || '% of loss' AS pareto_ratio,
  CASE WHEN gini > 0.5 THEN 'Targeted Policy' ELSE 'Broad Policy' END AS recommendation
FROM g CROSS JOIN tx"""), ["gini_index"], {"gini_index": 3})(
    lambda spark, sf: C.business_summary(customers(spark, sf), "total_profit_erosion"))

# ---------------------------------------------------------------- W9
register("w9_concentration_comparison", ce_sql(
    GINI_SQL.format(col="total_profit_erosion") + "," +
    GINI_SQL.format(col="total_sales", s="2") + """
SELECT g.gini AS gini_erosion, g2.gini AS gini_baseline FROM g CROSS JOIN g2"""),
         ["gini_erosion", "gini_baseline"])(
    lambda spark, sf: C.concentration_comparison(customers(spark, sf)))

# ---------------------------------------------------------------- W10 / W11 / W12
_FEATS = ["total_profit_erosion", "total_margin_reversal", "total_sales", "returned_items",
          "total_orders"]


def _feature_rank_sql(where: str = "") -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, user_id, coalesce(CAST({c} AS DOUBLE), 0.0) AS value FROM ce"
        for c in _FEATS)
    return ce_sql(f"""
lg AS (SELECT * FROM ({long}) WHERE value > 0),
rr AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS i,
              row_number() OVER (PARTITION BY feature ORDER BY value DESC, user_id) AS rk,
              count(*) OVER (PARTITION BY feature) AS n,
              sum(value) OVER (PARTITION BY feature ORDER BY value DESC, user_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
              sum(value) OVER (PARTITION BY feature) AS total FROM lg),
gg AS (SELECT feature, CASE WHEN sum(value) = 0 THEN 0.0
              ELSE sum((2 * i - n - 1) * value) / (max(n) * sum(value)) END AS gini, max(n) AS n,
              arg_min(cum / total, (abs(rk / n - 0.2), rk)) AS top_share FROM rr GROUP BY feature),
ranked AS (SELECT feature, round_even(gini, 4) AS gini_coefficient,
       round_even(round_even(gini, 4) * 100, 2) AS concentration_pct,
       CASE WHEN gini <= 0 THEN 1.0 ELSE 0.0 END AS p_value,
       CASE WHEN gini > 0.7 THEN 'Extreme' WHEN gini > 0.5 THEN 'High' WHEN gini > 0.3 THEN 'Moderate'
            ELSE 'Low' END AS concentration_level,
       CAST(n AS BIGINT) AS n_customers, round_even(top_share * 100, 2) AS top_20_pct_share
FROM gg WHERE n >= 10)
SELECT * FROM ranked {where}""")


_RANK_D = ["gini_coefficient", "concentration_pct", "p_value", "top_20_pct_share"]
_RANK_DIG = {"gini_coefficient": 4, "concentration_pct": 2, "top_20_pct_share": 2}


def _rank_feats(spark, sf):
    return C.rank_features_by_concentration(customers(spark, sf), _FEATS, 10)


register("w11_rank_features_by_concentration", _feature_rank_sql(), _RANK_D, _RANK_DIG)(_rank_feats)
register("w12_significant_concentration", _feature_rank_sql("WHERE p_value < 0.05"),
         _RANK_D, _RANK_DIG)(
    lambda spark, sf: C.filter_significant_features(_rank_feats(spark, sf)))

# ---------------------------------------------------------------- W17
register("w17_average_ranks", ce_sql("""
SELECT user_id, total_profit_erosion,
       rank() OVER (ORDER BY total_profit_erosion)
       + (count(*) OVER (PARTITION BY total_profit_erosion) - 1) / 2.0 AS rank
FROM ce"""), ["total_profit_erosion", "rank"])(
    lambda spark, sf: average_ranks(customers(spark, sf), [], "total_profit_erosion")
    .select("user_id", "total_profit_erosion", "rank"))
