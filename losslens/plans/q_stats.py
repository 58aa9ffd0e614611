"""Catalog entries: statistical tests (T-rows) on returned-item erosion."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators import aggregates as A
from losslens.operators import stats as S
from losslens.plans.registry import featured_items, register, returned_items
from losslens.plans.q_aggregates import CUSTOMER_EROSION_SQL
from losslens.plans.sqlkit import with_features


def _ret_sql(group: str) -> str:
    return (f"r AS (SELECT {group} AS g, profit_erosion AS x FROM f WHERE is_returned_item = 1 "
            f"AND {group} IS NOT NULL AND profit_erosion IS NOT NULL)")


def anova_sql(group: str) -> str:
    return with_features(_ret_sql(group) + """,
m AS (SELECT g, count(x) AS n, avg(x) AS mean, var_pop(x) * count(x) AS ss FROM r GROUP BY g),
gg AS (SELECT count(*) AS k, sum(n) AS n, sum(n * mean) / sum(n) AS grand FROM m),
t AS (SELECT any_value(gg.k) AS k, any_value(gg.n) AS n, sum(m.n * (mean - grand) ^ 2) AS ssb, sum(ss) AS ssw
      FROM m CROSS JOIN gg)
SELECT CAST(k AS BIGINT) AS k, CAST(n AS BIGINT) AS n, ssb AS ss_between, ssw AS ss_within,
       (ssb / (k - 1)) / (ssw / (n - k)) AS f_stat,
       CASE WHEN ssb + ssw > 0 THEN ssb / (ssb + ssw) ELSE 0.0 END AS eta_squared FROM t""")


def kruskal_sql(group: str) -> str:
    return with_features(_ret_sql(group) + """,
rk AS (SELECT g, x, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rk FROM r),
per AS (SELECT g, count(*) AS n, sum(rk) AS rs FROM rk GROUP BY g),
ties AS (SELECT sum(CAST(c AS DOUBLE) ^ 3 - c) AS tie_sum FROM (SELECT count(*) AS c FROM r GROUP BY x)),
t AS (SELECT count(*) AS k, sum(n) AS n, sum(rs ^ 2 / n) AS s FROM per)
SELECT CAST(k AS BIGINT) AS k, CAST(n AS BIGINT) AS n,
       (12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - tie_sum / (CAST(n AS DOUBLE) ^ 3 - n)) AS h_stat,
       CASE WHEN n - k > 0 THEN ((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - tie_sum / (CAST(n AS DOUBLE) ^ 3 - n))
            - k + 1) / (n - k) ELSE 0.0 END AS epsilon_squared
FROM t CROSS JOIN ties""")


for _g in ("category", "brand", "department"):
    register(f"t2_anova_erosion_by_{_g}", anova_sql(_g),
             ["ss_between", "ss_within", "f_stat", "eta_squared"],
             scale={"ss_between": 6, "ss_within": 6})(
        (lambda g: lambda spark, sf: S.anova_table(returned_items(spark, sf, with_orders=False), g, "profit_erosion"))(_g))
    register(f"t4_kruskal_erosion_by_{_g}", kruskal_sql(_g), ["h_stat", "epsilon_squared"])(
        (lambda g: lambda spark, sf: S.kruskal_table(returned_items(spark, sf, with_orders=False), g, "profit_erosion"))(_g))

register("t7_dunn_z_by_category", with_features(_ret_sql("category") + """,
rk AS (SELECT g, x, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rk FROM r),
per AS (SELECT g, count(*) AS n, sum(rk) / count(*) AS mr FROM rk GROUP BY g),
ties AS (SELECT sum(CAST(c AS DOUBLE) ^ 3 - c) AS tie_sum FROM (SELECT count(*) AS c FROM r GROUP BY x)),
nn AS (SELECT sum(n) AS nt FROM per)
SELECT a.g AS group_a, b.g AS group_b,
  CASE WHEN a.g = b.g THEN 0.0 ELSE abs(a.mr - b.mr) / sqrt((CAST(nt AS DOUBLE) * (nt + 1) / 12.0
       - tie_sum / (12.0 * (nt - 1))) * (1.0 / a.n + 1.0 / b.n)) END AS z
FROM per a CROSS JOIN per b CROSS JOIN ties CROSS JOIN nn"""), ["z"])(
    lambda spark, sf: S.dunn_z(returned_items(spark, sf, with_orders=False), "category", "profit_erosion"))

register("t5_normality_jb_by_category", with_features(_ret_sql("category") + """,
mm AS (SELECT g, avg(x) AS mu FROM r GROUP BY g),
c AS (SELECT r.g, count(*) AS n, avg((x - mu) ^ 2) AS m2, avg((x - mu) ^ 3) AS m3, avg((x - mu) ^ 4) AS m4
      FROM r JOIN mm ON r.g = mm.g GROUP BY r.g)
SELECT g AS category, n, n / 6.0 * ((m3 / m2 ^ 1.5) ^ 2 + (m4 / m2 ^ 2 - 3) ^ 2 / 4.0) AS jb_stat,
       exp(-(n / 6.0 * ((m3 / m2 ^ 1.5) ^ 2 + (m4 / m2 ^ 2 - 3) ^ 2 / 4.0)) / 2.0) AS p_value,
       n >= 3 AND exp(-(n / 6.0 * ((m3 / m2 ^ 1.5) ^ 2 + (m4 / m2 ^ 2 - 3) ^ 2 / 4.0)) / 2.0) >= 0.05 AS normal
FROM c"""), ["jb_stat", "p_value"])(
    lambda spark, sf: S.normality_gate(returned_items(spark, sf, with_orders=False), "category", "profit_erosion"))

register("t5_shapiro_wilk_by_category", None)(
    lambda spark, sf: S.shapiro_wilk(returned_items(spark, sf, with_orders=False), "category", "profit_erosion"))

register("t12_point_biserial_price_returned", with_features("""
SELECT corr(sale_price, CAST(is_returned_item AS DOUBLE)) AS r, count(*) AS n FROM f"""), ["r"])(
    lambda spark, sf: _pb(spark, sf))


def _pb(spark, sf):
    r = S.point_biserial(featured_items(spark, sf, with_orders=False), "sale_price", "is_returned_item")
    return spark.createDataFrame([(float(r["r"]), int(r["n"]))], "r double, n long")


register("t12_point_biserial_pvalue", None)(
    lambda spark, sf: spark.createDataFrame(
        [tuple(float(v) for v in S.point_biserial(featured_items(spark, sf, with_orders=False), "sale_price",
                                                   "is_returned_item").values())],
        "r double, n double, p_value double"))

_CE = CUSTOMER_EROSION_SQL.replace("SELECT user_id", "ce AS (SELECT user_id", 1) + ")"
register("t13_pearson_spearman_sales_erosion", with_features(_CE + """,
rk AS (SELECT total_sales AS x, total_profit_erosion AS y,
       rank() OVER (ORDER BY total_sales) + (count(*) OVER (PARTITION BY total_sales) - 1) / 2.0 AS rx,
       rank() OVER (ORDER BY total_profit_erosion)
       + (count(*) OVER (PARTITION BY total_profit_erosion) - 1) / 2.0 AS ry FROM ce)
SELECT corr(x, y) AS pearson, corr(rx, ry) AS spearman, count(*) AS n FROM rk"""),
         ["pearson", "spearman"])(
    lambda spark, sf: S.spearman(A.profit_erosion_by_customer(returned_items(spark, sf)),
                                 "total_sales", "total_profit_erosion", "user_id"))

# full records with p-values (DuckDB has no distribution functions: rows-only)
for _g in ("category", "brand"):
    register(f"t1_run_factor_{_g}", None)(
        (lambda g: lambda spark, sf: S.run_factor(returned_items(spark, sf, with_orders=False), g)[0])(_g))
register("t1_posthoc_category", None)(
    lambda spark, sf: S.run_factor(returned_items(spark, sf, with_orders=False), "category")[1])
register("t2_anova_pvalue_by_category", None)(
    lambda spark, sf: spark.createDataFrame(
        [tuple(float(v) for v in S.anova(returned_items(spark, sf, with_orders=False), "category", "profit_erosion").values())],
        "k double, n double, ss_between double, ss_within double, f_stat double, eta_squared double, "
        "p_value double"))
register("t4_kruskal_pvalue_by_category", None)(
    lambda spark, sf: spark.createDataFrame(
        [tuple(float(v) for v in S.kruskal(returned_items(spark, sf, with_orders=False), "category", "profit_erosion")
               .values())], "k double, n double, h_stat double, epsilon_squared double, p_value double"))
register("t6_tukey_hsd_by_category", None)(
    lambda spark, sf: S.tukey_hsd(returned_items(spark, sf, with_orders=False), "category", "profit_erosion"))
register("t7_dunn_by_category", None)(
    lambda spark, sf: S.dunn(returned_items(spark, sf, with_orders=False), "category", "profit_erosion"))
register("t8_bootstrap_mean_ci_by_category", None)(
    lambda spark, sf: S.bootstrap_mean_ci(
        returned_items(spark, sf, ["line_number"], with_orders=False).withColumn(
            "_rid", F.xxhash64("order_item_id")), "category", "profit_erosion", "_rid"))
