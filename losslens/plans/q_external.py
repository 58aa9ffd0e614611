"""Catalog entries: external domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators import external as EX
from losslens.operators import joins as J
from losslens.plans.registry import register
from losslens.sources.external import EXTERNAL_LINES_SQL, external_lines


def _ext_sql(body: str) -> str:
    return "WITH " + EXTERNAL_LINES_SQL + ",\n" + body.strip().lstrip(",")


def lines(spark, sf):
    # no query of these uses the orders' date
    return EX.preprocess(EX.load_lines(external_lines(spark, sf, reference_date=False)))


_PRE = """pre AS (SELECT *, coalesce("Ordered Qty" < 0, false) OR coalesce("CreditReturn Sales" < 0, false)
                AS "Returns", abs(total_loss) AS total_loss_abs FROM ext WHERE "Bill To Act #" IS NOT NULL)"""

register("p15_external_preprocess_counts", _ext_sql(_PRE + """
SELECT "Returns", count(*) AS lines, sum(total_loss_abs) AS total_loss FROM pre
WHERE total_loss_abs IS NOT NULL GROUP BY 1"""), ["total_loss"])(
    lambda spark, sf: lines(spark, sf).groupBy("Returns").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("total_loss").alias("total_loss")))

register("a14_external_group_metrics", _ext_sql(_PRE + """,
b AS (SELECT CAST("Returns" AS INTEGER) AS r, total_loss_abs AS e,
      concat_ws('-', trim(coalesce(CAST("Pillar" AS VARCHAR), 'Unknown')),
                trim(coalesce(CAST("Major Market Cat" AS VARCHAR), 'Unknown')),
                trim(coalesce(CAST("Department" AS VARCHAR), 'Unknown'))) AS category FROM pre)
SELECT category, sum(e) FILTER (WHERE r = 1) AS total_profit_erosion,
       count(e) FILTER (WHERE r = 1) AS returned_items,
       avg(e) FILTER (WHERE r = 1) AS mean_profit_erosion_per_return, avg(r) AS return_rate,
       avg(e) FILTER (WHERE r = 1) AS avg_profit_erosion
FROM b GROUP BY category HAVING count(*) FILTER (WHERE r = 1) > 0"""),
         ["total_profit_erosion", "mean_profit_erosion_per_return", "return_rate", "avg_profit_erosion"])(
    lambda spark, sf: EX.group_metrics(EX.canonical_base(lines(spark, sf))))

_ACC_SQL = _PRE + """,
ln AS (SELECT "Bill To Act #" AS account_id, "Order Number" AS o, "Order Line ID" AS li, "Booked Date" AS d,
       CAST("Sales_Type" = 'RETURN' AS INTEGER) AS r, "Lines Per Order" AS lpo, "Reference Sale Amount" AS ref,
       gross_financial_loss AS gfl, total_loss_abs AS loss,
       CASE WHEN abs("Ordered Qty") > 0 AND "Reference Sale Amount" IS NOT NULL AND "Reference Sale Amount" > 0
            THEN "Reference Sale Amount" / abs("Ordered Qty")
            WHEN "Sales_Type" = 'RETURN' AND abs("Ordered Qty") > 0
            THEN abs("CreditReturn Sales") / abs("Ordered Qty") END AS price FROM pre),
mx AS (SELECT max(d) AS maxd FROM ln),
ov AS (SELECT account_id, avg(s) AS avg_order_value FROM (SELECT account_id, o, sum(ref) AS s FROM ln GROUP BY ALL)
       GROUP BY 1),
acc AS (SELECT ln.account_id, count(DISTINCT o) AS order_frequency, CAST(sum(r) AS BIGINT) AS return_frequency,
        avg(lpo) AS avg_basket_size, count(li) AS total_items, sum(ref) AS total_sales, sum(gfl) AS total_margin,
        avg(price) AS avg_item_price, avg(gfl) AS avg_item_margin, sum(loss) AS total_loss,
        sum(r) / count(li) AS customer_return_rate,
        CAST(floor((epoch_us(max(d)) - epoch_us(min(d))) / 86400000000) AS BIGINT) AS customer_tenure_days,
        CAST(floor((epoch_us(any_value(maxd)) - epoch_us(max(d))) / 86400000000) AS BIGINT) AS purchase_recency_days,
        any_value(ov.avg_order_value) AS avg_order_value
        FROM ln CROSS JOIN mx LEFT JOIN ov ON ln.account_id = ov.account_id GROUP BY ln.account_id)"""
_ACC_D = ["avg_basket_size", "total_sales", "total_margin", "avg_item_price", "avg_item_margin", "total_loss",
          "customer_return_rate", "avg_order_value"]


def accounts(spark, sf):
    return EX.account_features(lines(spark, sf))


register("a15_external_account_features", _ext_sql(_ACC_SQL + "\nSELECT * FROM acc"), _ACC_D)(accounts)

register("m18_external_targets", _ext_sql(_ACC_SQL + """,
t AS (SELECT quantile_cont(total_loss, 0.75) AS thr FROM acc)
SELECT account_id, total_loss, CAST(total_loss >= thr AS INTEGER) AS is_high_erosion_customer
FROM acc CROSS JOIN t"""), ["total_loss"], ints=["is_high_erosion_customer"])(
    lambda spark, sf: EX.targets(accounts(spark, sf)).select("account_id", "total_loss",
                                                             "is_high_erosion_customer"))

register("a16_external_dominant_category", _ext_sql(_PRE + """,
c AS (SELECT "Bill To Act #" AS account_id, "Pillar" AS pillar, count(*) AS n FROM pre
      WHERE "Returns" AND "Pillar" IS NOT NULL GROUP BY ALL)
SELECT account_id, arg_min(pillar, (-n, pillar)) AS dominant_return_category FROM c GROUP BY 1"""))(
    lambda spark, sf: J.dominant_value(
        lines(spark, sf).where(F.col("Returns")).select(
            F.col("`Bill To Act #`").alias("account_id"), F.col("Pillar").alias("pillar")),
        "account_id", "pillar", "dominant_return_category"))

_RF = ["return_frequency", "avg_basket_size", "purchase_recency_days", "order_frequency", "avg_order_value",
       "customer_tenure_days", "customer_return_rate", "age"]
register("p19_external_regression_features", _ext_sql(_ACC_SQL + """
SELECT account_id, total_loss AS total_profit_erosion, return_frequency, avg_basket_size, purchase_recency_days,
       order_frequency, avg_order_value, customer_tenure_days, customer_return_rate, 0.0 AS age FROM acc"""),
         ["total_profit_erosion", "avg_basket_size", "avg_order_value", "customer_return_rate", "age"])(
    lambda spark, sf: EX.regression_features(accounts(spark, sf), _RF, "median").select(
        "account_id", "total_profit_erosion", *_RF))
