"""Second data domain: B2B-style return lines built from the driver tables

Columns follow the external export the operators expect (names with
blanks are kept and quoted where used).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.sources.adapter import items


def external_lines(spark: SparkSession, sf_dir: str, reference_date: bool = True) -> DataFrame:
    """``reference_date=False``: without the orders' date, and so without the
    join that only this date needs (the column is null)."""
    columns = ["order_item_id", "order_id", "supplier_id", "item_status", "retail_price", "sale_price", "cost", "quantity",
               "item_shipped_at", "item_delivered_at", "category", "brand", "department"]
    it = items(spark, sf_dir, columns + ["order_created_at"] * reference_date)
    if not reference_date:
        it = it.withColumn("order_created_at", F.lit(None).cast("timestamp"))
    # lines are counted on bare lineitem, not on the joined table
    per_order = items(spark, sf_dir, ["order_id"]).groupBy("order_id").agg(F.count(F.lit(1)).alias("Lines Per Order"))
    ret = F.col("item_status") == "Returned"
    return it.join(per_order, ["order_id"], "left").select(
        F.col("supplier_id").alias("Bill To Act #"),
        F.col("order_id").alias("Order Number"),
        F.col("order_item_id").alias("Order Line ID"),
        F.col("item_shipped_at").alias("Booked Date"),
        F.col("item_delivered_at").alias("Billed Date"),
        F.col("order_created_at").alias("Reference Booked Date"),
        F.when(ret, "RETURN").otherwise("ORDER").alias("Sales_Type"),
        F.when(ret, -F.col("quantity")).otherwise(F.col("quantity")).alias("Ordered Qty"),
        F.col("Lines Per Order"),
        F.col("retail_price").alias("Reference Sale Amount"),
        F.when(ret, -F.col("sale_price")).otherwise(F.lit(0.0)).alias("CreditReturn Sales"),
        F.col("cost").alias("Product Cost"),
        (F.col("sale_price") - F.col("cost")).alias("gross_financial_loss"),
        (F.col("sale_price") - F.col("cost")).alias("total_loss"),
        F.col("category").alias("Pillar"),
        F.col("brand").alias("Major Market Cat"),
        F.col("department").alias("Department"))


EXTERNAL_LINES_SQL = """
ext AS (
  SELECT l.l_suppkey AS "Bill To Act #", l.l_orderkey AS "Order Number",
         concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS "Order Line ID",
         l.l_shipdate AS "Booked Date",
         CASE WHEN l.l_returnflag = 'R' THEN 'RETURN' ELSE 'ORDER' END AS "Sales_Type",
         CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS "Ordered Qty",
         lpo.n AS "Lines Per Order", l.l_extendedprice AS "Reference Sale Amount",
         CASE WHEN l.l_returnflag = 'R' THEN -(l.l_extendedprice * (1 - l.l_discount)) ELSE 0.0 END
           AS "CreditReturn Sales",
         l.l_extendedprice * (1 - l.l_discount) - l.l_quantity * p.p_retailprice * CAST(0.5 AS DOUBLE)
           AS gross_financial_loss,
         l.l_extendedprice * (1 - l.l_discount) - l.l_quantity * p.p_retailprice * CAST(0.5 AS DOUBLE)
           AS total_loss,
         p.p_type AS "Pillar", p.p_brand AS "Major Market Cat",
         CASE WHEN p.p_size <= 25 THEN 'Small' ELSE 'Large' END AS "Department"
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) lpo ON l.l_orderkey = lpo.l_orderkey
)"""
