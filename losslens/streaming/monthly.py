"""W14 as a Structured Streaming query (no new operator: the same monthly
return rate, computed incrementally as item lines arrive).

lineitem files are read with ``readStream`` (file source over the table
folder), joined stream-static with the orders dimension for the event
time, and aggregated per month.  The state is one row per month; the
query's checkpoint lives in the session's shared checkpoint folder, so a
restarted driver resumes where it stopped.  ``availableNow`` processes
what is there and stops (batch-style run of a streaming plan).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.session import ensure_checkpoint_dir
from losslens.sources.tables import read_table


def monthly_return_rate_stream(spark: SparkSession, sf_dir: str, name: str | None = None,
                               watermark: str = "400 days") -> DataFrame:
    li_schema = read_table(spark, sf_dir, "lineitem").schema
    lines = (spark.readStream.schema(li_schema).option("pathGlobFilter", "lineitem.parquet")
             .option("maxFilesPerTrigger", 1).parquet(sf_dir)
             .select("l_orderkey", (F.col("l_returnflag") == "R").cast("int").alias("is_returned_item")))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"]).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp"))  # event time must be TIMESTAMP
    ev = (lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
          .withWatermark("o_orderdate", watermark))
    agg = ev.groupBy(F.date_trunc("month", "o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("items"), F.sum("is_returned_item").cast("long").alias("returned_items"))
    qname = name or f"w14_monthly_{uuid.uuid4().hex[:8]}"
    ckpt = os.path.join(ensure_checkpoint_dir(spark), "streams", qname)
    q = (agg.writeStream.outputMode("complete").format("memory").queryName(qname)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.table(qname)
    return out.withColumn("return_rate", F.col("returned_items") / F.col("items"))
