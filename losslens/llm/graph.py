"""Connected components of an edge table, in Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.common import checkpoint


def star_components(edges: DataFrame) -> DataFrame:
    """Components of edges (u, v) as (u, root): every node but the smallest
    of a component, with that smallest node.

    Alternating large and small stars.  Each round is two partially
    aggregated minima and one join; the table never holds more rows than
    edges, and a node with very many neighbours only loads the join, where
    skewed partitions are split.  Self-loops are ignored.
    """
    e = checkpoint(edges.select("u", "v").where("u <> v").distinct())
    seen = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every edge now points to a smaller node
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v"))))
        e = checkpoint(small.distinct())
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(now) == seen:
            return e.withColumnRenamed("v", "root")
        seen = tuple(now)
