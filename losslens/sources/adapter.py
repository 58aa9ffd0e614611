"""

``items(spark, sf_dir, columns)`` joins only the dimensions the requested
columns need: a left join cannot be removed by the optimizer, so a query
that never touches customer attributes must not pay for that join.

Join strategy at scale: customers are joined to the orders, not to the items,
and lineitem x orders is fact x fact (sort-merge on the order key, both sides
shuffled once).  ``part``, which comes first, and the customer dimension are
joined without hints: the planner broadcasts them only
while their statistics stay under ``spark.sql.autoBroadcastJoinThreshold``
and AQE re-plans on measured sizes; beyond that a sort-merge join is used.
``nation`` (25 rows) and ``region`` (5 rows) are fixed-size and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.sources.tables import read_table

# fixed status code mappings of the adapter
ITEM_STATUS = {"R": "Returned", "A": "Complete", "N": "Shipped"}
ORDER_STATUS = {"F": "Complete", "O": "Shipped", "P": "Processing"}
# adapter tier map on p_type (premium 1.3, moderate 1.15, rest 1.0)
DRIVER_TIERS = {"PROMO": 1.3, "LARGE": 1.15, "MEDIUM": 1.15}

LINE_COLS = ["order_item_id", "order_id", "product_id", "supplier_id", "line_number",
             "item_status", "retail_price", "sale_price", "discount", "quantity",
             "item_shipped_at", "item_delivered_at", "item_returned_at"]
ORDER_COLS = ["user_id", "order_status", "order_created_at", "order_priority"]
PART_COLS = ["cost", "category", "brand", "department"]
USER_COLS = ["country", "state", "traffic_source", "age", "user_created_at"]
ALL_ITEM_COLUMNS = LINE_COLS + ORDER_COLS + PART_COLS + USER_COLS


def _case(colname: str, mapping: dict):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(colname) == k, v) if expr is None
                else expr.when(F.col(colname) == k, v))
    return expr


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, user_created_at) of customers with an order."""
    return (read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
            .groupBy(F.col("o_custkey").alias("user_id")).agg(F.min("o_orderdate").alias("user_created_at")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension: customer x nation x region + first order date."""
    cust = read_table(spark, sf_dir, "customer",
                      ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    first = (read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
             .groupBy("o_custkey").agg(F.min("o_orderdate").alias("user_created_at")))
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
    return (cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey, "left")
            .join(first, cust.c_custkey == first.o_custkey, "left")
            .select(F.col("c_custkey").alias("u_id"),
                    F.col("n_name").alias("country"),
                    F.col("r_name").alias("state"),
                    F.col("c_mktsegment").alias("traffic_source"),
                    F.col("c_acctbal").alias("age"),
                    "user_created_at"))


def items(spark: SparkSession, sf_dir: str, columns: list[str] | None = None,
          returned_only: bool = False, distinct: bool = False) -> DataFrame:
    """Canonical item-grain DataFrame with the requested columns.

    ``returned_only`` keeps returned lines with a plain ``l_returnflag = 'R'``
    predicate on the lineitem scan, so it reaches the parquet reader
    (PushedFilters) and runs before any join; a filter written on the
    derived ``lower(item_status)`` cannot be pushed that far.

    ``distinct`` gives each distinct row of order and customer columns once; the
    lines of an order become one before the orders are joined.
    """
    want = list(columns or ALL_ITEM_COLUMNS)
    unknown = set(want) - set(ALL_ITEM_COLUMNS)
    if unknown:
        raise ValueError(f"unknown item columns: {sorted(unknown)}")
    need_users = any(c in USER_COLS for c in want)
    need_orders = need_users or any(c in ORDER_COLS for c in want)
    need_part = any(c in PART_COLS for c in want)

    li = read_table(spark, sf_dir, "lineitem")
    if returned_only:
        li = li.where(F.col("l_returnflag") == "R")
    if distinct:
        if need_part or set(want) & (set(LINE_COLS) - {"order_id"}):
            raise ValueError("distinct items have order and customer columns only")
        li = li.select("l_orderkey").distinct()
    if need_part:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
        li = li.join(part, li.l_partkey == part.p_partkey, "left")
    if need_orders:
        orders = read_table(spark, sf_dir, "orders").select(
            F.col("o_orderkey"), F.col("o_custkey").alias("user_id"), "o_orderstatus",
            F.col("o_orderdate").alias("order_created_at"), F.col("o_orderpriority").alias("order_priority"))
        if need_users:
            u = users(spark, sf_dir)
            orders = orders.join(u, orders.user_id == u.u_id, "left").drop("u_id")
        li = li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
    # derived after the joins, so that the shuffles carry the plain columns
    delivered = F.timestamp_add("DAY", F.col("l_linenumber"), F.col("l_shipdate"))
    derived = {
        "order_item_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "order_id": F.col("l_orderkey"),
        "product_id": F.col("l_partkey"),
        "supplier_id": F.col("l_suppkey"),
        "line_number": F.col("l_linenumber"),
        "item_status": _case("l_returnflag", ITEM_STATUS),
        "retail_price": F.col("l_extendedprice"),
        "sale_price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "discount": F.col("l_discount"),
        "quantity": F.col("l_quantity"),
        "item_shipped_at": F.col("l_shipdate"),
        "item_delivered_at": delivered,
        "item_returned_at": F.when(F.col("l_returnflag") == "R",
                                   F.timestamp_add("DAY", F.col("l_quantity").cast("int"), delivered)),
        "order_status": _case("o_orderstatus", ORDER_STATUS),
        "cost": F.col("l_quantity") * F.col("p_retailprice") * 0.5,
        "category": F.col("p_type"),
        "brand": F.col("p_brand"),
        "department": F.when(F.col("p_size") <= 25, "Small").when(F.col("p_partkey").isNotNull(), "Large"),
    }
    out = li.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in want])
    return out.distinct() if distinct and want != ["order_id"] else out


def assert_unique_key(df: DataFrame, key: str, name: str) -> None:
    """Q19: a dimension declared many-to-one must have a unique key."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("d")).first()
    if row["n"] != row["d"]:
        raise ValueError(f"{name}: key {key} is not unique ({row['n']} rows, {row['d']} keys)")


# DuckDB twin of ``items`` used by the oracle SQL (same expressions).
ITEMS_SQL = """
items AS (
  SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS order_item_id,
         l.l_orderkey AS order_id, l.l_partkey AS product_id, l.l_suppkey AS supplier_id,
         l.l_linenumber AS line_number,
         CASE l.l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Complete'
              WHEN 'N' THEN 'Shipped' END AS item_status,
         l.l_extendedprice AS retail_price,
         l.l_extendedprice * (1 - l.l_discount) AS sale_price,
         l.l_discount AS discount, l.l_quantity AS quantity,
         l.l_shipdate AS item_shipped_at,
         l.l_shipdate + to_days(CAST(l.l_linenumber AS INTEGER)) AS item_delivered_at,
         CASE WHEN l.l_returnflag = 'R' THEN l.l_shipdate + to_days(CAST(l.l_linenumber AS INTEGER))
              + to_days(CAST(l.l_quantity AS INTEGER)) END AS item_returned_at,
         o.o_custkey AS user_id,
         CASE o.o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Shipped'
              WHEN 'P' THEN 'Processing' END AS order_status,
         o.o_orderdate AS order_created_at, o.o_orderpriority AS order_priority,
         l.l_quantity * p.p_retailprice * CAST(0.5 AS DOUBLE) AS cost,
         p.p_type AS category, p.p_brand AS brand,
         CASE WHEN p.p_size <= 25 THEN 'Small' ELSE 'Large' END AS department,
         n.n_name AS country, r.r_name AS state, c.c_mktsegment AS traffic_source,
         c.c_acctbal AS age, fo.user_created_at
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS user_created_at FROM orders GROUP BY 1) fo
         ON o.o_custkey = fo.o_custkey
)"""
