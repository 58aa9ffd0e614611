"""Registry of queries: every registered operator as (Spark job, DuckDB twin).

``QUERIES[name] = Entry(spark_fn, sql, doubles, digits)``.  The Spark
function reads the driver tables under ``sf_dir`` (whole tables, no
sampling) and returns a DataFrame; ``sql`` is the same computation in
DuckDB SQL over the pre-registered views.  Doubles are rounded half-even
on both sides (``digits``, default 4) so a value hash compares equal
numbers; an entry without SQL is checked on rows only.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.operators import features as FE
from losslens.plans.sqlkit import round_spark, round_sql
from losslens.sources.adapter import DRIVER_TIERS, items


@dataclass
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list = field(default_factory=list)
    digits: dict = field(default_factory=dict)
    ints: list = field(default_factory=list)
    scale: dict = field(default_factory=dict)
    ts: list = field(default_factory=list)


QUERIES: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, doubles=(), digits=None, ints=(), scale=None, ts=()):
    def deco(fn):
        QUERIES[name] = Entry(fn, sql, list(doubles), dict(digits or {}), list(ints), dict(scale or {}),
                              list(ts))
        return fn
    return deco


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    e = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_spark(e.fn(spark, sf_dir), e.digits, scale=e.scale)
    run.__name__ = name
    return run


def oracle(name: str) -> str | None:
    e = QUERIES[name]
    if e.sql is None:
        return None
    return round_sql(e.sql, e.doubles, e.digits, e.ints, scale=e.scale, ts_cols=e.ts)


# ---------------------------------------------------------------- helpers
ITEM_CORE = ["order_item_id", "order_id", "product_id", "item_status", "retail_price",
             "sale_price", "cost", "category", "brand", "department"]
ORDER_INPUT = ["user_id", "order_status"]
ITEM_FEATURE_INPUT = ITEM_CORE + ORDER_INPUT


def featured_items(spark: SparkSession, sf_dir: str, extra=(), with_orders: bool = True,
                   returned_only: bool = False) -> DataFrame:
    """Item grain + P3 / P4 / P5 (driver tier map on the category).

    ``with_orders=False`` leaves out the customer / order-status columns, and
    with them the lineitem x orders join (the largest shuffle at scale), for
    product-level queries that never use them.
    """
    base = ITEM_FEATURE_INPUT if with_orders else ITEM_CORE
    cols = list(dict.fromkeys(base + list(extra)))
    return FE.add_item_features(items(spark, sf_dir, cols, returned_only=returned_only),
                                category_multipliers=DRIVER_TIERS)


def returned_items(spark: SparkSession, sf_dir: str, extra=(), with_orders: bool = True) -> DataFrame:
    # the scan-level predicate prunes non-returned lines before the joins;
    # the flag filter states the semantics (and is a no-op after it)
    return featured_items(spark, sf_dir, extra, with_orders, True).where(F.col("is_returned_item") == 1)
