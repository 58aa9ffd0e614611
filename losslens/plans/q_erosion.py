"""Catalog entries: product erosion tables."""

from __future__ import annotations

from losslens.operators import aggregates as A
from losslens.plans.registry import featured_items, register
from losslens.plans.sqlkit import with_features

EROSION_DOUBLES = ["return_rate", "total_profit_erosion", "mean_profit_erosion_per_return",
                   "median_profit_erosion_per_return", "var_profit_erosion_per_return",
                   "total_margin_reversal", "total_process_cost"]
EROSION_DIGITS: dict = {}


def _erosion_sql(col: str, min_rows: int = 200) -> str:
    return with_features(f"""
SELECT {col}, count(*) AS item_rows, CAST(sum(is_returned_item) AS BIGINT) AS returned_items,
  sum(is_returned_item) / count(*) AS return_rate,
  CASE WHEN count(*) FILTER (WHERE is_returned_item = 1) > 0
       THEN count(*) FILTER (WHERE is_returned_item = 1) END AS returned_item_rows,
  sum(profit_erosion) FILTER (WHERE is_returned_item = 1) AS total_profit_erosion,
  avg(profit_erosion) FILTER (WHERE is_returned_item = 1) AS mean_profit_erosion_per_return,
  quantile_cont(profit_erosion, 0.5) FILTER (WHERE is_returned_item = 1) AS median_profit_erosion_per_return,
  var_samp(profit_erosion) FILTER (WHERE is_returned_item = 1) AS var_profit_erosion_per_return,
  sum(margin_reversal) FILTER (WHERE is_returned_item = 1) AS total_margin_reversal,
  sum(process_cost) FILTER (WHERE is_returned_item = 1) AS total_process_cost
FROM f WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) >= {min_rows}""")


def _erosion_query(level: str):
    def fn(spark, sf_dir):
        long = A.product_profit_erosion_metrics(featured_items(spark, sf_dir, with_orders=False),
                                                min_rows=200, levels={f"by_{level}": level})
        return A.erosion_level(long, level)
    return fn


for _lv in ("category", "brand", "department"):
    register(f"a6_erosion_by_{_lv}", _erosion_sql(_lv), EROSION_DOUBLES, EROSION_DIGITS,
             scale={"var_profit_erosion_per_return": 4})(
        _erosion_query(_lv))
