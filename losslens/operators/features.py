"""
erosion, temporal fields, guards and model-ready views.

All are narrow transformations: no shuffle, one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.functions import exprs as X

# Leakage columns at item level.
ITEM_LEAKAGE_COLUMNS = ["item_returned_at", "order_returned_at", "item_status", "order_status"]


def require_columns(df: DataFrame, required, context: str = "") -> None:
    """Driver-side guard on the schema (free, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"[{context}] missing required columns: {missing}")


def engineer_return_features(df: DataFrame) -> DataFrame:
    """``is_returned_item`` / ``is_returned_order`` from status text."""
    out = df.withColumn("is_returned_item", X.returned_flag("item_status"))
    if "order_status" in df.columns:
        out = out.withColumn("is_returned_order", X.returned_flag("order_status"))
    return out


def calculate_margins(df: DataFrame) -> DataFrame:
    """Discount and margin columns; percent fields guarded by den > 0."""
    d = df.withColumns({
        "retail_price": F.col("retail_price").try_cast("double"),
        "sale_price": F.col("sale_price").try_cast("double"),
        "cost": F.col("cost").try_cast("double"),
    })
    d = d.withColumns({
        "discount_amount": F.col("retail_price") - F.col("sale_price"),
        "item_margin": F.col("sale_price") - F.col("cost"),
    })
    return d.withColumns({
        "discount_pct": X.safe_ratio("discount_amount", "retail_price"),
        "item_margin_pct": X.safe_ratio("item_margin", "sale_price"),
    })


def calculate_profit_erosion(df: DataFrame, cost_components: dict | None = None,
                             category_multipliers: dict | None = None,
                             use_category_tiers: bool = True) -> DataFrame:
    """P5: margin_reversal + base cost x category tier (constant map, no join)."""
    comps = X.DEFAULT_COST_COMPONENTS if cost_components is None else cost_components
    base = float(sum(comps.values()))
    if use_category_tiers and "category" in df.columns:
        cost = F.lit(base) * X.tier_multiplier("category", category_multipliers)
    else:
        cost = F.lit(base)
    return (df.withColumn("margin_reversal", F.col("item_margin"))
              .withColumn("process_cost", cost)
              .withColumn("profit_erosion", F.col("margin_reversal") + F.col("process_cost")))


def scale_cost_components(components: dict, target_total: float) -> dict:
    """Scale components to a new total, each rounded to 4 places."""
    total = sum(components.values())
    return {k: round(v * target_total / total, 4) for k, v in components.items()}


def engineer_temporal_features(df: DataFrame) -> DataFrame:
    """Calendar parts, weekend flag, season, floored day differences."""
    out = df
    if "order_created_at" in df.columns:
        ts = F.col("order_created_at").cast("timestamp")
        out = out.withColumns({
            "order_day_of_week": X.weekday_mon0(ts),
            "order_month": F.month(ts),
            "order_quarter": F.quarter(ts),
            "order_year": F.year(ts),
        })
        out = out.withColumns({
            "is_weekend_order": F.col("order_day_of_week").isin(5, 6),
            "season": X.season("order_month"),
        })
    if "order_created_at" in df.columns and "item_delivered_at" in df.columns:
        out = out.withColumn("days_to_delivery",
                             X.day_floor_diff("item_delivered_at", "order_created_at"))
    if "item_delivered_at" in df.columns and "item_returned_at" in df.columns:
        # float like pandas: ``.dt.days`` of a missing return date is NaN
        out = out.withColumn("days_to_return",
                             X.day_floor_diff("item_returned_at", "item_delivered_at").cast("double"))
    return out


def ensure_return_flag(df: DataFrame, mode: str = "any") -> DataFrame:
    """Derive ``is_returned_item`` from return dates when missing.

    ``mode='first'``: first existing of item / order return date;
    ``mode='any'``: OR of all existing dates (D11).
    """
    if "is_returned_item" in df.columns:
        return df.withColumn("is_returned_item",
                             F.coalesce(F.col("is_returned_item").cast("int"), F.lit(0)))
    cands = [c for c in ("item_returned_at", "order_returned_at") if c in df.columns]
    if not cands:
        raise ValueError("cannot derive is_returned_item: no return date column")
    if mode == "first":
        flag = F.col(cands[0]).isNotNull()
    else:
        flag = F.lit(False)
        for c in cands:
            flag = flag | F.col(c).isNotNull()
    return df.withColumn("is_returned_item", flag.cast("int"))


def ensure_item_margin(df: DataFrame) -> DataFrame:
    """P10."""
    if "item_margin" in df.columns:
        return df
    require_columns(df, ["sale_price", "cost"], "ensure_item_margin")
    return df.withColumn("item_margin", F.col("sale_price") - F.col("cost"))


def ensure_profit_erosion(df: DataFrame) -> DataFrame:
    """Margin-only fallback (D10): item margin on returns, else 0."""
    if "profit_erosion" in df.columns:
        return df
    d = ensure_item_margin(ensure_return_flag(df))
    return d.withColumn("profit_erosion",
                        F.when(F.col("is_returned_item") == 1, F.col("item_margin"))
                        .otherwise(F.lit(0.0)))


def drop_leakage_columns_item_level(df: DataFrame) -> DataFrame:
    """P12."""
    return df.drop(*[c for c in ITEM_LEAKAGE_COLUMNS if c in df.columns])


def build_customer_modeling_dataset(customer: DataFrame, count_col: str = "return_rows") -> DataFrame:
    """P20: customer erosion summary + ``has_returns``."""
    require_columns(customer, ["user_id", count_col], "customer_modeling")
    return customer.withColumn("has_returns", (F.col(count_col) > 0).cast("int"))


def item_return_classification_base(df: DataFrame) -> DataFrame:
    """Leak-free item view for return classification."""
    return drop_leakage_columns_item_level(ensure_return_flag(df))


def returned_item_regression_base(df: DataFrame, date_cols=None) -> DataFrame:
    """Returned items only, date columns dropped, null target removed."""
    d = ensure_profit_erosion(ensure_return_flag(df))
    d = d.where(F.col("is_returned_item") == 1)
    dates = date_cols or [c for c, t in d.dtypes if t in ("timestamp", "date", "timestamp_ntz")]
    return drop_leakage_columns_item_level(d.drop(*dates)).dropna(subset=["profit_erosion"])


def segment_by_return_rate(profile: DataFrame, low: float = 0.05, high: float = 0.15,
                           rate_col: str = "customer_return_rate") -> DataFrame:
    """None / low / moderate / high returner labels."""
    r = F.col(rate_col)
    seg = (F.when(r == 0, "no_returns").when(r <= low, "low_returner")
           .when(r <= high, "moderate_returner").when(r > high, "high_returner")
           .otherwise("unknown"))
    return profile.withColumn("return_segment", seg)


def add_item_features(df: DataFrame, **erosion_kwargs) -> DataFrame:
    """P3 + P4 + P5 on the item grain (erosion only meaningful on returns)."""
    return calculate_profit_erosion(calculate_margins(engineer_return_features(df)),
                                    **erosion_kwargs)
