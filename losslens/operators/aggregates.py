"""

Every table is one ``groupBy().agg()`` with partial (map-side) aggregation;
medians / percentiles come from the skew-safe exact primitive in
``ordered`` and are joined back on the (small) group key.  pandas
``groupby`` drops null keys (Q1): keys are filtered unless stated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from losslens.functions import exprs as X
from losslens.operators import features as FE
from losslens.operators.ordered import column_quantiles, group_quantiles
from losslens.session import cut_lineage, stored


def _ret() -> Column:
    return F.col("is_returned_item") == 1


def _nonnull_keys(df: DataFrame, keys) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    return df.where(cond)


def with_medians(agg: DataFrame, src: DataFrame, keys, specs, how: str = "left") -> DataFrame:
    """Join exact quantiles (``specs`` = [(name, col, p)]) onto an aggregate."""
    if not specs:
        return agg
    q = group_quantiles(src, list(keys), specs)
    if not keys:
        return agg.crossJoin(q)  # both sides are one row
    return agg.join(q, list(keys), how)


def return_rates_by_group(df: DataFrame, group_cols, min_rows: int = X.MIN_ROWS_THRESHOLD,
                          dropna: bool = True) -> DataFrame:
    """Rows, returned, rate; groups under ``min_rows`` removed."""
    g = list(group_cols)
    src = _nonnull_keys(df, g) if dropna else df
    out = (src.groupBy(*g)
           .agg(F.count(F.lit(1)).alias("item_rows"),
                F.sum("is_returned_item").cast("long").alias("returned_items"))
           .withColumn("return_rate", F.col("returned_items") / F.col("item_rows")))
    return out.where(F.col("item_rows") >= min_rows)


def margin_loss_by_group(df: DataFrame, group_cols) -> DataFrame:
    """A2: returned items only; counts, sums, median, mean of margin."""
    g = list(group_cols)
    r = _nonnull_keys(df.where(_ret()), g)
    agg = r.groupBy(*g).agg(
        F.count("order_id").alias("returned_items"),
        F.sum("sale_price").alias("total_lost_sales"),
        F.sum("item_margin").alias("total_lost_margin"),
        F.avg("item_margin").alias("avg_margin_per_return"))
    return with_medians(agg, r, g, [("median_margin_per_return", "item_margin", 0.5)])


def customer_margin_exposure(df: DataFrame) -> DataFrame:
    """A3: per customer, returned items only."""
    r = _nonnull_keys(df.where(_ret()), ["user_id"])
    agg = r.groupBy("user_id").agg(
        F.count("order_id").alias("return_events"),
        F.sum("item_margin").alias("total_lost_margin"),
        F.sum("sale_price").alias("total_lost_sales"),
        F.max("item_margin").alias("max_single_return_margin"))
    return with_medians(agg, r, ["user_id"], [("median_margin_per_return", "item_margin", 0.5)])


def price_margin_returned_by_country(df: DataFrame) -> DataFrame:
    """A4: ten measures per country on returned items, half-even 2 places.

    Returned is tested on ``lower(item_status)`` (D5).
    """
    r = _nonnull_keys(df.where(F.lower("item_status") == "returned"), ["country"])
    agg = r.groupBy("country").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.avg("cost").alias("avg_cost"), F.sum("cost").alias("total_cost"),
        F.avg("sale_price").alias("avg_sale_price"), F.sum("sale_price").alias("total_sale_price"),
        F.avg("item_margin").alias("avg_margin"), F.sum("item_margin").alias("total_margin"),
        F.min("item_margin").alias("min_margin"), F.max("item_margin").alias("max_margin"))
    out = with_medians(agg, r, ["country"], [("median_margin", "item_margin", 0.5)])
    return out.select("country", "item_count", *[
        X.rnd(c, 2).alias(c) for c in ["avg_cost", "total_cost", "avg_sale_price",
                                       "total_sale_price", "avg_margin", "total_margin",
                                       "median_margin", "min_margin", "max_margin"]])


EROSION_LEVELS = {"by_category": "category", "by_brand": "brand", "by_department": "department"}


def product_profit_erosion_metrics(df: DataFrame, min_rows: int = X.MIN_ROWS_THRESHOLD,
                                   levels: dict | None = None) -> DataFrame:
    """A6 (+ J2) for several levels in ONE pass: long table keyed by (level, group).

    J2 (group rates LEFT group erosion) is folded in: rates and returned-only
    erosion come from the same ``groupBy`` with filtered aggregates.

    Rate context on all items, erosion measures on returned items only
    (filtered aggregates); erosion columns are null when a group had no
    return (pandas left merge).  ``df`` must carry item features (P3-P5).
    """
    levels = levels or EROSION_LEVELS
    groups = [F.struct(F.lit(lv).alias("level"), F.col(c).cast("string").alias("grp")) for lv, c in levels.items()]
    long = df.select(
        (F.explode(F.array(*groups)) if len(groups) > 1 else groups[0]).alias("_g"),  # one level: no row is doubled
        "is_returned_item", "profit_erosion", "margin_reversal", "process_cost"
    ).select("_g.level", "_g.grp", "is_returned_item", "profit_erosion",
             "margin_reversal", "process_cost").where(F.col("grp").isNotNull())
    ero = F.when(_ret(), F.col("profit_erosion"))
    nret = F.count(F.when(_ret(), F.lit(1)))
    agg = long.groupBy("level", "grp").agg(
        F.count(F.lit(1)).alias("item_rows"),
        F.sum("is_returned_item").cast("long").alias("returned_items"),
        F.when(nret > 0, nret).alias("returned_item_rows"),
        F.sum(ero).alias("total_profit_erosion"),
        F.avg(ero).alias("mean_profit_erosion_per_return"),
        F.var_samp(ero).alias("var_profit_erosion_per_return"),
        F.sum(F.when(_ret(), F.col("margin_reversal"))).alias("total_margin_reversal"),
        F.sum(F.when(_ret(), F.col("process_cost"))).alias("total_process_cost"),
    ).withColumn("return_rate", F.col("returned_items") / F.col("item_rows")) \
     .where(F.col("item_rows") >= min_rows)
    med = group_quantiles(long.where(_ret()), ["level", "grp"],
                          [("median_profit_erosion_per_return", "profit_erosion", 0.5)])
    return agg.join(med, ["level", "grp"], "left")


EROSION_METRIC_COLUMNS = ["item_rows", "returned_items", "return_rate", "returned_item_rows",
                          "total_profit_erosion", "mean_profit_erosion_per_return",
                          "median_profit_erosion_per_return", "var_profit_erosion_per_return",
                          "total_margin_reversal", "total_process_cost"]


def erosion_level(long: DataFrame, level: str) -> DataFrame:
    """One level of A6 as its own table (K1 order: erosion desc, nulls last)."""
    col = (EROSION_LEVELS.get(level) or level)
    lv = level if level in EROSION_LEVELS else f"by_{level}"
    return (long.where(F.col("level") == lv)
            .select(F.col("grp").alias(col), *EROSION_METRIC_COLUMNS)
            .orderBy(F.desc_nulls_last("total_profit_erosion"), col))


def product_return_behavior_metrics(df: DataFrame, min_rows: int = X.MIN_ROWS_THRESHOLD,
                                    levels: dict | None = None) -> DataFrame:
    """Return-rate tables for all levels in one pass, plus validation."""
    levels = levels or EROSION_LEVELS
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(lv).alias("level"), F.col(c).cast("string").alias("grp"))
                            for lv, c in levels.items()])).alias("_g"), "is_returned_item"
    ).select("_g.level", "_g.grp", "is_returned_item")
    return return_rates_by_group(long, ["level", "grp"], min_rows=min_rows)


def validate_return_rate_table(rates: DataFrame) -> DataFrame:
    """A7 check: one aggregate counting each violated rule (0 = valid)."""
    return rates.agg(
        F.count(F.when(F.col("item_rows") <= 0, 1)).alias("non_positive_rows"),
        F.count(F.when(F.col("returned_items") < 0, 1)).alias("negative_returned"),
        F.count(F.when(F.col("returned_items") > F.col("item_rows"), 1)).alias("returned_exceeds_rows"),
        F.count(F.when((F.col("return_rate") < 0) | (F.col("return_rate") > 1), 1)).alias("rate_out_of_range"))


def customer_profit_erosion_summaries(df: DataFrame, min_returns: int = 1) -> DataFrame:
    """Per customer on returned items, ``return_rows >= min_returns``."""
    r = _nonnull_keys(df.where(_ret()), ["user_id"])
    return (r.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("return_rows"),
        F.sum("profit_erosion").alias("total_profit_erosion"),
        F.avg("profit_erosion").alias("avg_profit_erosion_per_return"))
        .where(F.col("return_rows") >= min_returns))


def first_non_null(value: str, order_key: str) -> Column:
    """Q14: pandas ``first`` = first non-null in input order; order made explicit."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order_key)))


def profit_erosion_by_order(returned: DataFrame, order_key: str = "order_item_id") -> DataFrame:
    """One row per order of returned items."""
    r = _nonnull_keys(returned, ["order_id"])
    return (r.groupBy("order_id").agg(
        first_non_null("user_id", order_key).alias("user_id"),
        F.count("order_item_id").alias("returned_items"),
        F.sum("margin_reversal").alias("total_margin_reversal"),
        F.sum("process_cost").alias("total_process_cost"),
        F.sum("profit_erosion").alias("total_profit_erosion"),
        F.sum("sale_price").alias("total_sales"),
        F.sum("item_margin").alias("total_margin"))
        .withColumn("avg_margin_per_return", F.col("total_margin") / F.col("returned_items")))


def profit_erosion_by_customer(returned: DataFrame) -> DataFrame:
    """A10: per customer of returned items (distinct orders via count_distinct)."""
    r = _nonnull_keys(returned, ["user_id"])
    return (r.groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count("order_item_id").alias("returned_items"),
        F.sum("margin_reversal").alias("total_margin_reversal"),
        F.sum("process_cost").alias("total_process_cost"),
        F.sum("profit_erosion").alias("total_profit_erosion"),
        F.sum("sale_price").alias("total_sales"),
        F.sum("item_margin").alias("total_margin"))
        .withColumn("avg_erosion_per_return", F.col("total_profit_erosion") / F.col("returned_items")))


def summarize_profit_erosion(returned: DataFrame) -> DataFrame:
    """One-row global summary; empty input gives zeros."""
    agg = returned.agg(
        F.count(F.lit(1)).alias("total_returned"),
        F.coalesce(F.sum("margin_reversal"), F.lit(0.0)).alias("total_margin_reversal"),
        F.coalesce(F.avg("item_margin"), F.lit(0.0)).alias("avg_margin_per_return"),
        F.coalesce(F.sum("process_cost"), F.lit(0.0)).alias("total_process_costs"),
        F.coalesce(F.sum("profit_erosion"), F.lit(0.0)).alias("total_profit_erosion"),
        F.coalesce(F.max("item_margin"), F.lit(0.0)).alias("max_single_margin_loss"))
    med = group_quantiles(returned, [], [("median_margin_per_return", "item_margin", 0.5)])
    return agg.crossJoin(med).select(
        "total_returned", "total_margin_reversal", "avg_margin_per_return",
        F.coalesce("median_margin_per_return", F.lit(0.0)).alias("median_margin_per_return"),
        "total_process_costs", "total_profit_erosion", "max_single_margin_loss",
        F.when(F.col("total_returned") > 0,
               F.col("total_profit_erosion") / F.col("total_returned"))
        .otherwise(F.lit(0.0)).alias("avg_erosion_per_return"))


def customer_behavioral_features(df: DataFrame, reference_date=None,
                                 order_key: str = "order_item_id", customers: DataFrame | None = None) -> DataFrame:
    """A12 (+ J6): RFM features.  Two-level aggregation (order, then customer) with
    partial aggregation at both levels; the reference date (max order date
    unless given) is a one-row aggregate cross-joined as a scalar.
    ``customers`` (user_id, user_created_at) is joined to the aggregated
    customers; without it the items carry ``user_created_at``.
    """
    if customers is not None:
        df = df.withColumn("user_created_at", F.lit(None).cast("timestamp"))
    d = _nonnull_keys(df, ["user_id"])
    orders = (d.groupBy("user_id", "order_id")
              .agg(F.sum("sale_price").alias("order_total"),
                   F.count("order_item_id").alias("order_items"),
                   F.max("order_created_at").alias("_last"),
                   F.min_by("user_created_at", F.when(F.col("user_created_at").isNotNull(),
                                                      F.col(order_key))).alias("_uc"),
                   F.min(F.when(F.col("user_created_at").isNotNull(), F.col(order_key))).alias("_uk"),
                   F.sum("is_returned_item").alias("_ret"),
                   F.sum("item_margin").alias("_margin"),
                   F.count("sale_price").alias("_n_price"),
                   F.count("item_margin").alias("_n_margin")))
    cust = orders.groupBy("user_id").agg(
        F.sum("order_items").alias("total_items"),
        F.count("order_id").alias("order_frequency"),
        F.sum("_ret").cast("long").alias("return_frequency"),
        F.sum("order_total").alias("total_sales"),
        F.sum("_margin").alias("total_margin"),
        (F.sum("order_total") / F.sum("_n_price")).alias("avg_item_price"),
        (F.sum("_margin") / F.sum("_n_margin")).alias("avg_item_margin"),
        F.max("_last").alias("_last_order"),
        F.min_by("_uc", "_uk").alias("_user_created"),
        F.avg("order_total").alias("avg_order_value"))
    if customers is not None:
        cust = cust.drop("_user_created").join(
            customers.select("user_id", F.col("user_created_at").alias("_user_created")), ["user_id"], "left")
    if reference_date is None:
        ref = df.agg(F.max("order_created_at").alias("_ref"))
        cust = cust.crossJoin(ref)  # one-row scalar
    else:
        cust = cust.withColumn("_ref", F.lit(reference_date).cast("timestamp"))
    return cust.select(
        "user_id", "total_items", "order_frequency", "return_frequency",
        "total_sales", "total_margin", "avg_item_price", "avg_item_margin",
        (F.col("return_frequency") / F.col("total_items")).alias("customer_return_rate"),
        (F.col("total_items") / F.col("order_frequency")).alias("avg_basket_size"),
        X.day_floor_diff("_ref", "_last_order").alias("purchase_recency_days"),
        X.day_floor_diff("_ref", "_user_created").alias("customer_tenure_days"),
        "avg_order_value")


def rq2_customer_segmentation_base(df: DataFrame, order_key: str = "order_item_id",
                                   demographics=("age", "user_gender", "country", "state",
                                                 "city", "traffic_source")) -> DataFrame:
    """A13 (+ J8): customer grain incl. the null user (``dropna=False``), rate,
    average erosion per return, first observed demographics (Q14) taken in
    the same ``groupBy`` instead of a separate join."""
    d = FE.ensure_profit_erosion(FE.ensure_return_flag(df))
    demo = [c for c in demographics if c in d.columns]
    agg = d.groupBy("user_id").agg(
        F.count("order_item_id").alias("total_items"),
        F.sum("is_returned_item").cast("long").alias("returned_items"),
        F.coalesce(F.sum("profit_erosion"), F.lit(0.0)).alias("total_profit_erosion"),
        *[first_non_null(c, order_key).alias(c) for c in demo])
    return agg.select(
        "user_id", "total_items", "returned_items", "total_profit_erosion",
        F.when(F.col("total_items") > 0, F.col("returned_items") / F.col("total_items"))
        .otherwise(0.0).alias("return_rate"),
        F.when(F.col("returned_items") > 0, F.col("total_profit_erosion") / F.col("returned_items"))
        .otherwise(0.0).alias("avg_profit_erosion_per_return"), *demo)


def segment_summary(profile: DataFrame) -> DataFrame:
    """Per return segment: customers, mean items, mean rate, margin sum."""
    return profile.groupBy("return_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("total_items").alias("avg_items"),
        F.avg("customer_return_rate").alias("avg_return_rate"),
        F.sum("total_margin").alias("total_margin"))


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """Value counts with share of the total.  The total is
    a one-row aggregate cross-joined back (no single-partition window, so a
    high-cardinality column stays distributed)."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    tot = df.agg(F.count(F.lit(1)).alias("_tot"))
    return c.crossJoin(F.broadcast(tot)).select(col, "count", (F.col("count") / F.col("_tot")).alias("share"))


def distribution_summary(df: DataFrame, value: str, top_n: int = 10,
                         id_col: str = "user_id") -> DataFrame:
    """N, median, p90, p99, max and the share of the top-n values."""
    d = df.where(F.col(value).isNotNull())
    base = d.agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("max"),
                 F.sum(value).alias("_total"))
    q = group_quantiles(d, [], [("median", value, 0.5), ("p90", value, 0.9), ("p99", value, 0.99)])
    top = (d.orderBy(F.desc(value), F.asc(id_col)).limit(top_n)
           .agg(F.sum(value).alias("_top")))
    return base.crossJoin(q).crossJoin(top).select(
        "n", "median", "p90", "p99", "max",
        (F.col("_top") / F.col("_total")).alias(f"top{top_n}_share"))


def missingness_overview(df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Percent null per column, only > 0, descending (one pass + unpivot)."""
    cols = df.columns
    one = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in cols])
    long = one.unpivot([], cols, "column", "missing_pct").where(F.col("missing_pct") > 0)
    long = long.orderBy(F.desc("missing_pct"), "column")
    return long.limit(top_n) if top_n else long


def high_erosion_group(customers: DataFrame, value: str = "total_profit_erosion",
                       p: float = 0.75) -> DataFrame:
    """Customers above the P-quantile: count, sum, share, mean."""
    thr = group_quantiles(customers, [], [("threshold", value, p)])
    d = customers.crossJoin(thr)
    hi = F.col(value) > F.col("threshold")
    return d.agg(
        F.first("threshold").alias("threshold"),
        F.count(F.when(hi, 1)).alias("high_customers"),
        F.sum(F.when(hi, F.col(value))).alias("high_total"),
        (F.sum(F.when(hi, F.col(value))) / F.sum(value)).alias("high_share"),
        F.avg(F.when(hi, F.col(value))).alias("high_mean"))


def return_rate_matrix(df: DataFrame, row: str, column: str, min_rows: int = 0) -> DataFrame:
    """Return rate per (row, column) cell, pivoted to columns."""
    cells = return_rates_by_group(df, [row, column], min_rows=min_rows)
    return cells.groupBy(row).pivot(column).agg(F.first("return_rate"))


def volume_severity(groups: DataFrame, key: str, count_col: str = "returned_item_rows",
                    mean_col: str = "mean_profit_erosion_per_return") -> DataFrame:
    """Clip at 0, total = volume x severity (identity check column)."""
    vol = F.greatest(F.coalesce(F.col(count_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    sev = F.greatest(F.coalesce(F.col(mean_col), F.lit(0.0)), F.lit(0.0))
    return groups.select(key, vol.alias("volume"), sev.alias("severity"),
                         (vol * sev).alias("total"))


def histogram(df: DataFrame, value: str, bins: int = 60, log: bool = False) -> DataFrame:
    """Equal-width (or log10-width) histogram of positive values.

    Edges come from a one-row min / max aggregate; the bin index is a
    ``width_bucket`` expression, counts are one partial aggregation.
    """
    d = df.where(F.col(value) > 0).select(
        (F.log10(value) if log else F.col(value)).alias("_x"))
    mm = d.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    b = F.least(F.width_bucket("_x", "_lo", F.when(F.col("_hi") > F.col("_lo"), F.col("_hi"))
                               .otherwise(F.col("_lo") + 1), F.lit(bins)), F.lit(bins))
    return (d.crossJoin(mm).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("bin"))


def column_summary(df: DataFrame, cols) -> DataFrame:
    """Count, mean, std, min, quartiles, max per column (exact quartiles)."""
    cols = list(cols)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("_kv")).select("_kv.column", "_kv.value")
    mom = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = group_quantiles(long, ["column"], [("p25", "value", 0.25), ("p50", "value", 0.5),
                                           ("p75", "value", 0.75)])
    return mom.join(q, ["column"], "left")


def between_group_cv(groups: DataFrame, value: str) -> DataFrame:
    """Coefficient of variation of a per-group measure (%)."""
    return groups.agg((F.stddev_samp(value) / F.avg(value) * 100).alias("cv_pct"))


def headline_measures(df: DataFrame, keys: dict | None = None) -> DataFrame:
    """Distinct orders / customers / products, returned count and medians.

    ``keys``: for a key, a frame that has it without the joins of the others.
    All else is stored once, in columns, and read from there; the medians group
    only the values near them."""
    named = [("order_id", "orders"), ("user_id", "customers"), ("product_id", "products")]
    margin, erosion = F.col("item_margin").cast("double"), F.col("profit_erosion").cast("double")
    rows = stored(df.select(*[k for k, _ in named if k not in (keys or {})], _ret().alias("_r"), margin.alias("_margin"),
                            F.when(_ret(), margin).alias("_margin_r"), F.when(_ret(), erosion).alias("_erosion_r")), "headline")
    base = rows.agg(F.count_if("_r").alias("returned_items"))
    for key, name in named:
        # one partially aggregated pass per key; several distinct counts in one
        # aggregate would multiply every row first
        own = (keys or {}).get(key, rows)
        one = own.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(1).alias("_1")).agg(F.count("_1").alias(name))
        base = base.crossJoin(one)
    medians = column_quantiles(rows, [("median_margin_all", "_margin", 0.5), ("median_margin_returned", "_margin_r", 0.5),
                                      ("median_erosion_returned", "_erosion_r", 0.5)])
    return base.crossJoin(medians).select(*[name for _, name in named], "returned_items", *medians.columns)


def monthly_return_rate(df: DataFrame, ts: str = "order_created_at") -> DataFrame:
    """Monthly return rate + trailing 3-month mean (min 1 period).

    The monthly table has one row per month (a few hundred rows at most),
    so the un-partitioned rolling window runs on a tiny input.
    """
    m = (df.groupBy(F.date_trunc("month", F.col(ts)).alias("month"))
         .agg(F.count(F.lit(1)).alias("items"),
              F.sum("is_returned_item").cast("long").alias("returned_items"))
         .withColumn("return_rate", F.col("returned_items") / F.col("items")))
    w = Window.orderBy("month").rowsBetween(-2, 0)
    return m.withColumn("rolling_3m_return_rate", F.avg("return_rate").over(w))


def peak_month(monthly: DataFrame) -> DataFrame:
    """Month with the highest rate (earliest on ties) and mean rate."""
    return monthly.agg(
        F.min_by("month", F.struct(-F.col("return_rate"), F.col("month"))).alias("peak_month"),
        F.max("return_rate").alias("peak_return_rate"),
        F.avg("return_rate").alias("mean_monthly_return_rate"))
