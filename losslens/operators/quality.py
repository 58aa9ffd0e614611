"""

Reports are small DataFrames built from ONE aggregation pass each; the
reference's per-row Python loops (outlier details) become array / string
expressions evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from losslens.functions import exprs as X
from losslens.operators.ordered import group_quantiles
from losslens.session import cut_lineage, stored

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")
STRINGS = ("string",)


def numeric_columns(df: DataFrame):
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def _report(**metrics) -> list:
    return [(k, float(v) if v is not None else None) for k, v in metrics.items()]


# ------------------------------------------------------------------ Q-1
def detect_duplicates(df: DataFrame, subset=None, action: str = "flag",
                      order_key: str | None = None):
    """Q-1: duplicate members / groups; ``remove`` keeps one row per key
    (the smallest ``order_key`` when given), ``flag`` adds ``is_duplicate``.

    Group sizes come from ``groupBy(keys).count()`` (partial aggregation,
    safe for one huge duplicate group) and are joined back null-safely.
    Returns ``(frame, report)``; the report has the reference's
    ``total_duplicates_found`` (all members, D1), the number of groups and
    the true number of rows removed.
    """
    keys = list(subset or df.columns)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_dupn"))
    every = action == "remove" and order_key is None and set(keys) == set(df.columns)
    if every:  # the groups are the rows that stay: grouped once, for the report and the frame
        counts = stored(counts, "distinct-rows")
    report = counts.where(F.col("_dupn") > 1).agg(
        F.coalesce(F.sum("_dupn"), F.lit(0)).cast("long").alias("total_duplicates_found"),
        F.count(F.lit(1)).alias("unique_duplicate_groups"),
        F.coalesce(F.sum(F.col("_dupn") - 1), F.lit(0)).cast("long").alias("rows_removed"))
    if action == "remove":
        if every:
            out = counts.select(*df.columns)
        elif order_key is None:
            out = df.dropDuplicates(keys)
        else:
            others = [c for c in df.columns if c not in keys]
            first = F.min_by(F.struct(*others), F.col(order_key)).alias("_first")
            out = df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)
        return out, report
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(counts[k]) for k in keys])
    flagged = df.join(counts, cond, "left").select(
        df["*"], (F.col("_dupn") > 1).cast("int").alias("is_duplicate"))
    return flagged, report


# ------------------------------------------------------------------ Q-2
def missing_report(df: DataFrame) -> DataFrame:
    """Q-2 report: per column missing count and percent (2 places), only
    columns with missing values, most missing first (one pass + unpivot)."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    long = one.unpivot(["_rows"], cols, "column", "missing_count")
    return (long.where(F.col("missing_count") > 0)
            .select("column", F.col("missing_count").cast("long").alias("missing_count"),
                    X.rnd(F.col("missing_count") / F.col("_rows") * 100, 2).alias("missing_pct"))
            .orderBy(F.desc("missing_count"), "column"))


def fill_numeric_median(df: DataFrame, cols=None) -> DataFrame:
    """Q-2 / P24: nulls -> exact column median (one quantile pass for all)."""
    cols = list(cols or numeric_columns(df))
    if not cols:
        return df
    med = group_quantiles(df, [], [(f"_med_{c}", c, 0.5) for c in cols])
    d = df.crossJoin(F.broadcast(med))  # one row
    return d.select(*[F.coalesce(F.col(c), F.col(f"_med_{c}").cast(dict(df.dtypes)[c])).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def column_modes(df: DataFrame, cols) -> DataFrame:
    """Q18 mode per column: most frequent non-null value, smallest on ties.
    (column, value) counts use partial aggregation; one row per column."""
    cols = list(cols)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("_kv")).select("_kv.column", "_kv.value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
        F.max("n").alias("mode_count"))


def fill_categorical_mode(df: DataFrame, cols=None) -> DataFrame:
    cols = list(cols or [c for c, t in df.dtypes if t in STRINGS])
    if not cols:
        return df
    modes = column_modes(df, cols).groupBy().pivot("column", cols).agg(F.first("mode"))
    d = df.crossJoin(F.broadcast(modes.select(*[F.col(c).alias(f"_mode_{c}") for c in cols])))
    return d.select(*[F.coalesce(F.col(c), F.col(f"_mode_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def handle_missing(df: DataFrame, strategy: str = "report"):
    rep = missing_report(df)
    if strategy == "drop":
        return df.dropna(), rep
    if strategy == "fill_numeric":
        return fill_numeric_median(df), rep
    if strategy == "fill_categorical":
        return fill_categorical_mode(df), rep
    return df, rep


# ------------------------------------------------------------------ Q-3
def default_outlier_columns(df: DataFrame):
    return [c for c in numeric_columns(df)
            if not (c.startswith("is_") or "margin" in c.lower() or "discount" in c.lower())]


def iqr_bounds(df: DataFrame, cols, multiplier: float = 1.5) -> DataFrame:
    """One row: ``_lo_<c>`` / ``_hi_<c>`` for every column (one quantile pass)."""
    specs = [s for c in cols for s in ((f"_q1_{c}", c, 0.25), (f"_q3_{c}", c, 0.75))]
    q = group_quantiles(df, [], specs)
    out = []
    for c in cols:
        iqr = F.col(f"_q3_{c}") - F.col(f"_q1_{c}")
        out += [(F.col(f"_q1_{c}") - multiplier * iqr).alias(f"_lo_{c}"),
                (F.col(f"_q3_{c}") + multiplier * iqr).alias(f"_hi_{c}")]
    return q.select(*out)


def detect_outliers_iqr(df: DataFrame, numeric_cols=None, multiplier: float = 1.5,
                        action: str = "flag"):
    """Q-3: Tukey fences per column; ``flag`` adds ``is_outlier``,
    ``outlier_columns`` ('a;b') and ``outlier_values`` ('a=1.0;b=2.0')."""
    cols = list(numeric_cols or default_outlier_columns(df))
    bounds = cut_lineage(iqr_bounds(df, cols, multiplier))  # found once for the flags and the report
    d = df.crossJoin(F.broadcast(bounds))  # one row: proven bound
    hit = {c: X.null_safe_true((F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}")))
           for c in cols}
    any_hit = reduce(lambda a, b: a | b, hit.values(), F.lit(False))
    d = d.withColumns({f"_o_{c}": hit[c] for c in cols})
    report = d.agg(F.count(F.when(any_hit, 1)).alias("total_outlier_rows"),
                   *[F.count(F.when(F.col(f"_o_{c}"), 1)).alias(c) for c in cols])
    drop = [f"_lo_{c}" for c in cols] + [f"_hi_{c}" for c in cols] + [f"_o_{c}" for c in cols]
    if action == "remove":
        return d.where(~any_hit).drop(*drop), report
    out = d.withColumns({
        "is_outlier": any_hit.cast("int"),
        "outlier_columns": F.concat_ws(";", *[F.when(F.col(f"_o_{c}"), F.lit(c)) for c in cols]),
        "outlier_values": F.concat_ws(";", *[F.when(F.col(f"_o_{c}"),
                                                    F.concat(F.lit(c + "="), F.col(c).cast("string")))
                                             for c in cols]),
    })
    return out.drop(*drop), report


# ------------------------------------------------------------------ Q-4 .. Q-6
def _rule_check(df: DataFrame, rules: dict, flag: str, action: str):
    """Boolean issue columns (missing compare -> False, Q15) + one count pass."""
    rules = {k: X.null_safe_true(v) for k, v in rules.items()}
    any_issue = reduce(lambda a, b: a | b, rules.values(), F.lit(False))
    report = df.agg(F.count(F.when(any_issue, 1)).alias("total_inconsistent_rows"),
                    *[F.count(F.when(v, 1)).alias(k) for k, v in rules.items()])
    if action == "remove":
        return df.where(~any_issue), report
    return df.withColumn(flag, any_issue.cast("int")), report


def validate_price_consistency(df: DataFrame, action: str = "flag"):
    """Q-4: negative price / cost, sale > retail, cost > sale."""
    cols = set(df.columns)
    rules = {}
    if "sale_price" in cols:
        rules["negative_price"] = F.col("sale_price") < 0
    if {"retail_price", "sale_price"} <= cols:
        rules["sale_exceeds_retail"] = F.col("sale_price") > F.col("retail_price")
    if {"sale_price", "cost"} <= cols:
        rules["cost_exceeds_sale"] = F.col("cost") > F.col("sale_price")
    if "cost" in cols:
        rules["cost_negative"] = F.col("cost") < 0
    return _rule_check(df, rules, "has_price_inconsistency", action)


def validate_status_consistency(df: DataFrame, action: str = "flag"):
    """Q-5: flag vs status text, delivered without shipped, item vs order."""
    cols = set(df.columns)
    rules = {}
    if {"is_returned_item", "item_status"} <= cols:
        rules["returned_not_delivered"] = (F.col("is_returned_item") == 1) & (
            F.lower("item_status") != "returned")
    if {"item_delivered_at", "item_shipped_at"} <= cols:
        rules["returned_not_shipped"] = F.col("item_delivered_at").isNotNull() & F.col(
            "item_shipped_at").isNull()
    if {"is_returned_item", "is_returned_order"} <= cols:
        rules["item_order_status_mismatch"] = (F.col("is_returned_item") == 1) & (
            F.col("is_returned_order") == 0)
    return _rule_check(df, rules, "has_status_inconsistency", action)


def validate_temporal_consistency(df: DataFrame, action: str = "flag", extra: dict | None = None):
    """Q-6: delivered < shipped, returned < delivered (both present)."""
    cols = set(df.columns)
    rules = {}
    if {"item_shipped_at", "item_delivered_at"} <= cols:
        rules["delivered_before_shipped"] = F.col("item_delivered_at") < F.col("item_shipped_at")
    if {"item_delivered_at", "item_returned_at"} <= cols:
        rules["returned_before_delivered"] = F.col("item_returned_at") < F.col("item_delivered_at")
    rules.update(extra or {})
    return _rule_check(df, rules, "has_temporal_inconsistency", action)


# ------------------------------------------------------------------ P7 / P8
def clean_categorical_values(df: DataFrame, cat_cols=None, lowercase: bool = True,
                             strip_whitespace: bool = True):
    """Trim + lower; report distinct counts before / after (one pass)."""
    cols = [c for c in (cat_cols or [c for c, t in df.dtypes if t in STRINGS]) if c in df.columns]

    def clean(c):
        e = F.col(c)
        if strip_whitespace:
            e = F.trim(e)
        if lowercase:
            e = F.lower(e)
        return e
    out = df.withColumns({c: clean(c) for c in cols})
    # distinct (column, value, cleaned value) once, then counts per column
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"),
                                                   clean(c).alias("w")) for c in cols])).alias("r")).select("r.*")
    seen = pairs.distinct()
    before = seen.groupBy("column").agg(F.count("v").alias("before"))
    after = seen.select("column", "w").distinct().groupBy("column").agg(F.count("w").alias("after"))
    long = before.join(after, "column").select("column", "before", "after")
    return out, long.withColumn("reduced_by", F.col("before") - F.col("after"))


def low_variance_report(df: DataFrame, threshold: float = 0.01, cols=None) -> DataFrame:
    """P8 report: sample std of each numeric column (one pass), flagged when
    below the threshold (pandas: NaN std is never below)."""
    cols = list(cols or numeric_columns(df))
    one = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in cols])
    long = one.unpivot([], cols, "column", "std")
    return long.withColumn("removed", X.null_safe_true(F.col("std") < threshold))


def remove_low_variance_columns(df: DataFrame, threshold: float = 0.01, cols=None):
    rep = low_variance_report(df, threshold, cols)
    drop = [r["column"] for r in rep.where("removed").select("column").collect()]
    return df.drop(*drop), rep


# ------------------------------------------------------------------ Q-8
def feature_quality_stats(df: DataFrame, cols) -> DataFrame:
    """Q-8: nulls, mean, std, min, max, median, bias-corrected skew and
    kurtosis (Q9) per feature; features unpivoted so one job covers all."""
    cols = list(cols)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols
    ])).alias("_kv")).select("_kv.feature", "_kv.x")
    mom = long.groupBy("feature").agg(
        F.count(F.when(F.col("x").isNull(), 1)).alias("null_count"),
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        F.skewness("x").alias("_g1"), F.kurtosis("x").alias("_g2"))
    med = group_quantiles(long, ["feature"], [("median", "x", 0.5)])
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, ((n + 1) * F.col("_g2") + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return mom.join(med, ["feature"], "left").select(
        "feature", F.col("null_count").cast("long").alias("null_count"), "mean", "std", "min",
        "max", "median", skew.alias("skewness"), kurt.alias("kurtosis"),
        X.null_safe_true(F.col("std") == 0).alias("is_constant"))


def correlation_pairs(df: DataFrame, cols, threshold: float | None = 0.8) -> DataFrame:
    """Q-8: pairwise-complete Pearson r for every pair in one aggregate
    (Spark ``corr`` skips rows where either side is null, like pandas)."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                   for a, b in pairs])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"),
                 F.col(f"{a}__{b}").alias("correlation")) for a, b in pairs])).alias("p")).select("p.*")
    if threshold is not None:
        long = long.where(F.abs("correlation") > threshold)
    return long


# ------------------------------------------------------------------ Q-7
def deep_clean(df: DataFrame, remove_duplicates: bool = True, handle_missing_strategy: str = "report",
               detect_outliers: bool = True, outlier_cols=None, outlier_action: str = "flag",
               price_action: str | None = "flag", status_action: str | None = "flag",
               temporal_action: str | None = "flag", clean_categories: bool = True,
               variance_threshold: float | None = None, id_col: str = "order_item_id"):
    """Q-7: fixed order Q-1, Q-2, Q-3, Q-4..Q-6, P7, P8 with switches.

    Duplicates are equal in all columns.  Outliers are looked for in all
    default numeric columns unless some are named.  The three rule checks
    flag or remove (None: left out).  Columns of low variance are removed.

    Returns the cleaned frame and one long report DataFrame
    (step, metric, value) -- a union of the per-step one-row reports.
    """
    spark = df.sparkSession
    reports = []

    def add(step, rep):
        cols = rep.columns
        reports.append(rep.select(F.explode(F.array(*[
            F.struct(F.lit(step).alias("step"), F.lit(c).alias("metric"),
                     F.col(c).cast("double").alias("value")) for c in cols])).alias("r")).select("r.*"))

    initial = df.agg(F.count(F.lit(1)).alias("initial_rows"))
    add("summary", initial)
    out = df
    if remove_duplicates:
        out, rep = detect_duplicates(out, action="remove")
        add("duplicates", rep)
    out, rep = handle_missing(out, handle_missing_strategy)
    add("missing", rep.agg(F.coalesce(F.sum("missing_count"), F.lit(0)).alias("total_missing_cells"),
                           F.count(F.lit(1)).alias("columns_with_missing")))
    if detect_outliers:
        out, rep = detect_outliers_iqr(out, outlier_cols, action=outlier_action)
        add("outliers", rep)
    for step, check, action in (("price", validate_price_consistency, price_action),
                                ("status", validate_status_consistency, status_action),
                                ("temporal", validate_temporal_consistency, temporal_action)):
        if action is not None:
            out, rep = check(out, action)
            add(step, rep)
    if clean_categories:
        cats = [c for c, t in out.dtypes if t in STRINGS and c not in (id_col, "outlier_columns",
                                                                        "outlier_values")]
        out, rep = clean_categorical_values(out, cats)
        add("categorical", rep.agg(F.coalesce(F.sum("reduced_by"), F.lit(0)).alias("values_merged")))
    if variance_threshold is not None:
        out, rep = remove_low_variance_columns(out, variance_threshold)
        add("low_variance", rep.agg(F.count(F.when(F.col("removed"), 1)).alias("columns_removed")))
    add("summary_final", out.agg(F.count(F.lit(1)).alias("final_rows")))
    report = reduce(DataFrame.unionByName, reports) if reports else spark.createDataFrame(
        [], "step string, metric string, value double")
    return out, report


# ------------------------------------------------------------------ S6
def split_flagged(df: DataFrame, flag_cols, id_col: str = "order_item_id"):
    """(all rows without flag columns, review table of flagged rows)."""
    flags = [c for c in flag_cols if c in df.columns]
    anyf = reduce(lambda a, b: a | b, [F.col(c) == 1 for c in flags], F.lit(False))
    return df.drop(*flags), df.where(anyf).select(id_col, *flags)
