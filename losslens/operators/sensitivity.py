"""Cost and threshold sensitivity, label part.

All scenarios run in ONE job: the returned items are cross-joined with
the (tiny, fixed) scenario list -- broadcast, a proven bound -- and every
aggregate / quantile is keyed by the scenario column, so the data is read
once however many scenarios are asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.functions import exprs as X
from losslens.operators.ordered import group_quantiles

# fixed values: sensitivity scenarios (base cost per return, label percentile)
SENSITIVITY_BASE_COSTS = [8.0, 10.0, 12.0, 14.0, 18.0]
SENSITIVITY_THRESHOLDS = [0.50, 0.60, 0.70, 0.75, 0.80, 0.90]


def erosion_under_costs(returned: DataFrame, base_costs, category_multipliers: dict | None = None,
                        key: str = "user_id") -> DataFrame:
    """Customer erosion for every base cost: (base_cost, key, total)."""
    spark = returned.sparkSession
    costs = spark.createDataFrame([(float(c),) for c in base_costs], "base_cost double")
    tier = X.tier_multiplier("category", category_multipliers)
    d = returned.select(key, "item_margin", tier.alias("_tier")).crossJoin(F.broadcast(costs))
    return (d.groupBy("base_cost", key)
            .agg(F.sum(F.col("item_margin") + F.col("base_cost") * F.col("_tier"))
                 .alias("total_profit_erosion")))


def labels_by_scenario(df: DataFrame, scenario: str, value: str = "total_profit_erosion",
                       percentile: float | None = 0.75, percentile_col: str | None = None,
                       strict: bool = True) -> DataFrame:
    """High-erosion label per scenario with the scenario's own threshold.

    Either one ``percentile`` for all scenarios (cost sensitivity) or a
    per-row ``percentile_col`` (threshold sensitivity: the scenario *is*
    the percentile)."""
    if percentile_col is None:
        thr = group_quantiles(df, [scenario], [("_thr", value, float(percentile))])
        d = df.join(F.broadcast(thr), [scenario])  # one row per scenario
    else:
        ps = [r[0] for r in df.select(percentile_col).distinct().collect()]  # scenario list
        specs = [(f"_t{i}", value, float(p)) for i, p in enumerate(ps)]
        thr = group_quantiles(df, [scenario], specs)
        pick = None
        for i, p in enumerate(ps):
            e = F.when(F.col(percentile_col) == p, F.col(f"_t{i}"))
            pick = e if pick is None else pick.when(F.col(percentile_col) == p, F.col(f"_t{i}"))
        d = df.join(F.broadcast(thr), [scenario]).withColumn("_thr", pick)
    v = F.col(value)
    lab = (v > F.col("_thr")) if strict else (v >= F.col("_thr"))
    return d.withColumn("label", F.coalesce(lab, F.lit(False)).cast("int")).withColumnRenamed(
        "_thr", "threshold").select(*df.columns, "threshold", "label")


def stability_vs_baseline(labels: DataFrame, scenario: str, baseline, key: str = "user_id") -> DataFrame:
    """U2 per scenario: flips on common ids and Jaccard of positive sets
    against the baseline scenario (one full outer join keyed by id)."""
    base = labels.where(F.col(scenario) == F.lit(baseline)).select(key, F.col("label").alias("_b"))
    other = labels.select(scenario, key, F.col("label").alias("_a"))
    j = other.join(base, [key], "full_outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    pa = F.coalesce(F.col("_a") == 1, F.lit(False))
    pb = F.coalesce(F.col("_b") == 1, F.lit(False))
    r = j.where(F.col(scenario).isNotNull()).groupBy(scenario).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_a")).cast("long").alias("positives"),
        F.count(F.when(both & (F.col("_a") != F.col("_b")), 1)).alias("n_flipped"),
        F.count(F.when(pa & pb, 1)).alias("_i"), F.count(F.when(pa | pb, 1)).alias("_u"))
    return r.select(scenario, "n", "positives", "n_flipped",
                    (F.col("n_flipped") / F.col("n")).alias("flip_rate"),
                    F.when(F.col("_u") > 0, F.col("_i") / F.col("_u")).otherwise(1.0).alias("jaccard"))
