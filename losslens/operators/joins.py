"""

No hints on tables whose size grows with the data: the planner broadcasts
a side only under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks
at run time) and falls back to a sort-merge join; AQE's skew-join splits
a hot key.  Explicit ``broadcast`` only for one-row / fixed-size sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from losslens.operators.quality import NUMERIC


def customer_segmentation_table(behavior: DataFrame, erosion: DataFrame,
                                key: str = "user_id") -> DataFrame:
    """Behaviour LEFT erosion; overlapping non-key columns are refused;
    numeric nulls from the erosion side -> 0."""
    overlap = (set(behavior.columns) & set(erosion.columns)) - {key}
    if overlap:
        raise ValueError(f"overlapping columns between behaviour and erosion: {sorted(overlap)}")
    out = behavior.join(erosion, [key], "left")
    num = [c for c, t in erosion.dtypes if c != key and (t in NUMERIC or t.startswith("decimal"))]
    return out.fillna(0.0, subset=[c for c in num if dict(out.dtypes)[c] in ("double", "float")]) \
              .fillna(0, subset=[c for c in num if dict(out.dtypes)[c] not in ("double", "float")])


def product_modeling_dataset(erosion: DataFrame, behavior: DataFrame, key: str) -> DataFrame:
    """Group erosion INNER group behaviour, suffixes, one return rate,
    rows without erosion dropped."""
    common = (set(erosion.columns) & set(behavior.columns)) - {key}
    e = erosion.select(key, *[F.col(c).alias(f"{c}_erosion" if c in common else c)
                              for c in erosion.columns if c != key])
    b = behavior.select(key, *[F.col(c).alias(f"{c}_returns" if c in common else c)
                               for c in behavior.columns if c != key])
    out = e.join(b, [key], "inner")
    if "return_rate_returns" in out.columns:
        out = out.withColumnRenamed("return_rate_returns", "return_rate")
    if "return_rate_erosion" in out.columns:
        out = out.drop("return_rate_erosion")
    return out.dropna(subset=["total_profit_erosion"])


def dominant_value(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Modal value per key, smallest value on count ties (Q18).
    (key, value) counts pre-aggregate map-side; one row per key."""
    c = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("_n"))
    return c.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value)))
                              .alias(out or f"dominant_{value}"))


def attach_erosion(items: DataFrame, erosion: DataFrame, key: str = "order_item_id",
                   col: str = "profit_erosion") -> DataFrame:
    """Item LEFT join computed erosion, null -> 0."""
    e = erosion.select(key, F.col(col).alias("_e"))
    return items.join(e, [key], "left").withColumn(col, F.coalesce("_e", F.lit(0.0))).drop("_e")


def attach_own_erosion(items: DataFrame, col: str = "profit_erosion") -> DataFrame:
    """J10 where the items carry the erosion themselves: that of returned
    items, else 0, without a join of the items to themselves."""
    return items.withColumn(col, F.when(F.col("is_returned_item") == 1, F.coalesce(col, F.lit(0.0))).otherwise(F.lit(0.0)))


def keep_large_groups(df: DataFrame, group: str, min_n: int) -> DataFrame:
    """Rows whose group has at least ``min_n`` rows (left semi join on
    the partially aggregated group counts)."""
    big = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_n)
    return df.join(big.select(group), [group], "left_semi")


def label_stability(base: DataFrame, other: DataFrame, key: str = "user_id",
                    label: str = "label") -> DataFrame:
    """Flip rate on common ids (inner) and Jaccard of the positive
    sets (full outer) -- one join, conditional counts."""
    a = base.select(key, F.col(label).alias("_a"))
    b = other.select(key, F.col(label).alias("_b"))
    j = a.join(b, [key], "full_outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    pa, pb = F.col("_a") == 1, F.col("_b") == 1
    r = j.agg(
        F.count(F.when(both, 1)).alias("n_common"),
        F.count(F.when(both & (F.col("_a") != F.col("_b")), 1)).alias("n_flipped"),
        F.count(F.when(F.coalesce(pa, F.lit(False)) & F.coalesce(pb, F.lit(False)), 1)).alias("_inter"),
        F.count(F.when(F.coalesce(pa, F.lit(False)) | F.coalesce(pb, F.lit(False)), 1)).alias("_union"))
    return r.select("n_common", "n_flipped",
                    F.when(F.col("n_common") > 0, F.col("n_flipped") / F.col("n_common"))
                    .alias("flip_rate"),
                    F.when(F.col("_union") > 0, F.col("_inter") / F.col("_union")).otherwise(1.0)
                    .alias("jaccard"))


def compare_reports(left: DataFrame, right: DataFrame, key: str = "feature",
                    suffixes=("_primary", "_external")) -> DataFrame:
    """Align two small report tables by feature name (full outer)."""
    lc = [c for c in left.columns if c != key]
    rc = [c for c in right.columns if c != key]
    lsel = left.select(key, *[F.col(c).alias(c + suffixes[0]) for c in lc])
    rsel = right.select(key, *[F.col(c).alias(c + suffixes[1]) for c in rc])
    return lsel.join(rsel, [key], "full_outer")
