"""

Samples and splits rank rows by a seeded hash of the id (``xxhash64``):
deterministic under recomputation, so a lost executor re-creates the
same sample -- ``rand()`` would not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_desc_nulls_last(df: DataFrame, measure: str, *tie_keys: str) -> DataFrame:
    """K1 / K4: ``ORDER BY measure DESC NULLS LAST, ties``."""
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc(k) for k in tie_keys])


def top_k(df: DataFrame, measure: str, k: int, *tie_keys: str) -> DataFrame:
    """K2: ``nlargest`` = TakeOrderedAndProject (per-partition top-k heaps)."""
    return df.orderBy(F.desc(measure), *[F.asc(t) for t in tie_keys]).limit(k)


def largest_groups(df: DataFrame, group: str, max_groups: int = 12) -> DataFrame:
    """K3: rows of the ``max_groups`` largest groups (count, top-k, semi join)."""
    top = (df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), F.asc(group)).limit(max_groups))
    return df.join(F.broadcast(top.select(group)), [group], "left_semi")  # <= max_groups rows


def argmax(df: DataFrame, measure: str, tie: str) -> DataFrame:
    """K5: best row, lowest ``tie`` on equal measures."""
    return df.orderBy(F.desc(measure), F.asc(tie)).limit(1)


def hash_order(id_col: str, seed: int):
    return F.xxhash64(F.col(id_col).cast("string"), F.lit(int(seed)))


HASH_BUCKETS = 4096
MAX_LEVELS = 2000  # levels of a category that become columns of a wide table


def hash_positions(df: DataFrame, group: str, id_col: str, seed: int) -> DataFrame:
    """Adds ``_cum`` (1-based place of the row in its group, by 64-bit hash,
    then id) and ``_n`` (rows of the group).

    The hash is uniform, so its top 12 bits split any group evenly: rows are
    numbered inside (group, bucket), and bucket counts, at most 4,096 per
    group, give the offsets.  Rows with equal ids have places of their own."""
    d = df.withColumn("_h", hash_order(id_col, seed)).withColumn("_b", F.shiftrightunsigned("_h", 52))
    counts = d.groupBy(F.col(group).alias("_g"), F.col("_b").alias("_gb")).agg(F.count(F.lit(1)).alias("_c"))
    per_group = Window.partitionBy("_g")
    off = counts.select("_g", "_gb", F.sum("_c").over(per_group.orderBy("_gb")).alias("_through"), "_c",
                        F.sum("_c").over(per_group).alias("_n"))
    place = F.row_number().over(Window.partitionBy(group, "_b").orderBy("_h", id_col))
    ranked = d.withColumn("_rn", place)
    return (ranked.join(off, ranked[group].eqNullSafe(off["_g"]) & (ranked["_b"] == off["_gb"]))
            .withColumn("_cum", F.col("_through") - F.col("_c") + F.col("_rn"))
            .drop("_h", "_b", "_g", "_gb", "_through", "_c", "_rn"))


def sample_per_group(df: DataFrame, group: str, id_col: str, m: int, seed: int = 42) -> DataFrame:
    """At most ``m`` rows per group, seeded by a hash of the id."""
    return hash_positions(df, group, id_col, seed).where(F.col("_cum") <= m).drop("_cum", "_n")


def sample_rows(df: DataFrame, id_col: str, m: int, seed: int = 42) -> DataFrame:
    """Global sample of at most ``m`` rows without replacement
    (hash-ordered top-m: TakeOrdered keeps m rows per partition)."""
    return df.orderBy(hash_order(id_col, seed), F.col(id_col)).limit(m)


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """U8: exact per-class test counts (round(test_size * n_c)) chosen by
    hash rank; adds ``is_test``."""
    j = hash_positions(df, label, id_col, seed)
    return j.withColumn("is_test", (F.col("_cum") <= F.round(F.col("_n") * test_size)).cast("int")).drop("_cum", "_n")


def fold_column(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42,
                out: str = "fold") -> DataFrame:
    """Stratified k-fold ids: hash rank within class, round-robin over k."""
    j = hash_positions(df, label, id_col, seed + 1)
    return j.withColumn(out, ((F.col("_cum") - 1) % k).cast("int")).drop("_cum", "_n")


def stack_tables(*frames: DataFrame) -> DataFrame:
    """Stack summary and pairwise rows (missing columns -> null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def melt(df: DataFrame, ids, values, var: str = "variable", value: str = "value") -> DataFrame:
    """U4: wide -> long."""
    return df.unpivot(list(ids), list(values), var, value)


def one_hot_drop_first(df: DataFrame, col: str, levels=None, prefix: str | None = None):
    """Pandas ``get_dummies(drop_first=True)``: sorted levels, first
    dropped (Spark's encoder drops the last).  Levels become columns, so more
    than ``MAX_LEVELS`` raise."""
    if levels is None:
        found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()
        if len(found) > MAX_LEVELS:
            raise ValueError(f"{col} has more than {MAX_LEVELS} levels")
        levels = sorted(r[0] for r in found)
    p = prefix or col
    return df.withColumns({f"{p}_{lv}": (F.col(col) == F.lit(lv)).cast("double")
                           for lv in levels[1:]}), [f"{p}_{lv}" for lv in levels[1:]]
