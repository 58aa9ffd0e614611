"""RQ1 job (E13) and the ETL / sink jobs.

dataset (item join) -> flags -> margins -> returned items with erosion ->
group tables (category / brand / department in one pass) -> factor tests.
Outputs are written under ``out_dir`` (parquet for tables, CSV for small
reports, JSON for the summary).
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.sources.raw import standardize_types
from losslens.operators import aggregates as A
from losslens.operators import quality as QL
from losslens.operators import stats as S
from losslens.plans.registry import featured_items
from losslens.sources.adapter import DRIVER_TIERS, items
from losslens.operators import features as FE
from losslens.session import cut_lineage, shuffles_dropped, stored


def build_analysis_dataset(spark: SparkSession, sf: str, out_dir: str, check_unique: bool = True) -> str:
    """Join -> typed item table (P2) -> parquet (snappy) and CSV (gzip, as plain
    text it takes several times the tables' size).  The m:1 checks (Q19) run on the
    dimensions first when asked."""
    if check_unique:
        from losslens.sources.adapter import assert_unique_key
        from losslens.sources.tables import read_table
        assert_unique_key(read_table(spark, sf, "orders", ["o_orderkey"]), "o_orderkey", "orders")
        assert_unique_key(read_table(spark, sf, "part", ["p_partkey"]), "p_partkey", "part")
        assert_unique_key(read_table(spark, sf, "customer", ["c_custkey"]), "c_custkey", "customer")
    path = os.path.join(out_dir, "item_table")
    table = standardize_types(items(spark, sf))
    with shuffles_dropped(spark):
        table.write.mode("overwrite").option("compression", "snappy").parquet(path)
    spark.read.parquet(path).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path + ".csv")
    return path


def save_cleaned(df: DataFrame, flag_cols, out_dir: str, id_col: str = "order_item_id") -> dict:
    """All rows without the flag columns + a review table of flagged rows."""
    clean, review = QL.split_flagged(df, flag_cols, id_col)
    p1, p2 = os.path.join(out_dir, "cleaned"), os.path.join(out_dir, "flagged_review")
    clean.write.mode("overwrite").parquet(p1)
    review.write.mode("overwrite").parquet(p2)
    return {"cleaned": p1, "review": p2}


def run_rq1(spark: SparkSession, sf: str, out_dir: str | None = None) -> dict:
    f = featured_items(spark, sf)
    # joined once: the group tables and tests read these columns
    returned = f.where(F.col("is_returned_item") == 1)
    f = stored(f.select("order_item_id", "is_returned_item", "category", "brand", "department", "sale_price", "item_margin",
                        "margin_reversal", "process_cost", "profit_erosion"), "rq1-items")
    long = cut_lineage(A.product_profit_erosion_metrics(f))  # one row a group
    tables = {lv: A.erosion_level(long, lv) for lv in ("category", "brand", "department")}
    tests = {g: S.run_factor(f.where(F.col("is_returned_item") == 1), g) for g in ("category", "brand")}
    summary = tests["category"][0].unionByName(tests["brand"][0])
    if out_dir:
        returned.write.mode("overwrite").parquet(os.path.join(out_dir, "returned_items"))
        for lv, t in tables.items():
            t.write.mode("overwrite").option("header", True).csv(
                os.path.join(out_dir, f"erosion_by_{lv}"))
        summary.write.mode("overwrite").option("header", True).csv(
            os.path.join(out_dir, "statistical_tests_summary"))
        summary.select(F.to_json(F.struct("*")).alias("json")).write.mode("overwrite") \
            .text(os.path.join(out_dir, "rq1_summary_json"))
    return {"tables": tables, "summary": summary, "posthoc": {g: t[1] for g, t in tests.items()}}


def customer_erosion(df: DataFrame) -> DataFrame:
    """Customer erosion from raw items (flags / margins / erosion are
    derived when missing) or from processed items; columns that would
    collide with the aggregate are dropped first."""
    d = df
    if "is_returned_item" not in d.columns:
        d = FE.engineer_return_features(d) if "item_status" in d.columns else FE.ensure_return_flag(d)
    if "item_margin" not in d.columns:
        d = FE.ensure_item_margin(d)
    if "profit_erosion" not in d.columns:
        d = FE.calculate_profit_erosion(d, category_multipliers=DRIVER_TIERS)
    d = d.drop(*[c for c in ("total_profit_erosion", "returned_items") if c in d.columns])
    return A.profit_erosion_by_customer(d.where(F.col("is_returned_item") == 1))


def build_external_artifacts(spark: SparkSession, sf: str, out_dir: str) -> dict:
    """S9 + S10: external raw -> engineered lines, canonical base, returned
    rows and the category group table, written as parquet."""
    from losslens.operators import external as EX
    from losslens.sources.external import external_lines
    eng = EX.preprocess(EX.load_lines(external_lines(spark, sf)))
    paths = {}

    def write(name, df):
        paths[name] = os.path.join(out_dir, name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(paths[name])
        return spark.read.schema(df.schema).parquet(paths[name])
    # each artifact is made from the written one before it
    base = write("canonical_base", EX.canonical_base(write("engineered", eng)))
    write("returned", base.where(F.col("is_returned_item") == 1))
    write("by_category", EX.group_metrics(base))
    return paths


def load_customer_targets(spark: SparkSession, path: str, target: str = "total_profit_erosion") -> DataFrame:
    """Read the customer targets; one aggregate asserts it is non-empty
    and that every erosion value is positive."""
    df = spark.read.parquet(path)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.min(target).alias("mn")).first()
    if not r["n"]:
        raise ValueError("customer targets are empty")
    if r["mn"] is None or r["mn"] <= 0:
        raise ValueError(f"{target} must be > 0 for every customer")
    return df
