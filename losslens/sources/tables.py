"""Readers for the driver's parquet tables.

Columns are selected right after the scan so Catalyst prunes the parquet
``ReadSchema``; filters applied later are pushed into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Expose the driver tables as temp views (for ``spark.sql``)."""
    for n in names or TABLES:
        p = table_path(sf_dir, n)
        if os.path.exists(p):
            spark.read.parquet(p).createOrReplaceTempView(n)


def clean_columns(df: DataFrame) -> DataFrame:
    """Strip blanks and byte-order marks from header names."""
    return df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])
