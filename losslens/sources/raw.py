"""Raw CSV exports (S1, S2), column selection (P1) and type standardisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from losslens.sources.quoted_csv import read_quoted_csv
from losslens.sources.tables import clean_columns

# fixed values: the dates of each export, and columns by their standard type
RAW_DATES = {"order_items": ["shipped_at", "delivered_at", "returned_at"],
             "orders": ["shipped_at", "delivered_at", "returned_at"], "products": [], "users": ["created_at"]}
DATETIME_COLS = ["item_created_at", "item_shipped_at", "item_delivered_at", "item_returned_at", "order_created_at",
                 "order_shipped_at", "order_delivered_at", "order_returned_at", "user_created_at"]
NUMERIC_COLS = ["sale_price", "retail_price", "cost", "age", "num_of_item"]
STRING_COLS = ["postal_code", "sku", "user_geom", "street_address", "email"]


def read_csv(spark: SparkSession, path: str, columns=None, dates=(), schema: str | None = None) -> DataFrame:
    """One export with a header, whose records may hold line feeds (see
    ``quoted_csv``).  Names are cleaned (S2); with ``columns`` only those are
    read; ``dates`` are parsed, unparsable ones null.  Without a schema all
    other columns are strings, so no pass infers types; P2 converts them."""
    df = clean_columns(read_quoted_csv(spark, path, schema))
    missing = [c for c in columns or [] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in {path}: {missing}")
    df = df.select(*columns) if columns else df
    return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in dates if c in df.columns})


def load_raw(spark: SparkSession, folder: str, columns: dict | None = None) -> dict[str, DataFrame]:
    """The four exports of a folder by name, with optional column lists."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", (columns or {}).get(name), dates)
            for name, dates in RAW_DATES.items()}


def select_columns(df: DataFrame, drop=None, keep=None) -> tuple[DataFrame, DataFrame]:
    """Keep or drop columns, keep wins; names that don't exist are
    reported, not an error.  The report has (column, status) with kept,
    dropped and missing."""
    have = df.columns
    asked = list(keep if keep is not None else drop or [])
    left = [c for c in have if c in asked] if keep is not None else [c for c in have if c not in asked]
    left = [c for c in asked if c in have] if keep is not None else left
    rows = [(c, "kept" if c in left else "dropped") for c in have] + [(c, "missing") for c in asked if c not in have]
    return df.select(*left), df.sparkSession.createDataFrame(rows, "column string, status string")


def standardize_types(df: DataFrame) -> DataFrame:
    """Columns with ``id`` in their name and known mixed ones to string,
    dates to timestamps (UTC session clock), numbers to double; what cannot
    be converted becomes null."""
    out = {}
    for c in df.columns:
        if "id" in c.lower() or c in STRING_COLS:
            out[c] = F.col(c).cast("string")
        if c in DATETIME_COLS:
            out[c] = F.try_to_timestamp(F.col(c).cast("string"))
        if c in NUMERIC_COLS:
            out[c] = F.expr(f"try_cast(`{c}` AS double)")
    return df.withColumns(out)
