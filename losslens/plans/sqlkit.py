"""Helpers shared by the query catalog: the DuckDB feature CTE and the
rounding convention applied identically to a Spark result and its SQL twin
(so an order-insensitive value hash compares equal numbers)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.functions.exprs import rnd
from losslens.sources.adapter import DRIVER_TIERS, ITEMS_SQL

DEFAULT_DIGITS = 4


def tier_case_sql(col: str = "category", tiers: dict = DRIVER_TIERS) -> str:
    whens = " ".join(f"WHEN '{k.lower()}' THEN CAST({v} AS DOUBLE)" for k, v in tiers.items())
    return f"CASE lower(trim({col})) {whens} ELSE CAST(1.0 AS DOUBLE) END"


FEATURES_SQL = ITEMS_SQL + f""",
f AS (
  SELECT *,
    CASE WHEN lower(item_status) = 'returned' THEN 1 ELSE 0 END AS is_returned_item,
    CASE WHEN lower(order_status) = 'returned' THEN 1 ELSE 0 END AS is_returned_order,
    retail_price - sale_price AS discount_amount,
    CASE WHEN retail_price > 0 THEN (retail_price - sale_price) / retail_price END AS discount_pct,
    sale_price - cost AS item_margin,
    CASE WHEN sale_price > 0 THEN (sale_price - cost) / sale_price END AS item_margin_pct,
    sale_price - cost AS margin_reversal,
    CAST(12.0 AS DOUBLE) * {tier_case_sql()} AS process_cost,
    (sale_price - cost) + CAST(12.0 AS DOUBLE) * {tier_case_sql()} AS profit_erosion
  FROM items
)"""


def with_features(body: str) -> str:
    """Prefix a query body with ``WITH items AS (..), f AS (..)``."""
    b = body.strip()
    if b.startswith(","):
        b = b[1:].strip()
    sep = "\n" if b.upper().startswith("SELECT") else ",\n"
    return "WITH " + FEATURES_SQL + sep + b


# Cut point of the comparison quantiser, as a fraction of one 1e-4 step:
# 1 - 0.618034 (golden ratio), far from the decimal (.5, .25, .125) and
# dyadic points where exact money sums and their averages sit.
CUT = 0.381966011250105
STEP = 10000.0


def quantize(c):
    """Compare form of a double: 4 decimals with the cut off the tie points.

    Money values are exact 4-decimal numbers and means divide them by
    counts, so ordinary rounding (decimal or float32) lands on exact ties
    where two engines that sum in a different order fall on different
    sides.  ``floor(x * 1e4 + CUT) / 1e4`` is made of single IEEE steps that
    both engines compute bit-identically, and its cuts are far from such
    ties.  NaN / inf / huge values pass through unchanged.
    """
    x = F.col(c).cast("double") if isinstance(c, str) else c.cast("double")
    q = F.floor(x * F.lit(STEP) + F.lit(CUT)).cast("double") / F.lit(STEP)
    return F.when(F.isnan(x) | (F.abs(x) >= F.lit(1e14)), x).otherwise(q)


SIGNIFICANT = 9
_POWERS = [float(10 ** k) for k in range(23)]  # exact doubles


def significant(c):
    """Compare form of a double of any size: ``SIGNIFICANT`` digits, cut like
    ``quantize``.  Only exact powers of ten are multiplied or divided by."""
    x = c.cast("double")
    shift = F.lit(SIGNIFICANT - 1) - F.floor(F.log10(F.abs(x))).cast("int")
    power = F.element_at(F.array(*[F.lit(p) for p in _POWERS]), F.least(F.abs(shift), F.lit(22)) + 1)
    whole = F.floor(F.when(shift >= 0, x * power).otherwise(x / power) + F.lit(CUT)).cast("double")
    return F.when(F.isnan(x) | (x == 0) | (F.abs(x) >= F.lit(1e30)) | (F.abs(x) <= F.lit(1e-13)), x).otherwise(
        F.when(shift >= 0, whole / power).otherwise(whole * power))


def significant_sql(expr: str) -> str:
    x = f"CAST({expr} AS DOUBLE)"
    shift = f"({SIGNIFICANT - 1} - CAST(floor(log10(abs({x}))) AS INTEGER))"
    power = "[" + ", ".join(f"CAST('{p}' AS DOUBLE)" for p in _POWERS) + f"][least(abs({shift}), 22) + 1]"
    whole = f"floor(CASE WHEN {shift} >= 0 THEN {x} * {power} ELSE {x} / {power} END + CAST('{CUT}' AS DOUBLE))"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) OR {x} = 0 OR abs({x}) >= CAST('1e30' AS DOUBLE) "
            f"OR abs({x}) <= CAST('1e-13' AS DOUBLE) THEN {x} "
            f"WHEN {shift} >= 0 THEN {whole} / {power} ELSE {whole} * {power} END")


def round_spark(df: DataFrame, digits: dict | None = None, default: int = DEFAULT_DIGITS,
                scale: dict | None = None) -> DataFrame:
    """Comparison form of a Spark result: doubles quantised, small ints as
    bigint.  ``digits`` first applies the reference's own decimal rounding
    where the operator itself rounds (pandas ``round``)."""
    digits, scale = digits or {}, scale or {}
    out = []
    for name, typ in df.dtypes:
        if typ in ("double", "float"):
            c = rnd(name, digits[name]) if name in digits else F.col(name)
            if name in scale:  # magnitudes far from 1
                out.append(significant(c).alias(name))
            else:
                out.append(quantize(c).alias(name))
        elif typ in ("int", "smallint", "tinyint"):
            out.append(F.col(name).cast("bigint").alias(name))
        elif typ in ("timestamp", "timestamp_ntz", "date"):
            # ISO text: engines differ in timestamp precision / zone handling
            out.append(F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def quantize_sql(expr: str) -> str:
    x = f"CAST({expr} AS DOUBLE)"
    return (f"CASE WHEN isnan({x}) OR abs({x}) >= CAST('1e14' AS DOUBLE) THEN {x} ELSE "
            f"CAST(floor({x} * CAST('{STEP}' AS DOUBLE) + CAST('{CUT}' AS DOUBLE)) AS DOUBLE)"
            f" / CAST('{STEP}' AS DOUBLE) END")


def round_sql(sql: str, double_cols: list[str], digits: dict | None = None,
              int_cols: list[str] = (), default: int = DEFAULT_DIGITS, scale: dict | None = None,
              ts_cols: list[str] = ()) -> str:
    digits, scale = digits or {}, scale or {}

    def one(c):
        e = f"round_even(CAST({c} AS DOUBLE), {digits[c]})" if c in digits else c
        return significant_sql(e) if c in scale else quantize_sql(e)
    reps = [f"{one(c)} AS {c}" for c in double_cols]
    reps += [f"CAST({c} AS BIGINT) AS {c}" for c in int_cols]
    reps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ts_cols]
    if not reps:
        return sql
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM (\n{sql}\n) q"
