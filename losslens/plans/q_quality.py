"""Catalog entries: data quality (Q-1..Q-8, P7, P8) on the item grain.

The driver tables have no nulls or duplicates, so the inputs inject them
the same way on both sides: rows with ``line_number = 7`` are appended
again (duplicates), ``quantity = 1`` becomes null (missing values) and
line 1 gets a lower-cased, blank-padded category (case variants).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from losslens.operators import quality as QL
from losslens.plans.registry import featured_items, register
from losslens.plans.q_aggregates import RFM_DOUBLES, rfm, rfm_sql
from losslens.plans.sqlkit import with_features

DUP_COLS = ["order_item_id", "order_id", "sale_price", "cost", "category"]


def dup_items(spark, sf):
    f = featured_items(spark, sf, ["line_number"]).select(*DUP_COLS, "line_number")
    return f.unionByName(f.where(F.col("line_number") == 7)).drop("line_number")


DUP_SQL = "d AS (SELECT " + ", ".join(DUP_COLS) + " FROM f UNION ALL SELECT " + ", ".join(
    DUP_COLS) + " FROM f WHERE line_number = 7)"

register("q1_duplicate_report", with_features(DUP_SQL + """,
c AS (SELECT """ + ", ".join(DUP_COLS) + """, count(*) AS n FROM d GROUP BY ALL)
SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS total_duplicates_found,
       count(*) FILTER (WHERE n > 1) AS unique_duplicate_groups,
       CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_removed FROM c"""))(
    lambda spark, sf: QL.detect_duplicates(dup_items(spark, sf))[1])

register("q1_remove_duplicates", with_features(DUP_SQL + "\nSELECT DISTINCT * FROM d"),
         ["sale_price", "cost"])(
    lambda spark, sf: QL.detect_duplicates(dup_items(spark, sf), action="remove")[0])

register("q1_flag_duplicates", with_features(DUP_SQL + """,
c AS (SELECT """ + ", ".join(DUP_COLS) + """, count(*) AS n FROM d GROUP BY ALL)
SELECT d.order_item_id, CAST(c.n > 1 AS INTEGER) AS is_duplicate FROM d JOIN c USING (""" +
    ", ".join(DUP_COLS) + ")"), ints=["is_duplicate"])(
    lambda spark, sf: QL.detect_duplicates(dup_items(spark, sf), action="flag")[0]
    .select("order_item_id", "is_duplicate"))

MISS_COLS = ["order_item_id", "quantity", "item_returned_at", "sale_price", "category"]


def miss_items(spark, sf):
    f = featured_items(spark, sf, ["quantity", "item_returned_at"])
    return f.select("order_item_id", F.when(F.col("quantity") != 1, F.col("quantity")).alias("quantity"),
                    "item_returned_at", "sale_price", "category")


MISS_SQL = ("m AS (SELECT order_item_id, nullif(quantity, 1) AS quantity, item_returned_at, "
            "sale_price, category FROM f)")

register("q2_missing_report", with_features(MISS_SQL + """,
u AS (UNPIVOT (SELECT count(*) FILTER (WHERE order_item_id IS NULL) AS order_item_id,
       count(*) FILTER (WHERE quantity IS NULL) AS quantity,
       count(*) FILTER (WHERE item_returned_at IS NULL) AS item_returned_at,
       count(*) FILTER (WHERE sale_price IS NULL) AS sale_price,
       count(*) FILTER (WHERE category IS NULL) AS category FROM m)
      ON order_item_id, quantity, item_returned_at, sale_price, category
      INTO NAME "column" VALUE missing_count)
SELECT "column", CAST(missing_count AS BIGINT) AS missing_count,
       round_even(missing_count / (SELECT count(*) FROM m) * 100, 2) AS missing_pct
FROM u WHERE missing_count > 0"""), ["missing_pct"])(
    lambda spark, sf: QL.missing_report(miss_items(spark, sf)))

register("q2_fill_numeric_median", with_features(MISS_SQL + """
SELECT order_item_id, coalesce(quantity, (SELECT quantile_cont(quantity, 0.5) FROM m)) AS quantity,
       sale_price FROM m"""), ["quantity", "sale_price"])(
    lambda spark, sf: QL.fill_numeric_median(miss_items(spark, sf), ["quantity", "sale_price"])
    .select("order_item_id", "quantity", "sale_price"))

register("q2_drop_missing", with_features(MISS_SQL + """
SELECT order_item_id, quantity FROM m WHERE quantity IS NOT NULL AND item_returned_at IS NOT NULL"""),
         ["quantity"])(
    lambda spark, sf: QL.handle_missing(miss_items(spark, sf), "drop")[0]
    .select("order_item_id", "quantity"))

_MODE_COLS = ["category", "brand", "department", "item_status"]
register("q2_column_modes", with_features("""
l AS (SELECT 'category' AS "column", category AS value FROM f UNION ALL
      SELECT 'brand', brand FROM f UNION ALL SELECT 'department', department FROM f UNION ALL
      SELECT 'item_status', item_status FROM f),
c AS (SELECT "column", value, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", arg_min(value, (-n, value)) AS mode, max(n) AS mode_count FROM c GROUP BY 1"""))(
    lambda spark, sf: QL.column_modes(featured_items(spark, sf), _MODE_COLS))

_OUT_COLS = ["sale_price", "retail_price", "cost", "quantity"]
_IQR_SQL = "b AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
    f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
    for c in _OUT_COLS) + " FROM f),\no AS (SELECT f.*, " + ", ".join(
    f"coalesce({c} < lo_{c} OR {c} > hi_{c}, false) AS o_{c}" for c in _OUT_COLS) + \
    " FROM f CROSS JOIN b)"

register("q3_iqr_outlier_report", with_features(_IQR_SQL + "\nSELECT count(*) FILTER (WHERE " +
                                               " OR ".join(f"o_{c}" for c in _OUT_COLS) +
                                               ") AS total_outlier_rows, " + ", ".join(
    f"count(*) FILTER (WHERE o_{c}) AS {c}" for c in _OUT_COLS) + " FROM o"))(
    lambda spark, sf: QL.detect_outliers_iqr(featured_items(spark, sf, ["quantity"], with_orders=False), _OUT_COLS)[1])

register("q3_iqr_outlier_flags", with_features(_IQR_SQL + "\nSELECT order_item_id, CAST(" +
                                              " OR ".join(f"o_{c}" for c in _OUT_COLS) +
                                              " AS INTEGER) AS is_outlier, concat_ws(';', " + ", ".join(
    f"CASE WHEN o_{c} THEN '{c}' END" for c in _OUT_COLS) + ") AS outlier_columns, concat_ws(';', " +
    ", ".join(f"CASE WHEN o_{c} THEN '{c}=' || CAST({c} AS VARCHAR) END" for c in _OUT_COLS) +
    ") AS outlier_values FROM o"), ints=["is_outlier"])(
    lambda spark, sf: QL.detect_outliers_iqr(featured_items(spark, sf, ["quantity"], with_orders=False), _OUT_COLS)[0]
    .select("order_item_id", "is_outlier", "outlier_columns", "outlier_values"))

register("q3_iqr_remove_outliers", with_features(_IQR_SQL + "\nSELECT order_item_id FROM o WHERE NOT (" +
                                                " OR ".join(f"o_{c}" for c in _OUT_COLS) + ")"))(
    lambda spark, sf: QL.detect_outliers_iqr(featured_items(spark, sf, ["quantity"], with_orders=False), _OUT_COLS,
                                             action="remove")[0].select("order_item_id"))

register("q4_price_rules", with_features("""
SELECT count(*) FILTER (WHERE coalesce(sale_price < 0, false) OR coalesce(sale_price > retail_price, false)
         OR coalesce(cost > sale_price, false) OR coalesce(cost < 0, false)) AS total_inconsistent_rows,
       count(*) FILTER (WHERE sale_price < 0) AS negative_price,
       count(*) FILTER (WHERE sale_price > retail_price) AS sale_exceeds_retail,
       count(*) FILTER (WHERE cost > sale_price) AS cost_exceeds_sale,
       count(*) FILTER (WHERE cost < 0) AS cost_negative FROM f"""))(
    lambda spark, sf: QL.validate_price_consistency(featured_items(spark, sf, with_orders=False))[1])

register("q5_status_rules", with_features("""
, s AS (SELECT coalesce(is_returned_item = 1 AND lower(item_status) <> 'returned', false) AS a,
        coalesce(item_delivered_at IS NOT NULL AND item_shipped_at IS NULL, false) AS b,
        coalesce(is_returned_item = 1 AND is_returned_order = 0, false) AS c FROM f)
SELECT count(*) FILTER (WHERE a OR b OR c) AS total_inconsistent_rows,
       count(*) FILTER (WHERE a) AS returned_not_delivered, count(*) FILTER (WHERE b) AS returned_not_shipped,
       count(*) FILTER (WHERE c) AS item_order_status_mismatch FROM s"""))(
    lambda spark, sf: QL.validate_status_consistency(
        featured_items(spark, sf, ["item_delivered_at", "item_shipped_at"]))[1])

register("q6_temporal_rules", with_features("""
, s AS (SELECT coalesce(item_delivered_at < item_shipped_at, false) AS a,
        coalesce(item_returned_at < item_delivered_at, false) AS b,
        coalesce(item_shipped_at < order_created_at, false) AS c FROM f)
SELECT count(*) FILTER (WHERE a OR b OR c) AS total_inconsistent_rows,
       count(*) FILTER (WHERE a) AS delivered_before_shipped,
       count(*) FILTER (WHERE b) AS returned_before_delivered,
       count(*) FILTER (WHERE c) AS shipped_before_ordered FROM s"""))(
    lambda spark, sf: QL.validate_temporal_consistency(
        featured_items(spark, sf, ["item_delivered_at", "item_shipped_at", "item_returned_at",
                                   "order_created_at"]),
        extra={"shipped_before_ordered": F.col("item_shipped_at") < F.col("order_created_at")})[1])

_CAT = ["category", "brand", "item_status", "department"]


def cat_items(spark, sf):
    f = featured_items(spark, sf, ["line_number"])
    return f.select(F.when(F.col("line_number") == 1, F.concat(F.lower("category"), F.lit(" ")))
                    .otherwise(F.col("category")).alias("category"), "brand", "item_status", "department")


register("p7_categorical_clean_report", with_features("""
, c AS (SELECT CASE WHEN line_number = 1 THEN lower(category) || ' ' ELSE category END AS category,
        brand, item_status, department FROM f)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS before, count(DISTINCT lower(trim({c}))) AS after, "
    f"count(DISTINCT {c}) - count(DISTINCT lower(trim({c}))) AS reduced_by FROM c" for c in _CAT)))(
    lambda spark, sf: QL.clean_categorical_values(cat_items(spark, sf), _CAT)[1])

register("p7_categorical_clean_values", with_features("""
SELECT lower(trim(CASE WHEN line_number = 1 THEN lower(category) || ' ' ELSE category END)) AS category,
       count(*) AS n FROM f GROUP BY 1"""))(
    lambda spark, sf: QL.clean_categorical_values(cat_items(spark, sf), ["category"])[0]
    .groupBy("category").agg(F.count(F.lit(1)).alias("n")))

_VAR_COLS = ["sale_price", "retail_price", "cost", "quantity", "discount", "is_returned_item",
             "is_returned_order"]
register("p8_low_variance_report", with_features(
    ", s AS (SELECT " + ", ".join(f"stddev_samp(CAST({c} AS DOUBLE)) AS {c}" for c in _VAR_COLS) +
    " FROM f)\nSELECT \"column\", std, coalesce(std < 0.01, false) AS removed FROM (UNPIVOT s ON " +
    ", ".join(_VAR_COLS) + " INTO NAME \"column\" VALUE std)"), ["std"])(
    lambda spark, sf: QL.low_variance_report(
        featured_items(spark, sf, ["quantity", "discount"]), 0.01, _VAR_COLS))

_Q8 = ["total_items", "order_frequency", "return_frequency", "total_sales", "avg_order_value",
       "customer_return_rate", "purchase_recency_days", "customer_tenure_days"]
register("q8_feature_quality_stats", rfm_sql(
    ", l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM rfm"
                                    for c in _Q8) + ")\n" + """
SELECT feature, count(*) FILTER (WHERE x IS NULL) AS null_count, avg(x) AS mean, stddev_samp(x) AS std,
       min(x) AS min, max(x) AS max, quantile_cont(x, 0.5) AS median, skewness(x) AS skewness,
       kurtosis(x) AS kurtosis, coalesce(stddev_samp(x) = 0, false) AS is_constant
FROM l GROUP BY feature"""), ["mean", "std", "min", "max", "median", "skewness", "kurtosis"])(
    lambda spark, sf: QL.feature_quality_stats(rfm(spark, sf), _Q8))

register("q8_correlation_pairs", rfm_sql(
    ", p AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) "
        f"AS correlation FROM rfm" for i, a in enumerate(_Q8) for b in _Q8[i + 1:]) + ")\n"
    "SELECT * FROM p WHERE abs(correlation) > 0.8"), ["correlation"])(
    lambda spark, sf: QL.correlation_pairs(rfm(spark, sf), _Q8, 0.8))

register("q8_correlation_matrix", rfm_sql(
    ", p AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) "
        f"AS correlation FROM rfm" for i, a in enumerate(_Q8) for b in _Q8[i + 1:]) + ")\n"
    "SELECT * FROM p"), ["correlation"])(
    lambda spark, sf: QL.correlation_pairs(rfm(spark, sf), _Q8, None))
