"""Group tables on small frames with hand-computed answers."""
import pytest
from pyspark.sql import functions as F

from losslens.operators import aggregates as A
from losslens.operators import features as FE


def _items(spark):
    rows = [(1, "o1", "u1", "A", "b1", "Small", "Returned", 100.0, 60.0),
            (2, "o1", "u1", "A", "b1", "Small", "Complete", 50.0, 20.0),
            (3, "o2", "u2", "A", "b2", "Large", "Returned", 30.0, 40.0),
            (4, "o3", "u2", "B", "b2", "Large", "Complete", 10.0, 5.0),
            (5, "o4", None, None, "b2", "Large", "Returned", 10.0, 5.0)]
    df = spark.createDataFrame(rows, "order_item_id int, order_id string, user_id string, category string, "
                                     "brand string, department string, item_status string, "
                                     "sale_price double, cost double").withColumn("retail_price", F.col("sale_price"))
    return FE.add_item_features(df, category_multipliers={})


def test_return_rates_drop_null_keys_and_min_rows(spark):
    r = {x["category"]: x for x in A.return_rates_by_group(_items(spark), ["category"], 1).collect()}
    assert set(r) == {"A", "B"}
    assert r["A"]["item_rows"] == 3 and r["A"]["returned_items"] == 2
    assert A.return_rates_by_group(_items(spark), ["category"], 2).count() == 1


def test_erosion_metrics_null_when_no_returns(spark):
    long = A.product_profit_erosion_metrics(_items(spark), min_rows=1)
    cat = {x["category"]: x for x in A.erosion_level(long, "category").collect()}
    assert cat["B"]["total_profit_erosion"] is None and cat["B"]["returned_item_rows"] is None
    a = cat["A"]
    assert a["returned_item_rows"] == 2
    assert a["total_profit_erosion"] == pytest.approx((40 + 12) + (-10 + 12))
    assert a["median_profit_erosion_per_return"] == pytest.approx(27.0)


def test_summary_empty_safe(spark):
    empty = _items(spark).where("1 = 0")
    r = A.summarize_profit_erosion(empty).first()
    assert r["total_returned"] == 0 and r["avg_erosion_per_return"] == 0.0


def test_rfm(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [("u1", "o1", "i1", 10.0, 2.0, 1, dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1)),
         ("u1", "o1", "i2", 20.0, 4.0, 0, dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1)),
         ("u1", "o2", "i3", 30.0, 6.0, 0, dt.datetime(2024, 1, 11), dt.datetime(2023, 1, 1)),
         ("u2", "o3", "i4", 5.0, 1.0, 1, dt.datetime(2024, 1, 21), dt.datetime(2024, 1, 1))],
        "user_id string, order_id string, order_item_id string, sale_price double, item_margin double, "
        "is_returned_item int, order_created_at timestamp, user_created_at timestamp")
    r = {x["user_id"]: x for x in A.customer_behavioral_features(df).collect()}
    u1 = r["u1"]
    assert u1["total_items"] == 3 and u1["order_frequency"] == 2 and u1["return_frequency"] == 1
    assert u1["avg_order_value"] == pytest.approx(30.0) and u1["avg_basket_size"] == 1.5
    assert u1["purchase_recency_days"] == 10 and r["u2"]["purchase_recency_days"] == 0
    assert u1["customer_tenure_days"] == 385


def test_segmentation_base_keeps_null_user(spark):
    base = A.rq2_customer_segmentation_base(_items(spark).drop("profit_erosion"))
    assert base.where(F.col("user_id").isNull()).count() == 1


def test_headline_measures_store_the_items_once(spark, monkeypatch):
    d = _items(spark)
    kept, store = [], A.stored
    monkeypatch.setattr(A, "stored", lambda df, tag: kept.append(df.columns) or store(df, tag))
    users = d.select("user_id").distinct()
    r = A.headline_measures(d.withColumn("product_id", F.col("brand")), {"user_id": users}).first()
    assert (r.orders, r.customers, r.products, r.returned_items) == (4, 2, 2, 3)
    assert (r.median_margin_all, r.median_margin_returned) == (5.0, 5.0)
    assert r.median_erosion_returned == sorted(x.profit_erosion for x in d.where("is_returned_item = 1").collect())[1]
    assert len(kept) == 1 and "user_id" not in kept[0]
    empty = A.headline_measures(d.withColumn("product_id", F.col("brand")).where("sale_price < 0")).first()
    assert tuple(empty) == (0, 0, 0, 0, None, None, None)


def test_distinct_items_are_taken_before_the_orders(spark, tmp_path):
    from losslens.sources.adapter import items
    spark.createDataFrame([(1, 7)] * 3 + [(2, 8), (2, 8), (None, 9), (4, 9)], "l_orderkey long, l_partkey long") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 11, "F"), (1, 12, "F"), (2, 11, "O"), (2, None, "O"), (3, 13, "P")],
                          "o_orderkey long, o_custkey long, o_orderstatus string") \
        .selectExpr("*", "current_timestamp() o_orderdate", "'x' o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    one = items(spark, str(tmp_path), ["user_id"], distinct=True)
    assert sorted((r.user_id for r in one.collect()), key=str) == [11, 12, None]
    assert sorted((r.order_id for r in items(spark, str(tmp_path), ["order_id"], distinct=True).collect()), key=str) == [1, 2, 4, None]
    with pytest.raises(ValueError):
        items(spark, str(tmp_path), ["user_id", "cost"], distinct=True)
