"""What large writes leave on disk."""
import datetime
import glob
import time

from pyspark.sql import functions as F

from losslens.plans import rq1
from losslens.session import stored
from losslens.sources import raw


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


def test_stored_rows_leave_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    before = _shuffle_files(spark)
    kept = stored(df, "test")  # held, so that no garbage is collected
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert sorted(map(tuple, kept.collect())) == sorted((k, sum(range(k, 1000, 100))) for k in range(100))
    assert df.count() == 100  # the frame itself can be read again


def test_item_table_is_compressed_as_csv_too(spark, tmp_path):
    day = datetime.datetime(2020, 1, 1)
    tables = {
        "customer": ([(i, i % 2, 1.5 * i, "BUILDING") for i in range(20)],
                     "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "part": ([(i, "PROMO", "Brand, x", i, 10.0 + i) for i in range(20)],
                 "p_partkey long, p_type string, p_brand string, p_size int, p_retailprice double"),
        "orders": ([(i, i % 20, "F", day, "1") for i in range(500)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(i % 500, i % 25, i % 7, i // 500, 2.0, 100.0 + i, 0.25, "RAN"[i % 3], day) for i in range(2000)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    path = rq1.build_analysis_dataset(spark, str(tmp_path), str(tmp_path / "out"))
    assert glob.glob(f"{path}.csv/part-*.gz") and not glob.glob(f"{path}.csv/part-*.csv")
    columns = ["order_item_id", "sale_price", "brand", "item_returned_at", "category"]
    back = raw.standardize_types(raw.read_csv(spark, path + ".csv")).select(*columns)
    want = spark.read.parquet(path).select(*columns)
    assert back.count() == want.count() == 2000
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))


def test_accounts_are_grouped_once(spark):
    from losslens.operators import external as EX
    day = datetime.datetime(2020, 1, 1)
    lines = spark.createDataFrame(
        [(i % 3, i // 2, str(i), day + datetime.timedelta(days=i), "RETURN" if i % 4 else "ORDER", 2.0, 2, 10.0 + i, -5.0, 1.0 + i, 2.0 + i)
         for i in range(24)],
        "`Bill To Act #` int, `Order Number` int, `Order Line ID` string, `Booked Date` timestamp, Sales_Type string, "
        "`Ordered Qty` double, `Lines Per Order` int, `Reference Sale Amount` double, `CreditReturn Sales` double, "
        "gross_financial_loss double, total_loss double")
    out = EX.account_features(lines)
    assert {r.account_id: (r.total_items, r.return_frequency, r.total_loss) for r in out.collect()} == {
        a: (8, sum(i % 4 > 0 for i in range(a, 24, 3)), sum(2.0 + i for i in range(a, 24, 3))) for a in range(3)}
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
