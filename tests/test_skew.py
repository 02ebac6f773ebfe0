"""Results on data where one order, customer or value owns a third of all rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points

SMALL = "/root/testdata/sf0.001"
CHECKED = [
    "baseline_lysw_metrics", "gold_obt", "silver_sales_dedup", "profile_summary", "holiday_lift",
    "market_basket_pairs", "drift_report", "store_silhouette", "dq_compound_unique", "profile_duplicates",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skewed"))
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    hot_order = F.pmod(F.xxhash64("l_partkey", "l_extendedprice"), F.lit(3)) == 0
    hot_customer = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0
    lines.withColumn("l_orderkey", F.when(hot_order, F.lit(7)).otherwise(F.col("l_orderkey"))).withColumn(
        "l_linenumber", F.when(hot_order & (F.col("l_quantity") > 25), F.lit(1)).otherwise(F.col("l_linenumber"))
    ).withColumn("l_orderkey", F.col("l_orderkey").cast("bigint")).withColumn(
        "l_linenumber", F.col("l_linenumber").cast("int")
    ).write.parquet(f"{root}/lineitem.parquet")
    orders.withColumn(
        "o_custkey", F.when(hot_customer, F.lit(11)).otherwise(F.col("o_custkey")).cast("bigint")
    ).write.parquet(f"{root}/orders.parquet")
    for name in ("customer", "nation"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", CHECKED)
@pytest.mark.parametrize("broadcast", ["on", "off"])
def test_skewed_tables(spark, skewed, name, broadcast):
    from test_queries import normal

    con = duckdb.connect()
    for table in ("lineitem", "orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{skewed}/{table}.parquet/*.parquet')")
    cursor = con.execute(entry_points.oracle_sql()[name])
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    size = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(size)
    spark.conf.set(size, kept if broadcast == "on" else "-1")
    try:
        df = entry_points.queries()[name](spark, skewed)
        got = normal(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set(size, kept)
    assert got == want
