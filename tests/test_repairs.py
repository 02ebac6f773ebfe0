"""Cleaning keeps rows apart by date text, metrics skip missing predictions, and a changed partition is seen."""

from weekgrid.operators import clean, metrics
from weekgrid.plans import shared


def test_unreadable_dates_stay_apart(spark):
    rows = [(1, 1, "05/02/2010", 3.0, False), (1, 1, "05/02/2010", 4.0, False), (1, 1, "bad", 7.0, False), (1, 1, "2010-02-05", 5.0, False)]
    df = clean.clean_sales(spark.createDataFrame(rows, "Store int, Dept int, Date string, Weekly_Sales double, IsHoliday boolean"))
    got = sorted((str(r["date"]), r["weekly_sales"]) for r in df.collect())
    assert got == [("2010-02-05", 4.0), ("None", 5.0), ("None", 7.0)]


def test_missing_predictions_count_in_no_term(spark):
    schema = "weekly_sales double, prediction double, isholiday int"
    full = [(100.0, 90.0, 0), (50.0, 55.0, 1), (80.0, 84.0, 0)]
    want = metrics.forecast_metrics(spark.createDataFrame(full, schema)).first()
    assert metrics.forecast_metrics(spark.createDataFrame(full + [(70.0, None, 1), (None, 3.0, 0)], schema)).first() == want
    errors = metrics.weighted_errors(spark.createDataFrame(full + [(70.0, None, 1)], schema), "weekly_sales", "prediction", "isholiday").first()
    assert errors["n"] == 3


def test_fingerprint_sees_rows_in_a_partition(spark, tmp_path):
    for name in shared.SOURCES:
        spark.range(4).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(f"{tmp_path}/{name}.parquet")
    before = shared._fingerprint(spark, str(tmp_path))
    assert shared._fingerprint(spark, str(tmp_path)) == before
    spark.range(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet/part=1")
    assert shared._fingerprint(spark, str(tmp_path)) != before
