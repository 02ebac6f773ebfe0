import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from weekgrid.functions import columns
from weekgrid.functions.trailing import value_days_ago
from weekgrid.operators import clean, gold as gold_ops, grid

DAY0 = dt.date(2010, 2, 5)


def week(i, off=0):
    return DAY0 + dt.timedelta(days=7 * i + off)


def test_names_are_normalised(spark):
    df = spark.createDataFrame([(1, 2)], [" Weekly Sales ", "IsHoliday"])
    assert columns.normalise_columns(df).columns == ["weekly_sales", "isholiday"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-2.0,), (3.0,), (None,)], "v double")
    assert [r[0] for r in df.select(columns.clip_low(F.col("v"))).collect()] == [0.0, 3.0, None]


def test_lenient_double_drops_text_and_nan(spark):
    df = spark.createDataFrame([("1.5",), ("NA",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(columns.lenient_double(F.col("v"))).collect()] == [1.5, None, None, None]


def test_clean_sales_dedups_clips_and_parses(spark):
    rows = [
        (1, 1, "05/02/2010", -5.0, False),
        (1, 1, "12/02/2010", 3.0, True),
        (1, 1, "12/02/2010", 7.0, False),
        (1, 1, "not a date", 1.0, False),
    ]
    raw = spark.createDataFrame(rows, "Store int, Dept int, Date string, Weekly_Sales double, IsHoliday boolean")
    got = {r["date"]: (r["weekly_sales"], r["isholiday"]) for r in clean.clean_sales(raw).collect()}
    assert got == {week(0): (0.0, False), week(1): (7.0, False), None: (1.0, False)}


def test_clean_features_fills_forward_within_store_only(spark):
    names = "Store int, Date string, Temperature double, Fuel_Price double, MarkDown1 string, MarkDown2 string," \
        " MarkDown3 string, MarkDown4 string, MarkDown5 string, CPI string, Unemployment string, IsHoliday boolean"
    blank = ("NA", "NA", "NA", "NA")
    rows = [
        (1, "12/02/2010", 1.0, 2.0, "-4", *blank, "NA", "8.1", False),
        (1, "05/02/2010", 1.0, 2.0, "5.5", *blank, "200.5", "NA", False),
        (2, "05/02/2010", 1.0, 2.0, "NA", *blank, "NA", "7", False),
    ]
    got = {
        (r["store"], r["date"]): (r["markdown1"], r["cpi"], r["unemployment"])
        for r in clean.clean_features(spark.createDataFrame(rows, names)).collect()
    }
    assert got == {
        (1, week(0)): (5.5, 200.5, None),
        (1, week(1)): (0.0, 200.5, 8.1),
        (2, week(0)): (0.0, None, 7.0),
    }


def expected_grid(rows):
    """The scaffold left-joined with the rows, by brute force."""
    lo, hi = min(r[2] for r in rows), max(r[2] for r in rows)
    weeks = [lo + dt.timedelta(days=7 * i) for i in range((hi - lo).days // 7 + 1)]
    out = []
    for s, d in sorted({(r[0], r[1]) for r in rows}):
        for w in weeks:
            hits = [r[3] for r in rows if r[:3] == (s, d, w)]
            out += [(s, d, w, v, True) for v in hits] or [(s, d, w, None, False)]
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(1, 3), st.integers(1, 2), st.integers(0, 9), st.sampled_from([0, 0, 0, 0, 3])),
        min_size=1,
        max_size=14,
        unique_by=lambda t: t[:3] if t[3] == 0 else t,
    )
)
def test_complete_weeks_equals_scaffold_join(spark, picks):
    rows = [(s, d, week(i, off), float(10 * s + i + off)) for s, d, i, off in picks]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")
    got = grid.complete_weeks(df, ["store", "dept"], ["weekly_sales"]).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_grid(rows)


def test_complete_weeks_keeps_both_rows_of_a_duplicate_key(spark):
    rows = [(1, 1, week(0), 1.0), (1, 1, week(0), 2.0), (1, 1, week(2), 3.0)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")
    got = sorted((tuple(r) for r in grid.complete_weeks(df, ["store", "dept"], ["weekly_sales"]).collect()), key=repr)
    assert got == expected_grid(rows)


def test_scaffold_has_every_series_and_week(spark, small_panel):
    sales = small_panel.silver_sales
    series = sales.select("store", "dept").distinct().count()
    weeks = grid.calendar(sales).count()
    full = grid.scaffold(sales, ["store", "dept"])
    assert full.count() == series * weeks
    assert full.distinct().count() == series * weeks


def test_gaps_reports_missing_weeks_only(spark):
    df = spark.createDataFrame([(1, 1, week(0)), (1, 1, week(1)), (1, 1, week(4))], "store int, dept int, date date")
    assert [(r["date"], r["days_since_previous"]) for r in grid.gaps(df, ["store", "dept"]).collect()] == [(week(4), 21)]


def test_year_ago_value_is_calendar_exact(spark):
    rows = [(1, 1, week(0), 5.0), (1, 1, week(52), 6.0), (1, 1, week(53), 7.0), (2, 1, week(52), 8.0)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, v double")
    ago = value_days_ago(F.col("v"), ["store", "dept"], "date", 364)
    got = {(r["store"], r["date"]): r["a"] for r in df.withColumn("a", ago).collect()}
    assert got == {(1, week(0)): None, (1, week(52)): 5.0, (1, week(53)): None, (2, week(52)): None}


def test_gold_against_pandas(spark, small_gold):
    gold = small_gold.toPandas().sort_values(["store", "dept", "date"])
    assert not gold.duplicated(["store", "dept", "date"]).any()
    assert list(gold.columns) == gold_ops.COLUMNS
    by = gold.groupby(["store", "dept"])["weekly_sales"]
    pd.testing.assert_series_equal(gold["lag_5_sales"], by.shift(5), check_names=False)
    pd.testing.assert_series_equal(gold["sales_last_year"], by.shift(52), check_names=False)
    mean = by.transform(lambda x: x.shift(1).rolling(4, min_periods=1).mean())
    pd.testing.assert_series_equal(gold["rolling_4_wk_sales_avg"], mean, check_names=False)
    weeks = gold["date"].nunique()
    assert (gold.groupby(["store", "dept"]).size() == weeks).all()


def test_trailing_mean_never_sees_the_current_row(spark):
    rows = [(1, 1, week(i), 0.0) for i in range(6)] + [(1, 1, week(6), 1e9)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")
    last = gold_ops.with_lags(df).orderBy(F.desc("date")).first()
    assert last["rolling_4_wk_sales_avg"] == 0.0 and last["lag_1_sales"] == 0.0


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_partitioned_table_round_trip(spark, tmp_path, fmt):
    from weekgrid.sources import tables

    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "store int, v string")
    path = str(tmp_path / "t")
    tables.write_table(df, path, ["store"], fmt)
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["store=1", "store=2"]
    assert sorted(map(tuple, tables.read_table(spark, path, fmt).select("store", "v").collect())) == [
        (1, "a"), (2, "b"), (2, "c"),
    ]


def test_snapshots_by_version_time_and_latest(spark, tmp_path):
    from weekgrid.sources import tables

    path = str(tmp_path / "versions")
    for version, time in enumerate(["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"]):
        tables.write_snapshot(spark.createDataFrame([(version,)], "v int"), path, version, time)
    value = lambda df: [r["v"] for r in df.collect()]
    assert value(tables.read_snapshot(spark, path, 1)) == [1]
    assert value(tables.read_snapshot(spark, path)) == [2]
    assert value(tables.read_snapshot(spark, path, as_of="2024-02-15 00:00:00")) == [1]
