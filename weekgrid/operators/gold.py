"""The wide feature table: one row per store, department and week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekgrid.functions.calendar import cyclical, iso_week
from weekgrid.functions.columns import log_plus_one, row_total
from weekgrid.functions.trailing import series, trailing_mean
from weekgrid.operators.grid import complete_weeks

KEYS = ["store", "dept"]
MARKDOWNS = [f"markdown{i}" for i in range(1, 6)]
# The columns of the wide table and which of them a model reads.
NUMERIC = [
    "store_size", "temperature", "fuel_price", "cpi", "unemployment",
    *MARKDOWNS, "total_markdown", "lag_1_sales", "lag_5_sales", "sales_last_year",
    "rolling_4_wk_sales_avg", "cpi_lag_3_month", "sin_week", "cos_week",
]
CATEGORICAL = ["store", "dept", "store_type", "isholiday", "month", "week_of_year"]
COLUMNS = [
    "store", "dept", "date", "weekly_sales", "isholiday", "store_type", "store_size",
    "temperature", "fuel_price", "cpi", "unemployment", *MARKDOWNS, "total_markdown",
    "month", "week_of_year", "sales_log", "sin_week", "cos_week",
    "lag_1_log", "lag_5_log", "lag_52_log", "lag_1_sales", "lag_5_sales", "sales_last_year",
    "rolling_4_wk_log_sales_avg", "rolling_4_wk_sales_avg", "cpi_lag_3_month",
    "is_original_row",
]


def with_calendar(df: DataFrame, date: str = "date", period: int = 52) -> DataFrame:
    week = iso_week(F.col(date))
    sine, cosine = cyclical(week, period)
    return df.withColumns(
        {"month": F.month(date), "week_of_year": week, "sin_week": sine, "cos_week": cosine}
    )


def with_lags(
    df: DataFrame, short: int = 1, middle: int = 5, year: int = 52, length: int = 4
) -> DataFrame:
    """Lags and trailing means of sales, raw and logged, over one window spec."""
    w = series(KEYS)
    raw, log = F.col("weekly_sales"), log_plus_one(F.col("weekly_sales"))
    return df.withColumns(
        {
            "sales_log": log,
            "lag_1_log": F.lag(log, short).over(w),
            "lag_5_log": F.lag(log, middle).over(w),
            "lag_52_log": F.lag(log, year).over(w),
            "lag_1_sales": F.lag(raw, short).over(w),
            "lag_5_sales": F.lag(raw, middle).over(w),
            "sales_last_year": F.lag(raw, year).over(w),
            "rolling_4_wk_log_sales_avg": trailing_mean(log, w, length),
            "rolling_4_wk_sales_avg": trailing_mean(raw, w, length),
        }
    )


def with_macro_lag(features: DataFrame, weeks: int = 12) -> DataFrame:
    """CPI of ``weeks`` earlier, taken on the store-week table where a store has
    one row per week."""
    return features.withColumn("cpi_lag_3_month", F.lag("cpi", weeks).over(series(["store"])))


def merge_context(grid: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    """Attach weekly indicators and store attributes to the sales grid.

    Neither side is force-broadcast: adaptive execution broadcasts it if its
    measured size allows, and otherwise splits skewed partitions of the grid.
    """
    weekly = features.withColumnRenamed("isholiday", "_calendar_holiday")
    shops = stores.select(
        "store", F.col("type").alias("store_type"), F.col("size").alias("store_size")
    )
    return (
        grid.join(weekly, ["store", "date"], "left")
        .join(shops, "store", "left")
        .withColumns(
            {
                "isholiday": F.coalesce(
                    F.col("isholiday").cast("int"), F.col("_calendar_holiday").cast("int"), F.lit(0)
                ),
                "total_markdown": row_total(MARKDOWNS),
            }
        )
        .drop("_calendar_holiday")
    )


def sales_grid(sales: DataFrame, bounds: Column | None = None) -> DataFrame:
    """Sales on the full grid, weeks without sales as zero."""
    full = complete_weeks(sales, KEYS, ["weekly_sales", "isholiday"], bounds=bounds)
    return full.withColumn("weekly_sales", F.coalesce(F.col("weekly_sales"), F.lit(0.0)))


def build_gold(
    sales: DataFrame,
    features: DataFrame,
    stores: DataFrame,
    lags: tuple[int, int, int] = (1, 5, 52),
    window: int = 4,
    macro_lag: int = 12,
    period: int = 52,
    bounds: Column | None = None,
) -> DataFrame:
    """Grid, lags, indicators and calendar columns in one plan.

    The windows read sales only, so they run before the joins: the table is
    exchanged once by (store, dept) while it is narrow, and indicators join
    afterwards on (store, date). ``bounds``, the first and last date of the sales
    as ``functions.calendar.span`` gives them, should come from a stored table:
    without them the sales run a second time.
    """
    grid = with_lags(sales_grid(sales, bounds), *lags, length=window)
    wide = merge_context(grid, with_macro_lag(features, macro_lag), stores)
    return with_calendar(wide, period=period).select(*COLUMNS)
