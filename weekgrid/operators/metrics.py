"""Forecast evaluation, seasonal baseline, candidate choice and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekgrid.functions.calendar import YEAR_IN_DAYS
from weekgrid.functions.columns import ratio
from weekgrid.functions.trailing import value_days_ago

HOLIDAY_WEIGHT = 5


def holiday_weight(holiday: Column, weight: int = HOLIDAY_WEIGHT) -> Column:
    return F.when(holiday.cast("int") == 1, F.lit(float(weight))).otherwise(F.lit(1.0))


def same_week_last_year(
    sales: DataFrame, value: str = "weekly_sales", days: int = YEAR_IN_DAYS
) -> DataFrame:
    """Adds ``baseline_prediction``, the sales 52 weeks before; weeks without it drop out."""
    earlier = value_days_ago(F.col(value), ["store", "dept"], "date", days)
    return sales.withColumn("baseline_prediction", earlier).where("baseline_prediction IS NOT NULL")


def scored(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows with both values: a missing prediction must not count in any term."""
    return df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())


def weighted_errors(
    df: DataFrame,
    actual: str,
    predicted: str,
    holiday: str,
    by: list[str] | None = None,
    weight: int = HOLIDAY_WEIGHT,
    absolute_base: bool = False,
) -> DataFrame:
    """Weighted mean absolute error and its share of weighted sales (a fraction)."""
    w = holiday_weight(F.col(holiday), weight)
    error = w * F.abs(F.col(actual) - F.col(predicted))
    base = F.abs(F.col(actual)) if absolute_base else F.col(actual)
    return scored(df, actual, predicted).groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        ratio(F.sum(error), F.sum(w)).alias("wmae"),
        ratio(F.sum(error), F.sum(w * base)).alias("wmape"),
    )


def forecast_metrics(
    df: DataFrame,
    actual: str = "weekly_sales",
    predicted: str = "prediction",
    holiday: str = "isholiday",
    by: list[str] | None = None,
    weight: int = HOLIDAY_WEIGHT,
) -> DataFrame:
    """WMAPE in percent, MAE, RMSE and R2 in one pass, rounded half to even, over
    the rows that have both values."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    w = holiday_weight(F.col(holiday), weight)
    n = F.count("*")
    return scored(df, actual, predicted).groupBy(*(by or [])).agg(
        F.bround(100.0 * ratio(F.sum(w * F.abs(e)), F.sum(w * y)), 2).alias("wmape"),
        F.bround(F.avg(F.abs(e)), 2).alias("mae"),
        F.bround(F.sqrt(F.avg(e * e)), 2).alias("rmse"),
        F.bround(1.0 - ratio(F.sum(e * e), n * F.var_pop(y)), 4).alias("r2"),
    )


def select_candidate(runs: DataFrame, max_wmape: float = 8.5, shortlist: int = 10) -> DataFrame:
    """The run with the lowest blend of error, latency and size.

    Missing figures count as 10 % error, 50 ms and 5 MB. The shortlist is the
    best ``shortlist`` runs by error, a fixed order where a store returns any.
    """
    score = (
        F.coalesce("wmape_val", F.lit(10.0)) * 0.7
        + F.coalesce("latency_ms", F.lit(50.0)) * 0.2
        + F.coalesce("model_size_mb", F.lit(5.0)) * 0.1
    )
    passing = runs.where(F.col("wmape_val") < max_wmape).orderBy("wmape_val", "run_id").limit(shortlist)
    return passing.withColumn("score", score).orderBy("score", "run_id").limit(1)


def quality_gates(
    metrics: DataFrame, max_wmape: float = 8.5, min_r2: float = 0.95, max_latency_ms: float = 25.0
) -> DataFrame:
    """Adds a verdict per gate and ``promoted``, true when all gates hold."""
    gates = {
        "pass_wmape": F.col("wmape") <= max_wmape,
        "pass_r2": F.col("r2") >= min_r2,
        "pass_latency": F.col("latency_ms") <= max_latency_ms,
    }
    every = F.coalesce(gates["pass_wmape"] & gates["pass_r2"] & gates["pass_latency"], F.lit(False))
    return metrics.withColumns(gates).withColumn("promoted", every)
