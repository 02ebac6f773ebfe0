"""Table profiles in long form: one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weekgrid.functions.columns import ratio
from weekgrid.functions.correlation import pair_correlations
from weekgrid.functions.longform import melt, melt_row
from weekgrid.functions.quantiles import quantiles_wide


def schema(df: DataFrame) -> DataFrame:
    """Type and non-null count per column."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return melt_row(
        row, {c: [F.lit(t), F.col(c)] for c, t in df.dtypes}, ["column", "dtype", "non_null"]
    )


def missing(df: DataFrame) -> DataFrame:
    """NULL count and percentage per column."""
    row = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in df.columns])
    return melt_row(
        row,
        {c: [F.col("_n") - F.col(c), ratio(100.0 * (F.col("_n") - F.col(c)), F.col("_n"))] for c in df.columns},
        ["column", "null_count", "missing_pct"],
    )


def null_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """How far two columns are missing together; constant indicators are left out."""
    flags = df.select(*[F.col(c).isNull().cast("int").alias(c) for c in columns])
    return pair_correlations(flags, columns).where(F.col("score").isNotNull())


def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    moments = melt(df, columns).groupBy("column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantiles_wide(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, "column", "left")


def categorical(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct count, most frequent value (smallest on ties) and its count."""
    counts = (
        melt(df, columns, cast="string").where("value IS NOT NULL").groupBy("column", "value").count()
    )
    best = F.min(F.struct((-F.col("count")).alias("neg"), F.col("value").alias("value")))
    return counts.groupBy("column").agg(
        F.sum("count").alias("n"), F.count("*").alias("distinct_values"), best.alias("best")
    ).select(
        "column", "n", "distinct_values", F.col("best.value").alias("top"), (-F.col("best.neg")).alias("freq")
    )


def duplicates(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with the number of later copies."""
    return (
        df.groupBy(*df.columns)
        .agg((F.count("*") - 1).alias("extra_copies"))
        .where("extra_copies > 0")
    )


def cardinality(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values per column; ``approximate`` uses a fixed-size sketch."""
    columns = columns or df.columns
    count = F.approx_count_distinct if approximate else F.count_distinct
    row = df.agg(*[count(F.col(c)).alias(c) for c in columns])
    return melt_row(row, {c: [F.col(c)] for c in columns}, ["column", "distinct_values"])


def skewness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bias-corrected skewness per column."""
    values = melt(df, columns)
    n = F.col("n").cast("double")
    # a constant column has no skewness and would divide by zero
    return (
        values.groupBy("column")
        .agg(
            F.count("value").alias("n"),
            F.when(F.min("value") < F.max("value"), F.skewness("value")).alias("g"),
        )
        .select(
            "column", F.when(F.col("n") > 2, F.col("g") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew")
        )
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, bin_start, n) of equal-width bins between minimum and maximum."""
    ends = df.agg(
        F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("e")
    ).scalar()
    value = F.col(column).cast("double")
    width = (ends["hi"] - ends["lo"]) / F.lit(bins)
    place = F.floor(F.coalesce(ratio(value - ends["lo"], width), F.lit(0.0)))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("bin", (ends["lo"] + F.col("bin") * width).alias("bin_start"), "n")
    )


def outliers(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """Box-plot figures per column and the number of values outside the whiskers."""
    box = quantiles_wide(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    box = box.withColumns({"lower": F.col("q1") - reach * iqr, "upper": F.col("q3") + reach * iqr})
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    names = ["q1", "median", "q3", "lower", "upper"]
    return (
        melt(df, columns)
        .join(F.broadcast(box), "column")  # one row per column
        .groupBy("column", *names)
        .agg(F.count_if(outside).alias("n_outliers"))
    )


def lift_by_flag(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Mean, median and count per flag value, with the change of the mean against flag 0."""
    stats = df.groupBy(flag).agg(F.avg(value).alias("mean_sales"), F.count(value).alias("n"))
    medians = quantiles_wide(df, [value], {"median_sales": 0.5}, [flag]).drop("column")
    normal = df.where(F.col(flag) == 0).agg(F.avg(value)).scalar()
    change = ratio(100.0 * (F.col("mean_sales") - normal), normal)
    return stats.join(medians, flag).withColumn("lift_pct", change)


def mean_interval(df: DataFrame, by: str, value: str, z: float = 1.96) -> DataFrame:
    """Mean per group with a normal 95 % interval."""
    half = z * F.col("s") / F.sqrt(F.col("n"))
    return (
        df.groupBy(by)
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("s"), F.count(value).alias("n"))
        .select(by, "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"), "n")
    )
