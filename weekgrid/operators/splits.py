"""Chronological splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekgrid.functions.quantiles import calendar_quantiles


def drop_warmup(df: DataFrame, anchor: str = "sales_last_year") -> DataFrame:
    """Rows with a full year of history."""
    return df.na.drop(subset=[anchor])


def boundaries(df: DataFrame, probs: tuple[float, ...] = (0.70, 0.85), date: str = "date") -> DataFrame:
    """One row of boundary dates ``b1, b2, ...``."""
    days = calendar_quantiles(df, date, list(probs))
    return days.select(
        *[F.date_from_unix_date(F.col(f"q{i}").cast("int")).alias(f"b{i + 1}") for i in range(len(probs))]
    )


def chronological(
    df: DataFrame,
    probs: tuple[float, ...] = (0.70, 0.85),
    labels: tuple[str, ...] = ("train", "val", "test"),
    date: str = "date",
) -> DataFrame:
    """Adds ``split``: up to and including the first boundary, up to the second,
    and after. The boundaries enter as a scalar subquery, so there is one plan
    and nothing is collected."""
    row = boundaries(df, probs, date)
    bound = row.select(F.struct(*row.columns).alias("b")).scalar()
    split: Column = F.lit(labels[-1])
    for i in reversed(range(len(probs))):
        split = F.when(F.col(date) <= bound[f"b{i + 1}"], F.lit(labels[i])).otherwise(split)
    return df.withColumn("split", split)


def two_way(df: DataFrame, prob: float = 0.8, date: str = "date") -> DataFrame:
    """Adds ``split``: before the interpolated quantile date, and from it on."""
    day = calendar_quantiles(df, date, [prob], discrete=False).scalar()
    return df.withColumn("split", F.when(F.unix_date(F.col(date)) < day, "train").otherwise("test"))


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test frames of a labelled table."""
    return tuple(df.where(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
