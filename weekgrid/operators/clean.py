"""Raw tables to typed, deduplicated and bounded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weekgrid.functions.calendar import parse_date
from weekgrid.functions.columns import clip_low, lenient_double, normalise_columns, zero_if_null
from weekgrid.functions.trailing import forward_fill, series

MARKDOWNS = [f"markdown{i}" for i in range(1, 6)]
MACRO = ["cpi", "unemployment"]


def first_by_key(df: DataFrame, keys: list[str], prefer: list[str]) -> DataFrame:
    """One row per key: the greatest by ``prefer``, then by the other columns.

    An aggregate, not a ranked window: copies of a key are combined map-side,
    so a key that owns a third of all rows never lands whole in one task, and
    the chosen row does not depend on row order.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in prefer if c in rest] + [c for c in rest if c not in prefer]
    if not order:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"best.{c}") for c in df.columns])


def clean_sales(bronze: DataFrame) -> DataFrame:
    """Lower-case names, one row per store, department and date text, no negative
    sales. Dates are parsed after that, so rows with different unreadable dates
    stay apart, each with a NULL date."""
    df = first_by_key(normalise_columns(bronze), ["store", "dept", "date"], ["weekly_sales", "isholiday"])
    return df.withColumns({"date": parse_date(F.col("date")), "weekly_sales": clip_low(F.col("weekly_sales"))})


def clean_features(bronze: DataFrame) -> DataFrame:
    """Typed weekly indicators: markdowns default to zero and never negative,
    macro columns carried forward in date order within each store."""
    df = normalise_columns(bronze).withColumn("date", parse_date(F.col("date")))
    w = series(["store"])
    return df.withColumns(
        {
            **{m: clip_low(zero_if_null(lenient_double(F.col(m)))) for m in MARKDOWNS},
            **{m: forward_fill(lenient_double(F.col(m)), w) for m in MACRO},
        }
    )


def clean_stores(bronze: DataFrame) -> DataFrame:
    return normalise_columns(bronze)
