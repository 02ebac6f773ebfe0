"""Weekly calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

WEEK = 7
YEAR_IN_DAYS = 364  # 52 whole weeks


def parse_date(col: Column, pattern: str = "dd/MM/yyyy", lenient: bool = True) -> Column:
    return F.try_to_date(col, pattern) if lenient else F.to_date(col, pattern)


def span(df: DataFrame, date: str = "date") -> Column:
    """First and last date of a table as one scalar-subquery struct column."""
    one_row = df.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi")).alias("span"))
    return one_row.scalar()


def week_spine(lo: Column, hi: Column, step: int = WEEK) -> Column:
    """Every ``step``-th date from ``lo`` to ``hi`` as an array."""
    return F.sequence(lo, hi, F.make_dt_interval(F.lit(step)))


def anchored_spine(lo: Column, hi: Column, weekday: str = "FR") -> Column:
    """Every given weekday between ``lo`` and ``hi`` as an array."""
    first = F.next_day(F.date_sub(lo, 1), weekday)
    return F.when(first <= hi, week_spine(first, hi)).otherwise(
        F.array().cast("array<date>")
    )


def iso_week(col: Column) -> Column:
    return F.weekofyear(col)


def cyclical(week: Column, period: int = 52) -> tuple[Column, Column]:
    """Sine and cosine of the position in the yearly cycle."""
    angle = F.lit(2 * math.pi) * week / F.lit(period)
    return F.sin(angle), F.cos(angle)
