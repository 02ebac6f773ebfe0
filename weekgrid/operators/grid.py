"""Completing the series x week grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekgrid.functions.calendar import WEEK, span, week_spine
from weekgrid.functions.trailing import series


def calendar(df: DataFrame, date: str = "date", step: int = WEEK) -> DataFrame:
    """All weeks between the first and last date of a table."""
    ends = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return ends.select(F.explode(week_spine(F.col("lo"), F.col("hi"), step)).alias(date))


def scaffold(df: DataFrame, keys: list[str], date: str = "date", step: int = WEEK) -> DataFrame:
    """Every key with every week: each distinct key unfolds its own calendar,
    so no product join is planned."""
    ends = span(df, date)
    return df.select(*keys).distinct().select(
        *keys, F.explode(week_spine(ends["lo"], ends["hi"], step)).alias(date)
    )


def complete_weeks(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    date: str = "date",
    step: int = WEEK,
    observed: str = "is_original_row",
    bounds: Column | None = None,
) -> DataFrame:
    """The scaffold with the table left-joined onto it, without the join.

    Each row looks at the next date of its series and unfolds the missing weeks
    up to it; the first row also covers the weeks before it. One exchange by
    key replaces building the scaffold, and shuffling it against the table, and
    the lag windows that follow reuse that exchange. Added weeks have NULL
    ``values``. A date off the weekly grid counts for its key but not as a row.
    ``bounds`` (a struct of ``lo`` and ``hi``) spares the second run of ``df`` that
    its first and last date take otherwise.
    """
    ends = span(df, date) if bounds is None else bounds
    last = F.floor(F.datediff(ends["hi"], ends["lo"]) / step)
    offset = F.datediff(F.col(date), ends["lo"])
    placed = df.select(
        *keys,
        *values,
        F.floor(offset / step).alias("_pos"),
        (offset % step == 0).alias("_on_grid"),
    )
    w = series(keys, "_pos").orderBy("_pos", "_on_grid")
    unfolded = placed.select(
        "*",
        F.lead("_pos").over(w).alias("_next"),
        F.lag("_pos").over(w).isNull().alias("_first"),
    ).select(
        *keys,
        *values,
        "_pos",
        "_on_grid",
        F.when(F.col("_first"), F.lit(0).cast("bigint")).otherwise(F.col("_pos")).alias("_from"),
        F.when(F.col("_next").isNull(), last)
        .when(F.col("_on_grid"), F.greatest(F.col("_pos"), F.col("_next") - 1))
        .otherwise(F.col("_next") - 1)
        .alias("_to"),
    )
    spread = unfolded.where(F.col("_to") >= F.col("_from")).select(
        *keys, *values, "_pos", "_on_grid", F.explode(F.sequence("_from", "_to")).alias("_week")
    )
    own = (F.col("_week") == F.col("_pos")) & F.col("_on_grid")
    return spread.select(
        *keys,
        F.date_add(ends["lo"], (F.col("_week") * step).cast("int")).alias(date),
        *[F.when(own, F.col(v)).alias(v) for v in values],
        own.alias(observed),
    )


def gaps(df: DataFrame, keys: list[str], date: str = "date", step: int = WEEK) -> DataFrame:
    """Consecutive dates of a series that are not ``step`` days apart."""
    earlier = F.lag(date).over(series(keys, date))
    return df.select(*keys, date, F.datediff(F.col(date), earlier).alias("days_since_previous")).where(
        F.col("days_since_previous") != step
    )
