"""Window expressions over one ordered weekly series per key."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec, functions as F


def series(keys: list[str], date: str = "date") -> WindowSpec:
    """One ordered series per key; every lag and frame shares this spec, so all
    of them run in one sort behind one exchange."""
    return Window.partitionBy(*keys).orderBy(date)


def _gate(value: Column, col: Column, frame: WindowSpec, needed: int) -> Column:
    return F.when(F.count(col).over(frame) >= needed, value)


def trailing_mean(col: Column, w: WindowSpec, length: int, needed: int = 1) -> Column:
    """Mean of the ``length`` rows before the current one."""
    frame = w.rowsBetween(-length, -1)
    mean = F.avg(col).over(frame)
    return mean if needed <= 1 else _gate(mean, col, frame, needed)


def trailing_std(col: Column, w: WindowSpec, length: int, needed: int) -> Column:
    frame = w.rowsBetween(-length, -1)
    return _gate(F.stddev_samp(col).over(frame), col, frame, needed)


def trailing_max(col: Column, w: WindowSpec, length: int) -> Column:
    return F.max(col).over(w.rowsBetween(-length, -1))


def forward_fill(col: Column, w: WindowSpec) -> Column:
    """Last known value up to the current row; leading NULLs stay NULL."""
    return F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def value_days_ago(col: Column, keys: list[str], date: str, days: int) -> Column:
    """The value of the same series exactly ``days`` earlier, NULL if absent.

    A RANGE frame of width one day takes the place of a date-shifted self join:
    one scan and one exchange instead of two of each, and calendar-exact on
    series with gaps. Needs at most one row per key and date.
    """
    frame = (
        Window.partitionBy(*keys)
        .orderBy(F.unix_date(F.col(date)))
        .rangeBetween(-days, -days)
    )
    return F.max(col).over(frame)


def centred_mean(col: Column, w: WindowSpec, period: int) -> Column:
    """Centred moving average; an even period gets half weights at both ends.
    NULL where the full span is not available."""
    half = period // 2
    if period % 2:
        frame = w.rowsBetween(-half, half)
        return _gate(F.avg(col).over(frame), col, frame, period)
    wide = w.rowsBetween(-half, half)
    inner = w.rowsBetween(-(half - 1), half - 1)
    total = F.sum(col).over(inner) + (F.lag(col, half).over(w) + F.lead(col, half).over(w)) / 2
    return _gate(total / F.lit(period), col, wide, period + 1)
