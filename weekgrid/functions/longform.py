"""Wide tables to long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def melt(df: DataFrame, columns: list[str], by: list[str] | tuple = (), cast: str = "double") -> DataFrame:
    """(by..., column, value): one row per input row and column, without a shuffle."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value")) for c in columns
    ]
    return df.select(*by, F.inline(F.array(*cells)))


def melt_row(one_row: DataFrame, entries: dict[str, list], names: list[str], by: list[str] | tuple = ()) -> DataFrame:
    """Spread the aggregates of one row: an output row per entry.

    ``entries`` maps the text of the first column to the expressions of the
    remaining ones.
    """
    cells = [
        F.struct(F.lit(k).alias(names[0]), *[e.alias(n) for e, n in zip(v, names[1:])])
        for k, v in entries.items()
    ]
    return one_row.select(*by, F.inline(F.array(*cells)))
