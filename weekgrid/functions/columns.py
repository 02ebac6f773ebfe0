"""Column expressions for cleaning, ratios and type handling."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T


def normalise_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def lenient_double(col: Column) -> Column:
    """Text to double; unreadable text and NaN become NULL."""
    return F.nanvl(col.try_cast("double"), F.lit(None).cast("double"))


def clip_low(col: Column, bound: float = 0.0) -> Column:
    """Raise values below ``bound``; NULL stays NULL (``greatest`` would lose it)."""
    return F.when(col < bound, F.lit(bound)).otherwise(col)


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def row_total(names: list[str]) -> Column:
    """Sum across columns of one row, NULL counted as zero."""
    return reduce(add, [zero_if_null(F.col(n)) for n in names])


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(top, bottom)


def log_plus_one(col: Column) -> Column:
    return F.log(col + F.lit(1.0))


def truncate_to_long(col: Column, digits: int = 2) -> Column:
    """Round, then cut the fraction off towards zero."""
    return F.round(col, digits).cast("bigint")


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def integer_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]


def storage_types(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Integers to double for nullable model input, categoricals to text.

    The text of a categorical comes from its integer value, so it reads ``1``
    and not ``1.0``.
    """
    ints = set(integer_names(df))
    out = {}
    for name in df.columns:
        if name in categorical:
            out[name] = F.col(name).cast("string")
        elif name in ints:
            out[name] = F.col(name).cast("double")
    return df.withColumns(out)


def rounded(df: DataFrame, digits: int, names: list[str] | None = None) -> DataFrame:
    """Round the double columns (all of them, or those named)."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    chosen = set(doubles if names is None else names)
    return df.select(
        *[F.round(F.col(c), digits).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )
