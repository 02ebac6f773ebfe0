"""Pearson correlation of column pairs in a single pass."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weekgrid.functions.columns import ratio


def pearson(a: Column, b: Column) -> Column:
    """Correlation over rows where both are present; NULL for a constant column.

    ``corr`` raises on a zero variance, hence covariance over deviations.
    """
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return ratio(F.covar_pop(a, b), spread)


def _block_sums(columns: int, shift: list[float]):
    """Per task one row per column pair: rows where both are present, and over these the
    sums, squares and products of the values less their column's ``shift``.

    A batch is a matrix, its missing cells zeros, beside the matrix of what is present;
    all sums of all pairs are products of the two.
    """
    centre = np.array(shift)

    def run(batches):
        i, j = np.triu_indices(columns, 1)
        n, sx, sxx, sxy = (np.zeros((columns, columns)) for _ in range(4))
        for batch in batches:
            cells = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            x = np.where(there > 0, np.column_stack(cells) - centre, 0.0)
            n += there.T @ there
            sx += x.T @ there
            sxx += (x * x).T @ there
            sxy += x.T @ x
        sums = [n[i, j], sx[i, j], sx[j, i], sxx[i, j], sxx[j, i], sxy[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *map(pa.array, sums)], ["i", "j", *SUMS])

    return run


SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, score) for every unordered pair of columns, over the rows where both are
    present; NULL for a constant column, or where no row has both.

    One pass adds up co-moments per batch as matrix products; what leaves a task is one
    row per pair, whatever its rows, and Spark adds these up. Values are shifted by
    their column's mean first, so that the sums keep their precision.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    means = doubles.agg(*[F.avg(c).alias(c) for c in columns]).first()
    shift = [means[c] if means[c] is not None and np.isfinite(means[c]) else 0.0 for c in columns]
    schema = "i long, j long, " + ", ".join(f"{s} double" for s in SUMS)
    sums = doubles.mapInArrow(_block_sums(len(columns), shift), schema).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])
    n = F.col("n")
    spread_x = F.col("sxx") - ratio(F.col("sx") * F.col("sx"), n)
    spread_y = F.col("syy") - ratio(F.col("sy") * F.col("sy"), n)
    # What rounding leaves of a constant column is no spread.
    varies = (spread_x > 1e-14 * F.col("sxx")) & (spread_y > 1e-14 * F.col("syy"))
    product = F.col("sxy") - ratio(F.col("sx") * F.col("sy"), n)
    score = F.when(varies, product / (F.sqrt(spread_x) * F.sqrt(spread_y)))
    names = F.array(*map(F.lit, columns))
    return sums.select(names[F.col("i").cast("int")].alias("a"), names[F.col("j").cast("int")].alias("b"), score.alias("score"))


def target_correlations(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(column, score) of every column against one target, strongest first."""
    cells = [
        F.struct(F.lit(i).alias("place"), F.col(c).cast("double").alias("x"))
        for i, c in enumerate(columns)
    ]
    names = F.array(*map(F.lit, columns))
    scores = (
        df.select(F.col(target).cast("double").alias("y"), F.inline(F.array(*cells)))
        .groupBy("place")
        .agg(pearson(F.col("y"), F.col("x")).alias("score"))
    )
    return scores.select(names[F.col("place")].alias("column"), "score").orderBy(
        F.desc_nulls_last("score"), "column"
    )
