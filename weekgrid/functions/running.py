"""Running totals over a long ordered column, split over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weekgrid.session import stored


def ranges(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """The table written out in value ranges of similar size, with the number of
    its range as ``bucket``; later ranges hold later values of a group."""
    ranged = df.repartitionByRange(*by, order).withColumn("bucket", F.spark_partition_id())
    return stored(ranged, "ranges")


def running_totals(ranged: DataFrame, by: list[str], order: str, measures: list[str]) -> DataFrame:
    """Adds ``<measure>_upto`` and ``next_value`` within each ``by`` group of a
    table from ``ranges`` with one row per group and ``order`` value.

    A window over a whole group would put it into one task. Here totals per
    range are accumulated first, over as many rows as there are ranges, and the
    window runs inside a range. Groups must be few (the columns of a table):
    their range totals are broadcast.
    """
    sums = ranged.groupBy(*by, "bucket").agg(
        F.min(order).alias("_first"), *[F.sum(m).alias(f"_{m}") for m in measures]
    )
    across = Window.partitionBy(*by).orderBy("bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        "bucket",
        F.lead("_first").over(across).alias("_following"),
        *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_{m}_before") for m in measures],
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(order)
    return (
        ranged.join(F.broadcast(offsets), [*by, "bucket"])
        .withColumns(
            {
                **{f"{m}_upto": F.col(f"_{m}_before") + F.sum(m).over(inside) for m in measures},
                "next_value": F.coalesce(F.lead(order).over(inside), F.col("_following")),
            }
        )
        .drop("bucket", "_following", *[f"_{m}_before" for m in measures])
    )
