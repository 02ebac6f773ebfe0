"""Global row numbers without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weekgrid.llm.common import stored


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``rank`` (from 0, in ``order``, nulls first) and ``size`` of each row's group.

    Rows are sorted by range, so a hot group is cut over many tasks; a row's rank is
    its place in its range plus what the ranges before it hold of the group. The last
    column of ``order`` has to tell all rows apart: then no range is hot either, and
    a repeated task gives the same numbers. Groups may be null.
    """
    keys = [*group, *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("__part", F.shiftright("__at", 33)), name)
    # One row for each group that a range holds: at most ranges plus groups.
    held = placed.groupBy(*group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    mine = Window.partitionBy(*group)
    before = mine.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        *[F.col(g).alias(f"__{g}") for g in group], F.col("__part").alias("__in"), "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(mine).alias("size"),
    )
    same = F.col("__part") == F.col("__in")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    return placed.join(held, same).select(
        *rows.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("rank"), "size"
    )
