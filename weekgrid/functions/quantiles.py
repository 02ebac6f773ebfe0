"""Exact quantiles by repeated range counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekgrid.functions.longform import melt
from weekgrid.session import stored

ACCURACY, CELLS, TASK_ROWS = 10_000, 1024, 1_000_000


def _cell(value: Column, low: Column, high: Column, cells: int) -> Column:
    """Number of the sub-range of [low, high] a value falls into, growing with the
    value: -1 below, ``cells`` above, and the two ends alone in the first and the last."""
    share = F.nanvl((value - low) / F.when(high > low, high - low).otherwise(1.0), F.lit(0.0))
    inner = 1 + F.least(F.greatest(F.floor(share * (cells - 2)), F.lit(0)), F.lit(cells - 3))
    return (
        F.when(value < low, -1).when(value > high, cells).when(value == low, 0).when(value == high, cells - 1).otherwise(inner)
    ).cast("int")


def _spread(values: DataFrame, sketch: DataFrame, keys: list[str], task_rows: int) -> DataFrame:
    """Rows with ``_salt``: a group of more than ``task_rows`` rows gets a salt for each
    ``task_rows`` of them. Such groups are at most rows / task_rows, so they are broadcast."""
    salts = F.ceil(F.col("n") / task_rows).cast("int")
    hot = F.broadcast(sketch.where(F.col("n") > task_rows).select(*keys, salts.alias("_salts")))
    place = F.pmod(F.monotonically_increasing_id(), F.coalesce("_salts", F.lit(1)))
    return values.join(hot, keys, "left").withColumn("_salt", place).drop("_salts")


def quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    by: list[str] | None = None,
    discrete: bool = False,
    accuracy: int = ACCURACY,
    cells: int = CELLS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """(by..., column, prob, value) for every column and probability; NULLs ignored.

    A mergeable sketch gives each wanted rank a first range of values. Every pass then
    counts the rows in ``cells`` parts of the range, and what lies below and above it,
    and the part that holds the rank is the next range, until it holds one value (or
    the two neighbours that a rank between them needs). Counting combines map-side, so
    neither a column nor a range ever meets in one task, and no rank is missed however
    wrong the sketch is. A pass is a job: two or three are usual, and a range that does
    not shrink otherwise loses both its ends in each.

    Without ``by`` the ranges, one row per column and probability, are broadcast. With
    it they are joined, and groups of more than ``task_rows`` rows are salted by their
    measured counts.
    """
    by = list(by or [])
    keys = [*by, "column"]
    values = melt(df, columns, by).where(F.col("value").isNotNull())
    margin = 2.0 / accuracy
    wanted = [p for q in probs for p in (max(0.0, q - margin), min(1.0, q + margin))]
    sketch = stored(
        values.groupBy(*keys).agg(F.count("value").alias("n"), F.percentile_approx("value", wanted, accuracy).alias("edge")), "sketch"
    )
    ranges = []
    for i, q in enumerate(probs):
        rank = F.ceil(F.lit(q) * F.col("n")) - 1 if discrete else F.lit(q) * (F.col("n") - 1)
        ranges.append(
            F.struct(
                F.lit(q).alias("prob"),
                F.greatest(rank.cast("double"), F.lit(0.0)).alias("rank"),
                F.col("edge")[2 * i].alias("low"),
                F.col("edge")[2 * i + 1].alias("high"),
            )
        )
    open_ = sketch.select(*keys, F.inline(F.array(*ranges)))
    if by:
        values = _spread(values, sketch, keys, task_rows)
    target = [*keys, "prob", "rank"]
    done = None
    while True:
        ranged = open_.groupBy(*keys).agg(F.collect_list(F.struct("prob", "rank", "low", "high")).alias("ranges"))
        if by:
            salts = F.sequence(F.lit(0), F.ceil(F.col("n") / task_rows).cast("int") - 1)
            met = values.join(ranged.join(sketch.select(*keys, "n"), keys).withColumn("_salt", F.explode(salts)).drop("n"), [*keys, "_salt"])
        else:
            met = values.join(F.broadcast(ranged), keys)
        cell = _cell(F.col("value"), F.col("low"), F.col("high"), cells)
        counted = met.select(*keys, "value", F.inline("ranges")).groupBy(*target, cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("c"), F.min("value").alias("least"), F.max("value").alias("most")
        )
        # At most cells + 2 rows per rank meet in this window.
        upto = F.sum("c").over(Window.partitionBy(*target).orderBy("cell"))
        first, second = F.floor("rank"), F.ceil("rank")

        def holding(rank: Column) -> Column:
            place = F.struct("cell", "least", "most", "upto")
            return F.min(F.when(F.col("upto") > rank, place))

        found = counted.withColumn("upto", upto).groupBy(*target).agg(holding(first).alias("a"), holding(second).alias("b"))
        apart = F.col("a.cell") != F.col("b.cell")
        found = found.select(
            *target, F.when(apart, F.col("a.most")).otherwise(F.col("a.least")).alias("low"),
            F.when(apart, F.col("b.least")).otherwise(F.col("a.most")).alias("high"),
            (apart | (F.col("a.least") == F.col("a.most"))).alias("done"),
        )
        found = stored(found, "ranks")
        fixed = found.where("done").drop("done")
        done = fixed if done is None else done.unionByName(fixed)
        open_ = found.where("NOT done").drop("done")
        if not open_.limit(1).count():
            break
    part = F.col("rank") - F.floor("rank")
    # Not low + 0 * (high - low) for whole ranks, which would fail for infinite values.
    value = F.when(part == 0, F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * part)
    return done.select(*keys, "prob", value.cast("double").alias("value"))


def quantiles_wide(
    df: DataFrame, columns: list[str], probs: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """One row per (by..., column) with a named column per probability."""
    long = quantiles(df, columns, list(probs.values()), by)
    return long.groupBy(*(by or []), "column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in probs.items()]
    )


def calendar_quantiles(df: DataFrame, date: str, probs: list[float], discrete: bool = True) -> DataFrame:
    """Quantiles of a date column as one row ``q0, q1, ...`` of day numbers.

    Rows are counted per date first, so the running total covers one row per
    calendar date of the panel, a few hundred, whatever the table size.
    """
    per_day = df.where(F.col(date).isNotNull()).groupBy(date).agg(F.count("*").alias("c"))
    whole = Window.partitionBy(F.lit(0))
    ranked = per_day.select(
        F.unix_date(F.col(date)).alias("day"),
        F.sum("c").over(whole.orderBy(date)).alias("upto"),
        F.sum("c").over(whole).alias("n"),
    )
    out = []
    for i, q in enumerate(probs):
        if discrete:
            hit = F.when(F.col("upto") >= F.greatest(F.ceil(F.lit(q) * F.col("n")), F.lit(1)), F.col("day"))
            out.append(F.min(hit).cast("double").alias(f"q{i}"))
            continue
        rank = F.lit(q) * (F.col("n") - 1)
        low = F.min(F.when(F.col("upto") > F.floor(rank), F.col("day")))
        high = F.min(F.when(F.col("upto") > F.ceil(rank), F.col("day")))
        part = F.max(rank - F.floor(rank))
        out.append((low + (high - low) * part).cast("double").alias(f"q{i}"))
    return ranked.agg(*out)
