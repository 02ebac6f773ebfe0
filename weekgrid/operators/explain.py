"""Model attribution without model internals: permutation and Shapley sampling."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window, functions as F

from weekgrid.functions.columns import ratio
from weekgrid.functions.running import ranges
from weekgrid.operators.forecast import TARGET, predict
from weekgrid.operators.metrics import holiday_weight, scored


def _wmape(df: DataFrame, by: list[str]) -> DataFrame:
    w = holiday_weight(F.col("_holiday"))
    error = w * F.abs(F.col(TARGET) - F.col("prediction"))
    return scored(df, TARGET, "prediction").groupBy(*by).agg((100.0 * ratio(F.sum(error), F.sum(w * F.col(TARGET)))).alias("wmape"))


def permutation_importance(
    model: PipelineModel, df: DataFrame, columns: list[str], keys: list[str], seed: int = 42
) -> DataFrame:
    """(feature, wmape, delta_wmape): how much worse the error gets when one
    column is shuffled.

    A row takes the value of the next row in a hash order of the whole table,
    the last row that of the first, so no value is lost. The order is cut into
    ranges, whose first rows, one per range, are handed to the range before. Then
    each row unfolds into one variant per column and all are scored together.
    """
    placed = ranges(df.withColumn("_order", F.xxhash64(*[F.col(k) for k in keys], F.lit(seed + 1))), [], "_order")
    given, order = F.struct(*columns), F.struct("_order", *keys)
    firsts = placed.groupBy("bucket").agg(F.min_by(given, order).alias("_first"))
    around = Window.partitionBy(F.lit(0)).orderBy("bucket")
    every = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("_first").over(around), F.first("_first").over(every))
    ends = firsts.select("bucket", following.alias("_following"))
    inside = Window.partitionBy("bucket").orderBy("_order", *keys)
    nearby = F.coalesce(F.lead(given).over(inside), F.col("_following"))
    shuffled = placed.join(F.broadcast(ends), "bucket").withColumn("_other", nearby)
    rest = [c for c in df.columns if c not in columns]
    variants = F.explode(F.array(F.lit("(none)"), *[F.lit(c) for c in columns]))
    spread = shuffled.withColumn("feature", variants).select(
        *rest,
        F.col("isholiday").cast("int").alias("_holiday"),
        "feature",
        *[
            F.when(F.col("feature") == c, F.col(f"_other.{c}")).otherwise(F.col(c)).alias(c)
            for c in columns
        ],
    )
    errors = _wmape(predict(model, spread), ["feature"])
    base = errors.where("feature = '(none)'").select("wmape").scalar()
    return errors.where("feature <> '(none)'").select(
        "feature", "wmape", (F.col("wmape") - base).alias("delta_wmape")
    )


def shapley(
    model: PipelineModel,
    rows: DataFrame,
    background: DataFrame,
    columns: list[str],
    keys: list[str],
    orders: int = 32,
    seed: int = 42,
) -> DataFrame:
    """(keys..., feature, attribution, base_value, prediction) for chosen rows.

    For each of ``orders`` column orders and background rows, columns change from
    the background row's value to the explained row's one after another; a
    feature's attribution is the mean change of the prediction at its turn. The
    attributions of a row add up to prediction - base_value exactly.
    """
    pairs = [F.col(k) for k in keys]
    drawn = (
        background.orderBy(F.xxhash64(*pairs, F.lit(seed)), *keys)
        .limit(orders)
        .withColumn("_n", F.xxhash64(*pairs, F.lit(seed + 1)))
        .select("_n", F.struct(*columns).alias("_from"))
    )
    # every explained row meets the same draws: key both sides by a constant slot
    asked = rows.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.struct(*columns).alias("_to"))
    draws = drawn.agg(F.collect_list(F.struct("_n", "_from"))).scalar()
    met = asked.withColumn("_draw", F.explode(draws)).select(
        *[f"_key_{k}" for k in keys], "_to", "_draw._n", "_draw._from"
    )
    order = F.array_sort(
        F.array(*[F.struct(F.xxhash64(F.col("_n"), F.lit(c)).alias("h"), F.lit(c).alias("c")) for c in columns])
    )
    ordered = met.withColumn("_order", F.transform(order, lambda s: s["c"])).withColumn(
        "_step", F.explode(F.sequence(F.lit(0), F.lit(len(columns))))
    )
    hybrid = ordered.select(
        *[f"_key_{k}" for k in keys],
        "_n",
        "_step",
        F.when(F.col("_step") > 0, F.element_at("_order", F.greatest(F.col("_step"), F.lit(1)))).alias("feature"),
        *[
            F.when(F.array_position("_order", c) <= F.col("_step"), F.col(f"_to.{c}"))
            .otherwise(F.col(f"_from.{c}"))
            .alias(c)
            for c in columns
        ],
    )
    scored = predict(model, hybrid)
    path = Window.partitionBy(*[f"_key_{k}" for k in keys], "_n").orderBy("_step")
    moved = scored.withColumn("_change", F.col("prediction") - F.lag("prediction").over(path))
    row_keys = [F.col(f"_key_{k}").alias(k) for k in keys]
    ends = moved.groupBy(*row_keys).agg(
        F.avg(F.when(F.col("_step") == 0, F.col("prediction"))).alias("base_value"),
        F.avg(F.when(F.col("_step") == len(columns), F.col("prediction"))).alias("prediction"),
    )
    return (
        moved.where("_step > 0")
        .groupBy(*row_keys, "feature")
        .agg(F.avg("_change").alias("attribution"))
        .join(ends, keys)
    )
