"""Contextual anomaly detection on ratios of sales to their context."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from weekgrid.functions.columns import ratio, zero_if_null
from weekgrid.functions.quantiles import quantiles
from weekgrid.session import stored

KEYS = ["store", "dept", "date"]
RATIOS = [
    "yoy_growth_ratio",
    "trend_deviation_ratio",
    "markdown_intensity_ratio",
    "markdown_cannibalization",
    "footprint_yield",
    "holiday_miss_severity",
]
REPORT = [
    "store", "dept", "date", "isholiday", "weekly_sales", "sales_last_year", "rolling_4_wk_sales_avg",
    "yoy_growth_ratio", "trend_deviation_ratio", "total_markdown", "markdown_intensity_ratio",
    "markdown_cannibalization", "footprint_yield", "holiday_miss_severity",
]
EULER = 0.5772156649015329


def ratios(gold: DataFrame) -> DataFrame:
    """Rows past the warm-up year with six dimensionless ratios."""
    sales = F.col("weekly_sales")
    first = gold.na.drop(subset=["sales_last_year"]).withColumns(
        {
            "yoy_growth_ratio": ratio(sales, F.col("sales_last_year") + 1),
            "trend_deviation_ratio": ratio(sales, F.col("rolling_4_wk_sales_avg") + 1),
            "markdown_intensity_ratio": ratio(F.col("total_markdown"), sales + 1),
        }
    )
    return first.withColumns(
        {
            "markdown_cannibalization": ratio(
                F.col("markdown_intensity_ratio"), F.col("yoy_growth_ratio") + 0.01
            ),
            "footprint_yield": ratio(sales, F.col("store_size").cast("double")),
            "holiday_miss_severity": F.when(
                F.col("isholiday") == 1, F.col("trend_deviation_ratio")
            ).otherwise(F.lit(1.0)),
        }
    )


def holiday_misses(df: DataFrame) -> DataFrame:
    """Holiday weeks that sold less than the four weeks before them."""
    return df.where((F.col("isholiday") == 1) & (F.col("trend_deviation_ratio") < 1.0))


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a tree of ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


@dataclass(frozen=True)
class IsolationForest:
    """Fitted trees as arrays (tree, node); leaves point to themselves."""

    columns: tuple[str, ...]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    sample_size: int

    def score(self, df: DataFrame, name: str = "anomaly_score") -> DataFrame:
        """Adds the anomaly score, 0 to 1; NULL inputs count as zero."""
        trees = df.sparkSession.sparkContext.broadcast(
            (self.feature, self.threshold, self.left, self.right, self.depth)
        )
        scale = average_path(self.sample_size) or 1.0
        levels = int(math.ceil(math.log2(max(self.sample_size, 2))))

        @F.pandas_udf("double")
        def path(*columns):
            feature, threshold, left, right, depth = trees.value
            x = np.column_stack([c.to_numpy(float) for c in columns])
            rows, total = np.arange(len(x)), np.zeros(len(x))
            for t in range(len(feature)):
                node = np.zeros(len(x), dtype=np.int64)
                for _ in range(levels):
                    below = x[rows, feature[t, node]] <= threshold[t, node]
                    node = np.where(below, left[t, node], right[t, node])
                total += depth[t, node]
            return pd.Series(np.exp2(-total / (len(feature) * scale)))

        # Columns travel as they are; an array of them would come out as one object per row.
        return df.withColumn(name, path(*[zero_if_null(F.col(c).cast("double")) for c in self.columns]))


def literal_forest(columns: list[str], trees: list[list[tuple]], sample_size: int) -> IsolationForest:
    """A forest from lists of (feature, threshold, left, right, depth) per tree."""
    wide = max(map(len, trees))
    filled = [t + [(0, np.inf, i, i, 0.0) for i in range(len(t), wide)] for t in trees]
    parts = [np.array([[node[k] for node in t] for t in filled], kind) for k, kind in enumerate((np.int64, float, np.int64, np.int64, float))]
    return IsolationForest(tuple(columns), *parts, sample_size)


def _tree_samples(df: DataFrame, keys: list[str], trees: int, size: int, seed: int, n: int) -> DataFrame:
    """(tree, columns...) with up to ``size`` rows per tree, chosen by hash of
    the row key: the same rows whatever the partitioning.

    One hash per row draws a pool of about 6 x ``trees`` x ``size`` rows, or all
    rows of a table that has no more; only the pool is then drawn from for each
    tree, about 1.5 x ``size`` rows, so a row may serve many trees at any size."""
    pool = min(1.0, 6.0 * trees * size / max(n, 1))
    share = min(1.0, 1.5 * size / max(n * pool, 1.0))
    limit = 2**53

    def draw(*salt: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys], *salt), 11)

    tree = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: draw(F.lit(seed), t) < F.lit(int(share * limit)),
    )
    drawn = df.where(draw(F.lit(seed), F.lit("pool")) < F.lit(int(pool * limit)))
    picked = drawn.withColumn("tree", F.explode(tree))
    first = Window.partitionBy("tree").orderBy(draw(F.lit(seed), F.col("tree"), F.lit(7)), *keys)
    return picked.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= size)


def fit_isolation_forest(
    df: DataFrame,
    columns: list[str],
    keys: list[str] | None = None,
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
) -> IsolationForest:
    """Grow each tree in its own task from its sample. The model that reaches
    the driver has at most trees x 2 x sample_size nodes."""
    keys = keys or KEYS
    n = df.count()
    inputs = df.select(*keys, *[zero_if_null(F.col(c).cast("double")).alias(c) for c in columns])
    samples = _tree_samples(inputs, keys, trees, sample_size, seed, n).select("tree", *columns, "_place")
    size = min(sample_size, n)
    deepest = int(math.ceil(math.log2(max(size, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        data = pdf.sort_values("_place")[columns].to_numpy(float)
        rng = np.random.default_rng([seed, tree])
        nodes: list[list[float]] = []
        todo = [(data, 0, -1, False)]
        while todo:
            rows, level, parent, is_right = todo.pop()
            here = len(nodes)
            if parent >= 0:
                nodes[parent][4 if is_right else 3] = here
            low, high = rows.min(0), rows.max(0)
            varying = np.flatnonzero(high > low)
            if level >= deepest or len(rows) <= 1 or not len(varying):
                nodes.append([here, 0, np.inf, here, here, level + average_path(len(rows))])
                continue
            f = int(rng.choice(varying))
            cut = rng.uniform(low[f], high[f])
            nodes.append([here, f, cut, -1, -1, 0.0])
            below = rows[:, f] <= cut
            todo.append((rows[~below], level + 1, here, True))
            todo.append((rows[below], level + 1, here, False))
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "depth"])
        out.insert(0, "tree", tree)
        return out.astype({"node": int, "feature": int, "left": int, "right": int})

    grown = samples.groupBy("tree").applyInPandas(
        grow, "tree int, node int, feature int, threshold double, left int, right int, depth double"
    )
    table = grown.toPandas()
    wide = int(table["node"].max()) + 1
    count = int(table["tree"].nunique())
    rank = table["tree"].rank(method="dense").astype(int).to_numpy() - 1

    def grid(name: str, kind: type) -> np.ndarray:
        out = np.zeros((count, wide), dtype=kind)
        out[rank, table["node"]] = table[name]
        return out

    return IsolationForest(
        tuple(columns), grid("feature", np.int64), grid("threshold", float), grid("left", np.int64),
        grid("right", np.int64), grid("depth", float), size,
    )


def flag(
    df: DataFrame,
    columns: list[str] | None = None,
    keys: list[str] | None = None,
    contamination: float = 0.005,
    seed: int = 42,
    trees: int = 100,
) -> DataFrame:
    """Adds ``anomaly_score`` and ``anomaly_flag`` (-1 for the most isolated share
    of rows, else 1). Scores are written once, then the exact cut is taken."""
    columns = columns or RATIOS
    forest = fit_isolation_forest(df, columns, keys, trees=trees, seed=seed)
    scored = stored(forest.score(df), "anomaly-scores")
    normality = scored.select((-F.col("anomaly_score")).alias("normality"))
    cut = quantiles(normality, ["normality"], [contamination]).select("value").scalar()
    return scored.withColumn(
        "anomaly_flag", F.when(-F.col("anomaly_score") < cut, F.lit(-1)).otherwise(F.lit(1))
    )


def report(flagged: DataFrame) -> DataFrame:
    """The flagged rows with the ratios that explain them."""
    return flagged.where("anomaly_flag = -1").select(*REPORT, "anomaly_score")
