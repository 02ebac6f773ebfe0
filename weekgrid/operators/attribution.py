"""Exact Shapley attribution of tree ensembles, weighted along the trees' own paths.

A feature that is left out of a coalition sends a row down both sides of its splits,
by the shares of the background rows that went there. For one leaf this is a product
game: each feature on its path gives 1 or 0 if it is in (its conditions hold or not)
and the product of its shares if it is out. The Shapley value of a product game is
an integral of a polynomial over [0, 1], which Gauss-Legendre points give exactly, so
no subsets are listed. Rows stay in their tasks; trees travel with the code.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from weekgrid.operators.boosting import TreesModel, from_json
from weekgrid.operators.forecast import feature_names, regressor
from weekgrid.session import scratch_path

CELLS = 4_000_000  # rows x nodes looked at together


@dataclass
class Nodes:
    """One tree as arrays, parents before children; a leaf has feature -1. A row goes
    left if its value is at most ``cut`` or, where a node has ``levels``, among them."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    levels: dict[int, np.ndarray]

    def goes_left(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.feature)), bool)
        inner = np.flatnonzero(self.feature >= 0)
        out[:, inner] = x[:, self.feature[inner]] <= self.cut[inner]
        for node, levels in self.levels.items():
            out[:, node] = np.isin(x[:, self.feature[node]], levels)
        return out

    def rows_at(self, x: np.ndarray) -> np.ndarray:
        """How many rows pass each node."""
        left = self.goes_left(x)
        here = np.zeros(left.shape, bool)
        here[:, 0] = True
        for node in np.flatnonzero(self.feature >= 0):
            here[:, self.left[node]] = here[:, node] & left[:, node]
            here[:, self.right[node]] = here[:, node] & ~left[:, node]
        return here.sum(0)


@dataclass
class Ensemble:
    base: float
    trees: list[Nodes]

    @property
    def most_nodes(self) -> int:
        return max((len(t.feature) for t in self.trees), default=1)


@dataclass
class Leaf:
    """A leaf and, per feature on its path, the share of the background that meets its
    conditions and the conditions, as (node, goes left)."""

    value: float
    features: np.ndarray
    shares: np.ndarray
    conditions: list[list[tuple[int, bool]]]


def leaves_of(tree: Nodes, counts: np.ndarray) -> list[Leaf]:
    """The leaves of a tree; below a node that no background row passes both sides
    have one half."""
    found, open_ = [], [(0, {})]
    while open_:
        node, path = open_.pop()
        feature = int(tree.feature[node])
        if feature < 0:
            names = sorted(path)
            shares = np.array([np.prod([s for _, _, s in path[f]]) for f in names])
            found.append(Leaf(float(tree.value[node]), np.array(names, np.int64), shares, [[(n, side) for n, side, _ in path[f]] for f in names]))
            continue
        for child, side in ((tree.left[node], True), (tree.right[node], False)):
            share = counts[child] / counts[node] if counts[node] else 0.5
            open_.append((int(child), {**path, feature: [*path.get(feature, []), (node, side, share)]}))
    return found


_points: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def points(features: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights on [0, 1], exact for polynomials of degree ``features - 1``."""
    if features not in _points:
        at, weight = np.polynomial.legendre.leggauss((features + 1) // 2)
        _points[features] = (at + 1) / 2, weight / 2
    return _points[features]


def product_game(inside: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Shapley values (rows x players) of the game that multiplies ``inside`` of the
    players in a coalition and ``outside`` of the others."""
    at, weight = points(len(outside))
    factor = at[:, None, None] * inside + (1 - at)[:, None, None] * outside
    one = np.ones_like(factor[..., :1])
    before = np.concatenate([one, np.cumprod(factor, 2)[..., :-1]], 2)
    after = np.concatenate([one, np.cumprod(factor[..., ::-1], 2)[..., :-1]], 2)[..., ::-1]
    return (inside - outside) * np.einsum("q,qrf->rf", weight, before * after)


def attribute(tree: Nodes, leaves: list[Leaf], x: np.ndarray, out: np.ndarray, total: np.ndarray) -> None:
    """Adds a tree's attributions to ``out`` (rows x features) and its value to ``total``.
    Rows that meet the same conditions of a leaf get the same, worked out once."""
    left = tree.goes_left(x)
    for leaf in leaves:
        if not len(leaf.features):
            total += leaf.value
            continue
        met = np.column_stack([np.logical_and.reduce([left[:, n] == side for n, side in c]) for c in leaf.conditions])
        _, first, which = np.unique(np.packbits(met, axis=1), axis=0, return_index=True, return_inverse=True)
        out[:, leaf.features] += leaf.value * product_game(met[first].astype(float), leaf.shares)[which.reshape(-1)]
        total += leaf.value * met.all(1)


def ensemble_of(stage, spark: SparkSession) -> Ensemble:
    """The trees of a fitted model stage: this library's boosting, or Spark's boosting
    or forest, read from its saved form. The driver holds trees x nodes numbers."""
    if isinstance(stage, TreesModel):
        trees, base = from_json(stage.getOrDefault(stage.trees))
        arrays = [(np.array(k) for k in (t.feature, t.left, t.right, t.cut, t.value)) for t in trees]
        return Ensemble(base, [Nodes(*a, {}) for a in arrays])
    weights = np.array(stage.treeWeights)
    if isinstance(stage, RandomForestRegressionModel):
        weights = weights / weights.sum()
    path = scratch_path(spark, "trees")
    stage.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees = []
    for i, weight in enumerate(weights):
        own = [r for r in rows if r["treeID"] == i]
        split = [r["split"] for r in own]
        levels = {n: np.array(s["leftCategoriesOrThreshold"]) for n, s in enumerate(split) if s["numCategories"] >= 0}
        cut = [s["leftCategoriesOrThreshold"][0] if s["featureIndex"] >= 0 and n not in levels else 0.0 for n, s in enumerate(split)]
        trees.append(Nodes(
            np.array([s["featureIndex"] for s in split]), np.array([r["leftChild"] for r in own]), np.array([r["rightChild"] for r in own]),
            np.array(cut), weight * np.array([r["prediction"] for r in own]), levels,
        ))
    return Ensemble(0.0, trees)


def blocks(batches, most_nodes: int):
    """(columns before the last, the last one's arrays as a matrix) of parts of the
    batches that keep rows x nodes bounded."""
    size = max(1, CELLS // most_nodes)
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            x = part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            yield part.columns[:-1], x.reshape(part.num_rows, -1)


def background_counts(background: DataFrame, ensemble: Ensemble) -> list[np.ndarray]:
    """Rows of ``background`` (x array<double>) that pass each node of each tree: one
    sum per node and task is shuffled."""

    def run(batches):
        trees = ensemble.trees  # travels with the code, so workers need no copy of this library
        counts = [np.zeros(len(t.feature), np.int64) for t in trees]
        for _, x in blocks(batches, ensemble.most_nodes):
            for tree, count in zip(trees, counts):
                count += tree.rows_at(x)
        flat = np.concatenate([*counts, np.zeros(0, np.int64)])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["at", "n"])

    found = background.select("x").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    sizes = [len(t.feature) for t in ensemble.trees]
    flat = np.zeros(sum(sizes), np.int64)
    flat[found["at"].to_numpy()] = found["n"].to_numpy()
    return np.split(flat, np.cumsum(sizes)[:-1]) if sizes else []


def attributed(rows: DataFrame, background: DataFrame, ensemble: Ensemble, keys: list[str], names: list[str]) -> DataFrame:
    """(keys..., feature, attribution, base_value, score), one row per row of ``rows``
    and name; ``x`` of both tables is an array of as many numbers as ``names``.

    The attributions of a row add up to score - base_value; base_value is the mean score
    of the background, or with an empty one that of both sides of all splits. NaN goes
    right. Repeated rows come out as often as they come in; keys may be null.
    """
    counts = background_counts(background, ensemble)
    leaves = [leaves_of(t, c) for t, c in zip(ensemble.trees, counts)]
    base = ensemble.base + sum(leaf.value * float(np.prod(leaf.shares)) for tree in leaves for leaf in tree)

    def run(batches):
        for named, x in blocks(batches, ensemble.most_nodes):
            out, total = np.zeros(x.shape), np.full(len(x), ensemble.base)
            for tree, own in zip(ensemble.trees, leaves):
                attribute(tree, own, x, out, total)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            yield pa.RecordBatch.from_arrays([*named, pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel())), pa.array(total)], [*keys, "_phi", "score"])

    asked = rows.select(*keys, "x")
    schema = StructType([*asked.schema.fields[:-1], StructField("_phi", ArrayType(DoubleType())), StructField("score", DoubleType())])
    long = asked.mapInArrow(run, schema).select(*keys, "score", F.posexplode("_phi").alias("_at", "attribution"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_at") + 1)
    return long.select(*keys, name.alias("feature"), "attribution", F.lit(base).alias("base_value"), "score")


def tree_attribution(model: PipelineModel, rows: DataFrame, background: DataFrame, keys: list[str]) -> DataFrame:
    """``attributed`` for a fitted forecast of trees. Scores are on the log scale the
    trees are fitted on, where they add up; a category counts as one feature."""
    before = PipelineModel(model.stages[:-2])

    def matrix(df, *columns):
        return before.transform(df).select(*columns, vector_to_array("features").alias("x"))

    ensemble = ensemble_of(regressor(model), rows.sparkSession)
    return attributed(matrix(rows, *keys), matrix(background), ensemble, keys, feature_names(model, rows))
