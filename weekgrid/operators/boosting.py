"""Gradient boosting on histograms: leaf-wise and symmetric trees, ordered target statistics.

Rows stay in tasks as blocks of small bin numbers. A pass over them adds up, per task,
the gradients of the wanted leaves by feature and bin; Spark merges the sums, and the
driver, which only ever sees leaves x features x bins numbers, picks the splits. Sums
that follow from those of the tree before are not counted again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from weekgrid.session import stored

BINS, ACCURACY = 255, 10_000
STORE_EVERY = 8  # trees between two tables of scores
TASK_ROWS = 20_000  # at least, as a pass over fewer is mostly the start of its tasks


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1. Rows with value <= cut go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, cut: float) -> tuple[int, int]:
        for _ in range(2):
            for values, empty in ((self.feature, -1), (self.bin, 0), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                values.append(empty)
        left = len(self.feature) - 2
        self.feature[node], self.bin[node], self.cut[node] = feature, bin_, cut
        self.left[node], self.right[node] = left, left + 1
        return left, left + 1

    def leaf_of(self, x: np.ndarray, edges: list) -> np.ndarray:
        """Leaf of every row, comparing values with ``edges`` (bins or cuts)."""
        feature, edge = np.array(self.feature), np.array(edges)
        left, right = np.array(self.left), np.array(self.right)
        node = np.zeros(len(x), np.int64)
        open_ = np.flatnonzero(feature[node] >= 0)
        while len(open_):
            at = node[open_]
            goes = x[open_, feature[at]] <= edge[at]
            node[open_] = np.where(goes, left[at], right[at])
            open_ = open_[feature[node[open_]] >= 0]
        return node

    def predict(self, x: np.ndarray, edges: list) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(x, edges)]

    def rows_by_leaf(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """Rows of each leaf, of a block of bin numbers (features x rows). Parents come
        before children in the lists."""
        held = {0: np.arange(codes.shape[1])}
        for node, feature in enumerate(self.feature):
            if feature >= 0:
                rows = held.pop(node)
                goes = codes[feature, rows] <= self.bin[node]
                held[self.left[node]], held[self.right[node]] = rows[goes], rows[~goes]
        return held


def as_json(trees: list[Tree], base: float) -> str:
    return json.dumps({"base": base, "trees": [vars(t) for t in trees]})


def from_json(text: str) -> tuple[list[Tree], float]:
    held = json.loads(text)
    return [Tree(**t) for t in held["trees"]], held["base"]


class TreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``log_prediction`` to rows with a ``features`` vector."""

    trees = Param(Params._dummy(), "trees", "fitted trees as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: str | None = None):
        super().__init__()
        if trees is not None:
            self._set(trees=trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, base = from_json(self.getOrDefault(self.trees))

        @F.pandas_udf("double")
        def scored(values):
            import pandas as pd

            x = np.stack(values.to_numpy()) if len(values) else np.zeros((0, 0))
            return pd.Series(base + sum((t.predict(x, t.cut) for t in trees), np.zeros(len(x))))

        return dataset.withColumn("log_prediction", scored(vector_to_array("features")))


class StatisticsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Puts a number in place of each category: its target statistic over all training
    rows; a category that training did not have gets the prior."""

    statistics = Param(Params._dummy(), "statistics", "per column its prior and levels as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, statistics: str | None = None):
        super().__init__()
        if statistics is not None:
            self._set(statistics=statistics)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = json.loads(self.getOrDefault(self.statistics))
        return dataset.withColumns({
            f"{c}_stat": F.coalesce(
                F.try_element_at(F.from_json(F.lit(json.dumps(s["levels"])), "map<string,double>"), F.coalesce(F.col(c).cast("string"), F.lit(""))),
                F.lit(s["prior"]),
            )
            for c, s in held.items()
        })


def statistic(total: Column, count: Column, prior: Column, weight: float) -> Column:
    return (total.cast("double") + prior * weight) / (count + weight)


def ordered_statistics(
    df: DataFrame, columns: list[str], target: str, keys: list[str], prior: float, weight: float = 1.0
) -> DataFrame:
    """``df`` with ``<column>_stat``: the mean target of the rows of the same category
    that come before, drawn towards ``prior`` by ``weight`` rows.

    "Before" is in the order of md5 of the keys' text, an order that has nothing to
    do with the target, so a row's own target never enters its statistic. ``keys``
    name a row. A null category is one of its own, a null target adds nothing.

    All columns' categories are sorted into value ranges together. A category that a
    third of the rows have is cut over many ranges: a window runs inside a range only,
    and what the ranges before it hold of the category is added.
    """
    order = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("category")) for i, c in enumerate(columns)])
    long = df.select(*keys, order.alias("place"), F.col(target).alias("y"), F.inline(cells))
    by = ["at", "category"]
    ranged = stored(long.repartitionByRange(*by, "place", *keys).withColumn("bucket", F.spark_partition_id()), "category-ranges")
    sums = ranged.groupBy(*by, "bucket").agg(F.sum("y").alias("y"), F.count("y").alias("n"))
    # One row per category and range that holds it: at most ranges plus categories.
    across = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select(
        F.col("at").alias("of"), F.col("category").alias("which"), F.col("bucket").alias("in"),
        F.sum("y").over(across).alias("y_ahead"), F.sum("n").over(across).alias("n_ahead"),
    )
    same = (F.col("at") == F.col("of")) & F.col("category").eqNullSafe(F.col("which")) & (F.col("bucket") == F.col("in"))
    inside = Window.partitionBy(*by, "bucket").orderBy("place", *keys).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    placed = ranged.join(ahead, same).select(
        *keys, "at", statistic(zero(F.sum("y").over(inside)) + zero(F.col("y_ahead")), zero(F.count("y").over(inside)) + zero(F.col("n_ahead")), F.lit(prior), weight).alias("s")
    )
    wide = placed.groupBy(*keys).agg(*[F.max(F.when(F.col("at") == i, F.col("s"))).alias(f"{c}_stat") for i, c in enumerate(columns)])
    return df.join(wide, keys)


def final_statistics(df: DataFrame, columns: list[str], target: str, prior: float, weight: float = 1.0) -> StatisticsModel:
    """The statistics of all rows, for rows that were not trained on; the model holds
    one number per level of each column, as a string index does."""
    held = {c: {"prior": prior, "levels": {}} for c in columns}
    for c in columns:
        level = F.coalesce(F.col(c).cast("string"), F.lit(""))
        found = df.groupBy(level.alias("level")).agg(statistic(F.sum(target), F.count(target), F.lit(prior), weight).alias("s"))
        held[c]["levels"] = {r["level"]: r["s"] for r in found.collect()}
    return StatisticsModel(statistics=json.dumps(held))


def bin_edges(df: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature, from mergeable sketches of all rows."""
    probs = [i / bins for i in range(1, bins)]
    value = F.when(~F.isnan("v"), F.col("v"))
    found = df.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.percentile_approx(value, probs, ACCURACY).alias("edges"), F.max(value).alias("top"), F.count_if(F.isnan("v")).alias("missing")
    )
    edges = [np.zeros(0)] * features
    for r in found.collect():
        # The largest value needs an edge only where NaN is to its right.
        own = {e for e in r["edges"] or [] if e < r["top"]} | ({r["top"]} if r["missing"] and r["top"] is not None else set())
        edges[r["at"]] = np.array(sorted(own))
    return edges


def as_block(codes: np.ndarray, y: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    parts = [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (codes, y, score)]
    return pa.RecordBatch.from_arrays(parts, ["x", "y", "score"])


def scored(trees: list[Tree], codes: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The scores of a block after some more trees."""
    score = score.copy()
    for tree in trees:
        for leaf, rows in tree.rows_by_leaf(codes).items():
            score[rows] += tree.value[leaf]
    return score


@dataclass
class Leaf:
    total: np.ndarray  # gradient sum, rows
    cells: np.ndarray  # features x bins x 2
    gain: float = 0.0
    feature: int = -1
    bin: int = 0
    node: int = 0
    split: tuple[int, int] | None = None  # feature and bin that the children are of
    children: list[Leaf] = field(default_factory=list)
    value: float | None = None  # of a leaf of the finished tree


BLOCK = "x binary, y binary, score binary"  # one row per block: bins (features x rows), labels, scores


class Booster:
    """One fit: the binned blocks, the trees so far and their scores.

    ``growth`` is ``leaf`` (the leaf with the highest gain is split next, up to
    ``leaves``) or ``symmetric`` (all leaves of a level get the one split with the
    highest summed gain, up to ``depth`` levels). The loss is squared error: a tree
    moves all gradients of a leaf by the leaf's value, so the sums of its leaves, and
    of all that is made of them, are known for the next tree without a pass.
    """

    def __init__(self, rows: DataFrame, growth: str, rounds: int, leaves: int, depth: int, rate: float, bins: int, min_rows: int, l2: float):
        self.growth, self.rounds, self.leaves, self.depth = growth, rounds, leaves, depth
        self.rate, self.min_rows, self.l2 = rate, min_rows, l2
        arrays = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"))
        facts = arrays.agg(F.max(F.size("x")).alias("d"), F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n")).first()
        self.d, self.base, self.tasks = facts["d"] or 0, facts["mean"] or 0.0, -(-facts["n"] // TASK_ROWS) or 1
        self.edges = bin_edges(arrays, self.d, bins)
        self.bins = max((len(e) for e in self.edges), default=0) + 1
        kind = np.uint8 if self.bins <= 256 else np.uint16
        edges, d, base = self.edges, self.d, self.base

        def binned(batches):
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(0).flatten().to_numpy().reshape(-1, d)
                    codes = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]).astype(kind)
                    yield as_block(codes, batch.column(1).to_numpy(), np.full(len(x), base))

        self.kind = kind
        self.trees: list[Tree] = []
        self.before = None
        self.keep(arrays.mapInArrow(binned, BLOCK) if d else arrays.sparkSession.createDataFrame([], BLOCK))

    def keep(self, blocks: DataFrame) -> None:
        """Writes the blocks, with the scores of the trees so far, for the next passes."""
        kind, d = self.kind, self.d
        self.rows, self.done, self.written = stored(blocks.coalesce(self.tasks), "binned"), len(self.trees), len(self.trees)

        def read(row):
            return np.frombuffer(bytes(row[0]), kind).reshape(d, -1), np.frombuffer(bytes(row[1])), np.frombuffer(bytes(row[2]))

        self.blocks = self.rows.rdd.coalesce(self.tasks).map(read).persist(StorageLevel.MEMORY_AND_DISK)

    def store_scores(self) -> None:
        late, before = self.trees[self.done :], self.blocks

        def run(block):
            codes, y, score = block
            return codes.tobytes(), y.tobytes(), scored(late, codes, score).tobytes()

        self.keep(self.rows.sparkSession.createDataFrame(before.map(run), BLOCK, verifySchema=False))
        before.unpersist()

    def advance(self) -> None:
        """Adds the trees since the last call to the persisted scores, in the next pass;
        the blocks before are let go when that is done."""
        late = self.trees[self.done :]

        def run(block):
            codes, y, score = block
            return codes, y, scored(late, codes, score)

        self.before, self.blocks = self.blocks, self.blocks.map(run).persist(StorageLevel.MEMORY_AND_DISK)
        self.done = len(self.trees)

    def histograms(self, tree: Tree, wanted: list[int]) -> dict[int, np.ndarray]:
        """Sums of gradients and rows by feature and bin, for the wanted nodes of ``tree``."""
        if self.done < len(self.trees):
            self.advance()
        d, bins = self.d, self.bins

        def add(cells, block):
            codes, y, score = block
            cells = np.zeros((2, d, len(wanted), bins)) if cells is None else cells
            rows = tree.rows_by_leaf(codes)
            here = np.concatenate([rows[node] for node in wanted])
            first = np.repeat(np.arange(len(wanted)) * bins, [len(rows[node]) for node in wanted])
            gradient = score[here] - y[here]
            for f in range(d):
                at = first + codes[f, here]
                cells[0, f] += np.bincount(at, gradient, cells[0, f].size).reshape(-1, bins)
                cells[1, f] += np.bincount(at, minlength=cells[1, f].size).reshape(-1, bins)
            return cells

        def merge(a, b):
            return b if a is None else a if b is None else a + b

        cells = self.blocks.treeAggregate(None, add, merge)
        if self.before is not None:
            self.before.unpersist()
            self.before = None
        cells = np.zeros((2, d, len(wanted), bins)) if cells is None else cells
        return dict(zip(wanted, np.ascontiguousarray(cells.transpose(2, 1, 3, 0))))

    def worth(self, g, n):
        return g * g / np.maximum(n + self.l2, 1e-12)

    def gains(self, cells: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Gain of every (feature, bin): rows up to the bin go left; -inf where a side has too few."""
        left = cells.cumsum(1)[:, :-1]
        right = total - left
        gain = self.worth(left[..., 0], left[..., 1]) + self.worth(right[..., 0], right[..., 1]) - self.worth(*total)
        fits = (left[..., 1] >= self.min_rows) & (right[..., 1] >= self.min_rows)
        return np.where(fits, gain, -np.inf)

    def leaf(self, cells: np.ndarray) -> Leaf:
        found = Leaf(cells[0].sum(0), cells)
        gain = self.gains(cells, found.total)
        if gain.size:
            best = int(gain.argmax())  # of equal ones the first feature, then the lowest bin
            found.feature, found.bin = divmod(best, gain.shape[1])
            found.gain = float(gain.flat[best])
        return found

    def halves(self, tree: Tree, parents: list[Leaf]) -> None:
        """Children (left, right) of split leaves in one pass: the smaller one is counted,
        the other is what is left of the parent."""
        smaller = []
        for parent in parents:
            left, right = tree.left[parent.node], tree.right[parent.node]
            n_left = parent.cells[tree.feature[parent.node], : tree.bin[parent.node] + 1, 1].sum()
            smaller.append(left if 2 * n_left <= parent.total[1] else right)
        counted = self.histograms(tree, smaller)
        for parent, node in zip(parents, smaller):
            one, other = self.leaf(counted[node]), self.leaf(parent.cells - counted[node])
            parent.split = (tree.feature[parent.node], tree.bin[parent.node])
            parent.children = [one, other] if node == tree.left[parent.node] else [other, one]
            self.place(tree, parent)

    def place(self, tree: Tree, parent: Leaf) -> None:
        """Gives the children the nodes of the split."""
        parent.children[0].node, parent.children[1].node = tree.left[parent.node], tree.right[parent.node]

    def cut(self, tree: Tree, node: int, feature: int, bin_: int) -> None:
        tree.split(node, feature, bin_, float(self.edges[feature][bin_]))

    def moved(self, old: Leaf, value: float | None = None) -> Leaf:
        """A node of the finished tree, or the children of its leaves if counted, with the
        sums after that tree's step."""
        below = value is not None
        value = value if below else old.value
        new_children = [] if below else [self.moved(child, value) for child in old.children]
        if value is None:
            cells = new_children[0].cells + new_children[1].cells
        else:
            cells = old.cells.copy()
            cells[..., 0] += value * cells[..., 1]
        new = self.leaf(cells)
        new.split, new.children = old.split, new_children
        return new

    def grow_by_leaf(self, root: Leaf) -> Tree:
        """Best-first growth. A pass counts the children of all leaves that may still be
        split, before it is known which will be: a leaf's gain does not depend on the
        other leaves, so the tree is that of splitting one at a time. Children not yet
        known can only take the place of others, so no leaf that will be split is left out."""
        draft = Tree()

        def drawn(x: Leaf) -> None:
            if x.split != (x.feature, x.bin):
                x.children = []
            if x.children:
                self.cut(draft, x.node, x.feature, x.bin)
                self.place(draft, x)
                for child in x.children:
                    drawn(child)

        drawn(root)  # what the tree before has left known
        while True:
            # Replay the best-first order; a leaf whose children are not known counts as split.
            tree, open_, ahead = Tree(), [(root, 0)], []
            for _ in range(self.leaves - 1):
                at = max(range(len(open_)), key=lambda i: (open_[i][0].gain, -open_[i][1]), default=None)
                if at is None or open_[at][0].gain <= 0:
                    break
                best, node = open_.pop(at)
                if best.children:
                    self.cut(tree, node, best.feature, best.bin)
                    open_ += zip(best.children, (tree.left[node], tree.right[node]))
                else:
                    ahead.append(best)
            if not ahead:
                break
            for x in ahead:
                self.cut(draft, x.node, x.feature, x.bin)
            self.halves(draft, ahead)
        for x, node in open_:
            x.value = tree.value[node] = self.step(x.total)
        return tree

    def grow_symmetric(self, root: Leaf) -> Tree:
        tree, level = Tree(), [root]
        for _ in range(self.depth):
            total = np.zeros((self.d, self.bins - 1))
            for x in level:
                gain = self.gains(x.cells, x.total)
                total += np.where(np.isfinite(gain), gain, 0.0)  # a side with too few rows gains nothing
            if not total.size or total.max() <= 0:
                break
            feature, bin_ = divmod(int(total.argmax()), total.shape[1])
            known = all(x.children and x.split == (feature, bin_) for x in level)
            for x in level:
                self.cut(tree, x.node, feature, bin_)
                if known:
                    self.place(tree, x)
            if not known:
                self.halves(tree, level)
            level = [child for x in level for child in x.children]
        for x in level:
            x.children = []
            x.value = tree.value[x.node] = self.step(x.total)
        return tree

    def step(self, total: np.ndarray) -> float:
        return float(-self.rate * total[0] / (total[1] + self.l2)) if total[1] else 0.0

    def fit(self) -> TreesModel:
        rounds = self.rounds if self.d else 0
        root = self.leaf(self.histograms(Tree(), [0])[0]) if rounds else None
        for _ in range(rounds):
            if len(self.trees) - self.written >= STORE_EVERY:
                self.store_scores()
            self.trees.append(self.grow_by_leaf(root) if self.growth == "leaf" else self.grow_symmetric(root))
            root = self.moved(root)
        self.blocks.unpersist()
        return TreesModel(trees=as_json(self.trees, self.base))


def fit_trees(
    rows: DataFrame, growth: str = "leaf", rounds: int = 100, leaves: int = 31, depth: int = 6, rate: float = 0.1,
    bins: int = BINS, min_rows: int = 20, l2: float = 0.0,
) -> TreesModel:
    """A boosted model of rows (features: vector, label). NaN goes right at every split.
    The driver holds the trees and, per pass, leaves x features x bins sums."""
    if growth not in ("leaf", "symmetric"):
        raise ValueError(f"unknown growth {growth!r}, expected leaf or symmetric")
    return Booster(rows, growth, rounds, leaves, depth, rate, bins, min_rows, l2).fit()
