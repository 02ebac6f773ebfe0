"""Tree attribution against the enumeration of all coalitions."""

import itertools
import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from weekgrid.operators import attribution, boosting, forecast
from weekgrid.plans import models

rng = np.random.default_rng(8)
D = 8
X = np.column_stack([rng.integers(0, 4, 400), *[rng.normal(size=400) for _ in range(D - 1)]]).astype(float)
Y = np.where(X[:, 0] == 2, 3.0, 0.0) + X[:, 1] * (X[:, 2] > 0) + np.where(X[:, 3] + X[:, 4] > 0.5, X[:, 5], -X[:, 6]) + 0.1 * X[:, 7]
NAMES = [f"c{i}" for i in range(D)]


def expected(tree, counts, x, known, node=0):
    """Value of a row whose features ``known`` are given, the other splits averaged."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        goes = x[f] in tree.levels[node] if node in tree.levels else x[f] <= tree.cut[node]
        return expected(tree, counts, x, known, left if goes else right)
    share = counts[left] / counts[node] if counts[node] else 0.5
    return share * expected(tree, counts, x, known, left) + (1 - share) * expected(tree, counts, x, known, right)


def brute(ensemble, background, x):
    phi = np.zeros(D)
    for tree in ensemble.trees:
        counts = tree.rows_at(background)
        worth = {s: expected(tree, counts, x, set(s)) for n in range(D + 1) for s in itertools.combinations(range(D), n)}
        for s in worth:
            for f in set(range(D)) - set(s):
                weight = math.factorial(len(s)) * math.factorial(D - len(s) - 1) / math.factorial(D)
                phi[f] += weight * (worth[tuple(sorted({*s, f}))] - worth[s])
    return phi


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, r.tolist(), float(y)) for i, (r, y) in enumerate(zip(X, Y))]
    raw = spark.createDataFrame(rows, "id long, x array<double>, label double").repartition(3)
    raw = raw.select("*", array_to_vector("x").alias("raw"))
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(raw).transform(raw)


def held_against_brute(spark, df, model, column):
    ensemble = attribution.ensemble_of(model, spark)
    rows = model.transform(df).select("id", vector_to_array("features").alias("x"), F.col(column).alias("predicted"))
    got = attribution.attributed(rows, rows, ensemble, ["id"], NAMES).toPandas()
    assert len(got) == D * len(X)
    wide = got.pivot(index="id", columns="feature", values="attribution")[NAMES].to_numpy()
    known = rows.orderBy("id").toPandas()
    x = np.stack(known["x"])
    score = got.groupby("id")["score"].first().to_numpy()
    assert np.allclose(score, known["predicted"], atol=1e-9)
    assert np.allclose(got["base_value"], score.mean(), atol=1e-9)
    assert np.allclose(wide.sum(1), score - score.mean(), atol=1e-9)
    for i in range(0, len(X), 80):
        assert np.allclose(wide[i], brute(ensemble, x, x[i]), atol=1e-9)
    return ensemble


def test_leafwise_equals_all_coalitions(spark, table):
    model = boosting.fit_trees(table.select("features", "label"), rounds=3, leaves=12, min_rows=5)
    held_against_brute(spark, table, model, "log_prediction")


def test_spark_models_with_categories_equal_all_coalitions(spark, table):
    forest = RandomForestRegressor(numTrees=3, maxDepth=5, seed=1).fit(table)
    ensemble = held_against_brute(spark, table, forest, "prediction")
    assert any(t.levels for t in ensemble.trees), "a categorical split is wanted"
    held_against_brute(spark, table, GBTRegressor(maxIter=3, maxDepth=4, seed=1).fit(table), "prediction")


def test_long_paths_stay_exact():
    """A product game of 40 players: additive, and equal players get equal parts."""
    inside, outside = np.ones((1, 40)), np.r_[np.full(20, 0.9), np.full(20, 0.5)]
    phi = attribution.product_game(inside, outside)[0]
    assert math.isclose(phi.sum(), 1 - outside.prod(), rel_tol=1e-12)
    assert np.ptp(phi[:20]) < 1e-14 and np.ptp(phi[20:]) < 1e-14 and phi[20] > phi[0]


def test_odd_tables(spark):
    """A tree without splits, empty tables, NaN, null and repeated keys."""
    leaf = boosting.TreesModel(trees=boosting.as_json([boosting.Tree(value=[2.0])], 1.0))
    stump = boosting.Tree(feature=[0, -1, -1], bin=[0] * 3, cut=[0.0] * 3, left=[1, 0, 0], right=[2, 0, 0], value=[0.0, 1.0, 3.0])
    stump = boosting.TreesModel(trees=boosting.as_json([stump], 0.0))
    rows = spark.createDataFrame([(1, [-1.0]), (1, [-1.0]), (None, [float("nan")])], "id long, x array<double>")
    run = lambda m, a, b: sorted(map(tuple, attribution.attributed(a, b, attribution.ensemble_of(m, spark), ["id"], ["c"]).collect()), key=str)
    assert run(leaf, rows, rows) == [(1, "c", 0.0, 3.0, 3.0)] * 2 + [(None, "c", 0.0, 3.0, 3.0)]
    assert run(stump, rows, rows.limit(0)) == [(1, "c", -1.0, 2.0, 1.0)] * 2 + [(None, "c", 1.0, 2.0, 3.0)]
    assert run(stump, rows.limit(0), rows) == []


def test_forecast_rows_add_up(spark, small_panel, monkeypatch):
    """Through the feature stages of every tree model, one row per row and column."""
    monkeypatch.setattr(models, "PARAMS", {"boosting": {"maxIter": 2}, "leafwise": {"rounds": 2}, "ordered": {"rounds": 2}, "random_forest": {"numTrees": 2, "maxDepth": 4}})
    train, _, test = models.parts(spark, "/root/testdata/sf0.001")
    for name in models.PARAMS:
        model = forecast.fit(train, name, models.PARAMS[name])
        found = attribution.tree_attribution(model, test, train, models.KEYS)
        sums = found.groupBy(*models.KEYS).agg(F.sum("attribution").alias("a"), F.first("base_value").alias("b"), F.first("score").alias("s"))
        both = sums.join(model.transform(test).select(*models.KEYS, "log_prediction"), models.KEYS)
        off = both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("a") + F.col("b") - F.col("s"))).alias("d"), F.max(F.abs(F.col("s") - F.col("log_prediction"))).alias("p")).first()
        assert off["n"] == test.count() > 0 and off["d"] < 1e-9 and off["p"] < 1e-9, name


def test_workers_need_no_copy_of_the_library(tmp_path):
    """What the tasks run and hold is read where the package is not installed."""
    tree = attribution.Nodes(*(np.array(v) for v in ([-1], [0], [0], [0.0], [1.0])), {})
    sent = cloudpickle.dumps((attribution.attribute, attribution.blocks, attribution.Ensemble(0.0, [tree])))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    read = "import pickle, sys; pickle.load(sys.stdin.buffer)"
    subprocess.run([sys.executable, "-c", read], input=sent, cwd=tmp_path, env=env, check=True)
