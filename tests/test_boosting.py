"""Boosting variants against brute-force trees and statistics on small tables."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from weekgrid.operators import boosting, forecast

rng = np.random.default_rng(21)
X = np.column_stack([rng.normal(size=200), rng.integers(0, 6, 200), rng.normal(size=200), np.ones(200)]).astype(float)
Y = np.where(X[:, 0] > 0.3, 4.0, -1.0) + 0.7 * X[:, 1] + np.where((X[:, 2] > 0) & (X[:, 1] > 2), 3.0, 0.0) + 0.05 * rng.normal(size=200)


def matrix(spark, x=X, y=Y):
    rows = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, label double")
    return rows.repartition(3).select(array_to_vector("x").alias("features"), "label")


def best_split(x, r, min_rows, l2):
    """(gain, feature, cut, rows to the left) of the best split of some rows by trying all."""
    best = (0.0, -1, 0.0, None)
    whole = r.sum() ** 2 / (len(r) + l2)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= min_rows:
                gain = r[left].sum() ** 2 / (left.sum() + l2) + r[~left].sum() ** 2 / ((~left).sum() + l2) - whole
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut, left)
    return best


def by_leaf(x, y, rounds, leaves, rate, min_rows, l2):
    score = np.full(len(y), y.mean())
    for _ in range(rounds):
        r = y - score
        parts = [np.arange(len(y))]
        while len(parts) < leaves:
            found = [best_split(x[p], r[p], min_rows, l2) for p in parts]
            k = max(range(len(parts)), key=lambda i: found[i][0])
            if found[k][0] <= 0:
                break
            p, left = parts.pop(k), found[k][3]
            parts += [p[left], p[~left]]
        for p in parts:
            score[p] += rate * r[p].sum() / (len(p) + l2)
    return score


def symmetric(x, y, rounds, depth, rate, min_rows, l2):
    score = np.full(len(y), y.mean())
    for _ in range(rounds):
        r, leaf = y - score, np.zeros(len(y), int)
        for _ in range(depth):
            best = (0.0, None)
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f])[:-1]:
                    goes, gain = x[:, f] > cut, 0.0
                    for k in np.unique(leaf):
                        a, b = (leaf == k) & ~goes, (leaf == k) & goes
                        if min(a.sum(), b.sum()) >= min_rows:
                            both = a | b
                            gain += r[a].sum() ** 2 / (a.sum() + l2) + r[b].sum() ** 2 / (b.sum() + l2) - r[both].sum() ** 2 / (both.sum() + l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, goes)
            if best[1] is None:
                break
            leaf = 2 * leaf + best[1]
        for k in np.unique(leaf):
            score[leaf == k] += rate * r[leaf == k].sum() / ((leaf == k).sum() + l2)
    return score


def predicted(model, rows):
    out = model.transform(rows.select("features", F.col("label").alias("y")))
    return {round(r["y"], 9): r["log_prediction"] for r in out.collect()}


@pytest.mark.parametrize("min_rows, l2, leaves", [(1, 0.0, 31), (5, 1.0, 7), (20, 0.0, 31)])
def test_leafwise_equals_brute_force(spark, min_rows, l2, leaves):
    rows = matrix(spark)
    got = predicted(boosting.fit_trees(rows, "leaf", rounds=3, leaves=leaves, rate=0.3, min_rows=min_rows, l2=l2), rows)
    want = by_leaf(X, Y, 3, leaves, 0.3, min_rows, l2)
    assert [got[round(y, 9)] for y in Y] == pytest.approx(want.tolist(), abs=1e-8)


def test_symmetric_equals_brute_force(spark):
    rows = matrix(spark)
    got = predicted(boosting.fit_trees(rows, "symmetric", rounds=3, depth=3, rate=0.3, min_rows=4, l2=3.0), rows)
    want = symmetric(X, Y, 3, 3, 0.3, 4, 3.0)
    assert [got[round(y, 9)] for y in Y] == pytest.approx(want.tolist(), abs=1e-8)


def test_sums_are_carried_over_trees_and_partitions(spark):
    """Sums that are moved, not counted, stay those of brute force, also where many
    partitions, some of them empty, are merged."""
    rows = matrix(spark)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        leafwise = predicted(boosting.fit_trees(rows, "leaf", rounds=12, leaves=5, rate=0.3, min_rows=4), rows)
        level = predicted(boosting.fit_trees(rows, "symmetric", rounds=12, depth=2, rate=0.3, min_rows=4, l2=3.0), rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert [leafwise[round(y, 9)] for y in Y] == pytest.approx(by_leaf(X, Y, 12, 5, 0.3, 4, 0.0).tolist(), abs=1e-8)
    assert [level[round(y, 9)] for y in Y] == pytest.approx(symmetric(X, Y, 12, 2, 0.3, 4, 3.0).tolist(), abs=1e-8)


@pytest.mark.parametrize("growth", ["leaf", "symmetric"])
def test_known_sums_are_not_counted_again(spark, monkeypatch, growth):
    """Trees that split as the one before cost no pass."""
    x = np.arange(40.0).reshape(-1, 1)
    y = np.where(x[:, 0] < 15, 1.0, 3.0) + 1e-3 * x[:, 0]
    passes, count = [], boosting.Booster.histograms
    monkeypatch.setattr(boosting.Booster, "histograms", lambda self, *a: passes.append(1) or count(self, *a))
    rows = matrix(spark, x, y)
    got = predicted(boosting.fit_trees(rows, growth, rounds=6, leaves=2, depth=1, min_rows=1), rows)
    assert [got[round(v, 9)] for v in y] == pytest.approx(by_leaf(x, y, 6, 2, 0.1, 1, 0.0).tolist(), abs=1e-8)
    assert len(passes) == 2


def test_a_level_costs_one_pass(spark, monkeypatch):
    """All leaves that may be split are counted together, in whatever order they will be."""
    passes, count = [], boosting.Booster.histograms
    monkeypatch.setattr(boosting.Booster, "histograms", lambda self, *a: passes.append(1) or count(self, *a))
    rows = matrix(spark)
    model = boosting.fit_trees(rows, rounds=1, leaves=16, rate=0.3, min_rows=4)
    got = predicted(model, rows)
    assert [got[round(y, 9)] for y in Y] == pytest.approx(by_leaf(X, Y, 1, 16, 0.3, 4, 0.0).tolist(), abs=1e-8)
    (tree,), _ = boosting.from_json(model.getOrDefault(model.trees))
    depth = [0] * len(tree.feature)
    for node, feature in enumerate(tree.feature):
        if feature >= 0:
            depth[tree.left[node]] = depth[tree.right[node]] = depth[node] + 1
    assert len(passes) <= 1 + max(depth)


def test_scores_are_stored_on_the_way(spark, monkeypatch):
    rows = matrix(spark)
    want = predicted(boosting.fit_trees(rows, rounds=5, leaves=4), rows)
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    assert predicted(boosting.fit_trees(rows, rounds=5, leaves=4), rows) == pytest.approx(want)


def test_missing_values_go_right(spark):
    x = np.array([[1.0], [2.0], [np.nan], [np.nan]])
    y = np.array([0.0, 0.1, 5.0, 5.1])
    rows = matrix(spark, x, y)
    got = predicted(boosting.fit_trees(rows, rounds=1, leaves=2, rate=1.0, min_rows=1), rows)
    assert got == pytest.approx({0.0: 0.05, 0.1: 0.05, 5.0: 5.05, 5.1: 5.05})


def test_few_rows(spark):
    for n in (0, 1):
        rows = matrix(spark, X[:n], Y[:n])
        assert list(predicted(boosting.fit_trees(rows, rounds=2), rows).values()) == pytest.approx(Y[:n].tolist())
    with pytest.raises(ValueError):
        boosting.fit_trees(matrix(spark), "sideways")


def test_ordered_statistics(spark):
    kinds = ["a"] * 120 + ["b"] * 30 + [None] * 20 + ["once"]
    rows = [(i, k, f"g{i % 3}", None if i % 11 == 0 else float(i % 7)) for i, k in enumerate(kinds)]
    df = spark.createDataFrame(rows, "id int, kind string, other string, y double").repartition(5)
    got = boosting.ordered_statistics(df, ["kind", "other"], "y", ["id"], prior=2.0, weight=3.0).collect()
    order = sorted(rows, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())
    for name, at in (("kind", 1), ("other", 2)):
        want = {}
        for k, row in enumerate(order):
            seen = [r[3] for r in order[:k] if r[at] == row[at] and r[3] is not None]
            want[row[0]] = (sum(seen) + 2.0 * 3.0) / (len(seen) + 3.0)
        assert {r["id"]: r[f"{name}_stat"] for r in got} == pytest.approx(want)
    final = boosting.final_statistics(df, ["kind"], "y", 2.0, 3.0)
    unseen = spark.createDataFrame([("b",), ("new",), (None,)], "kind string")
    b = [r[3] for r in rows if r[1] == "b" and r[3] is not None]
    none = [r[3] for r in rows if r[1] is None and r[3] is not None]
    assert [r["kind_stat"] for r in final.transform(unseen).collect()] == pytest.approx([(sum(b) + 6) / (len(b) + 3), 2.0, (sum(none) + 6) / (len(none) + 3)])


def test_a_hot_category_is_cut_over_ranges(spark):
    """A category that all rows have is spread over more than one range."""
    df = spark.range(5000).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("kind"), (F.col("id") % 5).cast("double").alias("y"))
    got = boosting.ordered_statistics(df, ["kind"], "y", ["id"], prior=0.0, weight=1.0).collect()
    order = sorted(range(5000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    ahead = np.concatenate([[0], np.cumsum([i % 5 for i in order])[:-1]])
    assert {r["id"]: r["kind_stat"] for r in got} == pytest.approx({i: a / (k + 1) for k, (i, a) in enumerate(zip(order, ahead))})


@pytest.mark.parametrize("kind", ["leafwise", "ordered"])
def test_variants_learn_and_survive_saving(spark, tmp_path, kind):
    n = 240
    pdf = pd.DataFrame({
        "store": 1 + np.arange(n) % 4, "dept": 1 + np.arange(n) % 3, "date": pd.date_range("2010-01-01", periods=n, freq="7D").date,
        "x": rng.normal(size=n), "kind": rng.choice(["a", "b", "c"], n),
    })
    pdf["weekly_sales"] = np.expm1(6 + 0.8 * pdf["x"] + pdf["kind"].map({"a": 0.0, "b": 0.6, "c": -0.4}))
    df = spark.createDataFrame(pdf)
    model = forecast.fit(df, kind, {"rounds": 25, "rate": 0.3, "min_rows": 3}, ["x"], ["kind"])
    found = forecast.predict(model, df)
    assert found.agg(F.avg(F.abs(F.col("prediction") / F.col("weekly_sales") - 1))).first()[0] < 0.25
    path = str(tmp_path / "m")
    forecast.save(model, path)
    again = {r["date"]: r["prediction"] for r in forecast.predict(forecast.load(path), df).collect()}
    assert again == pytest.approx({r["date"]: r["prediction"] for r in found.collect()})
