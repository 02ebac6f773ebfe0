import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weekgrid.operators import anomaly, explain, forecast, kpi, segments
from weekgrid.plans import models


def toy(spark, n=240):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(
        {
            "store": 1 + np.arange(n) % 4,
            "dept": 1 + np.arange(n) % 3,
            "date": pd.date_range("2010-01-01", periods=n, freq="7D").date,
            "x": rng.normal(size=n),
            "noise": rng.normal(size=n),
            "kind": rng.choice(["a", "b", "c"], n),
        }
    )
    step = pdf["kind"].map({"a": 0.0, "b": 0.6, "c": -0.4})
    pdf["weekly_sales"] = np.expm1(6 + 0.8 * pdf["x"] + step)
    pdf["isholiday"] = (np.arange(n) % 13 == 0).astype(int)
    pdf.loc[::17, "x"] = np.nan
    return spark.createDataFrame(pdf).replace(float("nan"), None)


NUM, CAT = ["x", "noise"], ["kind"]


@pytest.mark.parametrize(
    "kind, params", [("linear", {"alpha": 0.01}), ("random_forest", {"numTrees": 10, "maxDepth": 6}), ("boosting", {"maxIter": 20, "maxDepth": 4})]
)
def test_models_learn_and_survive_saving(spark, tmp_path, kind, params):
    df = toy(spark)
    known = df.where("x IS NOT NULL")
    model = forecast.fit(known, kind, params, NUM, CAT)
    found = forecast.predict(model, known)
    error = found.agg(F.avg(F.abs(F.col("prediction") / F.col("weekly_sales") - 1))).first()[0]
    assert error < 0.25
    path = str(tmp_path / "m")
    forecast.save(model, path)
    again = {r["date"]: r["prediction"] for r in forecast.predict(forecast.load(path), known).collect()}
    assert again == pytest.approx({r["date"]: r["prediction"] for r in found.collect()})


def test_linear_model_equals_ridge_in_closed_form(spark):
    df = toy(spark).where("x IS NOT NULL")
    alpha = 3.0
    model = forecast.fit(df, "linear", {"alpha": alpha, "solver": "normal"}, NUM, CAT)
    pdf = df.toPandas()
    cols = []
    for c in NUM:
        q1, q2, q3 = pdf[c].quantile([0.25, 0.5, 0.75])
        cols.append((pdf[c] - q2) / (q3 - q1))
    cols += [(pdf["kind"] == k).astype(float) for k in ("b", "c")]
    x, y = np.column_stack(cols), np.log1p(pdf["weekly_sales"])
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
    want = np.expm1(xc @ beta + y.mean())
    got = forecast.predict(model, df).toPandas()
    # quartiles of the fitted scaler are approximate, hence the tolerance
    assert np.allclose(got["prediction"], want[got.index], rtol=2e-2)


def test_unknown_level_scores_like_the_first_one(spark):
    df = toy(spark).where("x IS NOT NULL")
    model = forecast.fit(df, "linear", {"alpha": 0.01}, NUM, CAT)
    row = df.where("kind = 'a'").limit(1)
    plain = forecast.predict(model, row).first()["prediction"]
    strange = forecast.predict(model, row.withColumn("kind", F.lit("zz"))).first()["prediction"]
    assert strange == pytest.approx(plain)


def test_unknown_model_type(spark):
    with pytest.raises(ValueError, match="unknown model type"):
        forecast.fit(toy(spark), "oracle", {}, NUM, CAT)


def test_measured_figures_of_a_model(spark):
    df = toy(spark)
    model = forecast.fit(df.where("x IS NOT NULL"), "linear", {"alpha": 0.01}, NUM, CAT)
    latency, size = forecast.measured(model, df, repeats=2)
    assert latency > 0 and 0 < size < 1
    assert forecast.measured(model, df.limit(0)) == (None, size)


def test_search_halves_its_draws_on_one_matrix(spark, monkeypatch):
    df = toy(spark).where("x IS NOT NULL")
    fitted, fits = [], []
    plain, prepared = forecast.SharedMatrix.fit, forecast.fit_features
    monkeypatch.setattr(forecast.SharedMatrix, "fit", lambda self, drawn, n: fits.append((drawn[0], n)) or plain(self, drawn, n))
    monkeypatch.setattr(forecast, "fit_features", lambda *a, **k: fitted.append(1) or prepared(*a, **k))
    # Whole samples, as drawn ones depend on how a stored matrix is cut into files.
    space = {"trees": (4, 9), "depth": (2, 3), "subsample": (1.0, 1.0), "feature_share": (1.0, 1.0)}
    runs = forecast.search(df, df, draws=4, seed=1, space=space, numeric=NUM, categorical=CAT).toPandas()
    assert len(fitted) == 1 and len(runs) == 4
    assert [share for share, _ in forecast.rungs(4, 3)] == pytest.approx([1 / 9, 1 / 3, 1]) and [n for _, n in forecast.rungs(4, 3)] == [4, 2, 1]
    assert len(fits) == 4 + 2 + 1 and sum(n == trees for trees, n in fits) >= 1
    assert (runs["trees_fitted"] == runs["n_estimators"]).sum() >= 1 and runs["wmape_val"].notna().all()
    best = runs.loc[runs["wmape_val"].idxmin()]
    drawn = forecast.draw_params(4, 1, forecast.SPACE | space)[int(best["run_id"][-3:])]
    alone = forecast.fit(df, "boosting", forecast.boosting_params(int(best["trees_fitted"]), *drawn[1:]), NUM, CAT)
    assert forecast.forecast_metrics(forecast.predict(alone, df)).first()["wmape"] == pytest.approx(best["wmape_val"])


def test_no_champion_without_a_run_below_the_limit(spark):
    runs = spark.createDataFrame(
        [("run_000", 50.0, 20.0, 1.0, 5, 0.1, 3, 1.0, 1.0)],
        "run_id string, wmape_val double, latency_ms double, model_size_mb double, n_estimators int,"
        " learning_rate double, max_depth int, subsample double, colsample double",
    )
    df = toy(spark)
    model, gates = forecast.champion(runs, df, df, df)
    assert model is None and gates.count() == 0
    assert {"wmape", "r2", "run_id", "latency_ms", "pass_latency", "promoted"} <= set(gates.columns)


def test_registered_search_and_champion_use_the_whole_space(spark, monkeypatch):
    """Draws, the last fit and the refit have the numbers of trees of the default space."""
    df, fits, refits = toy(spark, 12), [], []

    class Matrix:
        def __init__(self, *_):
            pass

        def fit(self, drawn, rounds):
            fits.append((drawn, rounds))
            return drawn

        def metrics(self, drawn):
            return {"wmape": 1.0 / drawn[0], "mae": 1.0, "rmse": 1.0, "r2": 0.0}

        def whole(self, drawn):
            return drawn

    def refit(train, test, model_type, params):
        refits.append(params["maxIter"])
        return None, forecast.forecast_metrics(test, predicted="weekly_sales")

    monkeypatch.setattr(forecast, "SharedMatrix", Matrix)
    monkeypatch.setattr(forecast, "measured", lambda model, df: (1.0, 1.0))
    monkeypatch.setattr(forecast, "fit_evaluate", refit)
    monkeypatch.setattr(models, "parts", lambda spark, sf_dir: (df, df, df))
    monkeypatch.setattr(models, "_once", lambda spark, sf_dir, name, make: make())
    runs = models.hyperparam_search(spark, "").toPandas()
    assert {drawn for drawn, _ in fits} == set(forecast.draw_params(4, 42, forecast.SPACE))
    assert runs["n_estimators"].between(*forecast.SPACE["trees"]).all() and runs["trees_fitted"].max() == runs["n_estimators"].max()
    assert models.champion_gates(spark, "").count() == 1 and refits == [runs["n_estimators"].max()]


def test_boosting_has_a_folder_for_its_checkpoints(spark, monkeypatch):
    """Without one some hundred rounds overflow the stack."""
    named = []
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: named[-1] if named else None)
    monkeypatch.setattr(type(spark.sparkContext), "setCheckpointDir", lambda self, path: named.append(path))
    df = toy(spark, 40).where("x IS NOT NULL")
    for _ in range(2):
        forecast.fit(df, "boosting", {"maxIter": 1, "maxDepth": 1}, NUM, CAT)
    assert len(named) == 1 and "checkpoints" in named[0]


def test_attributions(spark):
    df = toy(spark).where("x IS NOT NULL")
    model = forecast.fit(df, "random_forest", {"numTrees": 10, "maxDepth": 6}, NUM, CAT)
    keys, cols = ["store", "dept", "date"], ["x", "noise", "kind"]
    worse = {r["feature"]: r["delta_wmape"] for r in explain.permutation_importance(model, df, cols, keys).collect()}
    assert worse["x"] > worse["noise"] and worse["x"] > 5
    rows = df.orderBy("date").limit(2)
    parts = explain.shapley(model, rows, df, cols, keys, orders=12).toPandas()
    assert len(parts) == 6
    for _, one in parts.groupby("date"):
        assert one["attribution"].sum() == pytest.approx((one["prediction"] - one["base_value"]).iloc[0])


def test_direct_and_recursive_forecasts(spark, small_gold):
    year = forecast.direct_year(small_gold)
    series = small_gold.select("store", "dept").distinct().count()
    assert year.count() == series * 52
    model = forecast.fit(small_gold.na.drop(subset=["sales_last_year"]), "boosting", {"maxIter": 3, "maxDepth": 3})
    steps = forecast.recursive(model, small_gold, 3).toPandas()
    assert len(steps) == series * 3 and not steps["prediction"].isna().any()
    last = small_gold.agg(F.max("date")).first()[0]
    assert sorted(set(steps["date"])) == [last + pd.Timedelta(days=7 * h) for h in (1, 2, 3)]


def test_isolation_forest_finds_the_odd_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 2))
    x[:10] += 9
    pdf = pd.DataFrame({"k": np.arange(2000), "a": x[:, 0], "b": x[:, 1]})
    df = spark.createDataFrame(pdf)
    flagged = anomaly.flag(df, ["a", "b"], ["k"], contamination=0.005)
    odd = {r["k"] for r in flagged.where("anomaly_flag = -1").collect()}
    assert len(odd) == 10 and odd == set(range(10))
    other = anomaly.fit_isolation_forest(df.repartition(5), ["a", "b"], ["k"])
    same = anomaly.fit_isolation_forest(df.repartition(2), ["a", "b"], ["k"])
    assert np.array_equal(other.threshold, same.threshold)


def test_isolation_forest_samples_of_a_large_table(spark):
    df = spark.range(200_000).select(F.col("id").alias("k"), F.rand(3).alias("a"))
    picked = anomaly._tree_samples(df, ["k"], 20, 64, 42, 200_000).groupBy("tree").count().collect()
    assert len(picked) == 20 and all(r["count"] == 64 for r in picked)


def test_forest_depths_against_walking_by_hand(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(50)], "k long, a double")
    forest = anomaly.fit_isolation_forest(df, ["a"], ["k"], trees=5, sample_size=16)
    got = {r["k"]: r["s"] for r in forest.score(df, "s").collect()}
    for k, v in ((0, 0.0), (25, 625.0), (49, 2401.0)):
        total = 0.0
        for t in range(5):
            node = 0
            while forest.left[t, node] != node:
                node = forest.left[t, node] if v <= forest.threshold[t, node] else forest.right[t, node]
            total += forest.depth[t, node]
        assert got[k] == pytest.approx(2 ** (-total / 5 / anomaly.average_path(16)))


def test_ratio_fixture(spark):
    rows = [(1, 150000.0, 150000.0), (2, 5000.0, 50.0)]
    df = spark.createDataFrame(rows, "store int, weekly_sales double, sales_last_year double").withColumns(
        {"rolling_4_wk_sales_avg": F.lit(1.0), "total_markdown": F.lit(0.0), "store_size": F.lit(0), "isholiday": F.lit(0)}
    )
    got = {r["store"]: r for r in anomaly.ratios(df).collect()}
    assert got[1]["yoy_growth_ratio"] == pytest.approx(150000 / 150001)
    assert got[2]["yoy_growth_ratio"] == pytest.approx(5000 / 51)
    assert got[1]["footprint_yield"] is None and got[1]["holiday_miss_severity"] == 1.0


@pytest.mark.parametrize("tile", [7, 2048])
def test_silhouette_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(segments, "TILE", tile)
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": range(30), "x": rng.normal(size=30), "y": rng.normal(size=30), "c": [0] * 14 + [1] * 15 + [2]})
    d = np.sqrt(((pdf[["x", "y"]].to_numpy()[:, None] - pdf[["x", "y"]].to_numpy()[None]) ** 2).sum(-1))
    want = {}
    for i, c in zip(pdf["id"], pdf["c"]):
        own = pdf["c"] == c
        if own.sum() == 1:
            want[i] = 0.0
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][pdf["c"] == o].mean() for o in set(pdf["c"]) - {c})
        want[i] = (b - a) / max(a, b)
    got = segments.silhouette(spark.createDataFrame(pdf), "id", ["x", "y"], "c").collect()
    assert {r["id"]: r["silhouette"] for r in got} == pytest.approx(want)


def test_silhouette_leaves_far_clusters_alone(spark, monkeypatch):
    """Six clusters on a line: a point meets its own and at most both neighbours, and the
    result is that of all distances. A point without a cluster gets 0."""
    monkeypatch.setattr(segments, "TILE", 16)
    rng = np.random.default_rng(3)
    c = np.repeat(np.arange(6), 40)
    pdf = pd.DataFrame({"id": range(240), "x": 10.0 * c + rng.normal(size=240), "y": rng.normal(size=240), "c": c})
    points = spark.createDataFrame(pdf)
    placed = points.select("id", F.col("c").cast("string").alias("cluster"), F.array("x", "y").alias("v"))
    met = segments.nearby(placed, 2).groupBy("id", "cluster").agg(F.collect_set(F.col("near").cast("int")).alias("near")).collect()
    assert all(set(r["near"]) <= {int(r["cluster"]) + k for k in (-1, 0, 1)} and int(r["cluster"]) in r["near"] for r in met) and len(met) == 240
    xy = pdf[["x", "y"]].to_numpy()
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1))
    want = {}
    for i in range(240):
        a = d[i][c == c[i]].sum() / 39
        b = min(d[i][c == o].mean() for o in range(6) if o != c[i])
        want[i] = (b - a) / max(a, b)
    lost = spark.createDataFrame([(240, 0.0, 0.0, None)], points.schema)
    got = {r["id"]: r["silhouette"] for r in segments.silhouette(points.unionByName(lost), "id", ["x", "y"], "c").collect()}
    assert got == pytest.approx({**want, 240: 0.0})


def test_clusters_are_numbered_by_size(spark, small_gold):
    found = segments.archetypes(segments.kmeans(segments.profiles(small_gold)))
    centres = sorted((r["cluster"], r["store_size"]) for r in segments.centres(found).collect())
    assert [c for c, _ in centres] == [0, 1, 2]
    assert centres[0][1] > centres[1][1] > centres[2][1]
    assert {r["archetype"] for r in found.select("archetype").collect()} == set(segments.ARCHETYPES)


def test_roi_figures(spark):
    df = spark.createDataFrame([("2010-02-05", 60.0), ("2010-02-05", 40.0), ("2010-02-12", 100.0)], "date string, weekly_sales double")
    row = kpi.roi(df).first()
    assert (row["annual_revenue"], row["annual_cogs"]) == (5200.0, 3900.0)
    assert row["holding_savings"] == pytest.approx(3900 / 8.5 * 0.08 * 0.2)


def test_inflate_scales_copies(spark):
    df = spark.createDataFrame([("2010-02-05", 100.0)], "date string, cpi double").withColumn("date", F.col("date").cast("date"))
    got = kpi.inflate(df, 3, drift={"cpi": 0.1}).orderBy("date").collect()
    assert [str(r["date"]) for r in got] == ["2010-02-05", "2011-02-04", "2012-02-03"]
    assert [r["cpi"] for r in got] == pytest.approx([100.0, 110.0, 120.0])
