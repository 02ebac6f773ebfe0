import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weekgrid.functions.correlation import pair_correlations
from weekgrid.functions.quantiles import quantiles
from weekgrid.functions.running import ranges, running_totals
from weekgrid.operators import affinity, drift, metrics, prep, profiling, splits, timeseries


def frame(spark, y, p, h):
    rows = list(zip(map(float, y), map(float, p), h))
    return spark.createDataFrame(rows, "weekly_sales double, prediction double, isholiday int")


@pytest.mark.parametrize("pred, wmape", [((50, 100), 8.33), ((100, 50), 41.67)])
def test_wmape_weighs_holidays(spark, pred, wmape):
    assert metrics.forecast_metrics(frame(spark, (100, 100), pred, (0, 1))).first()["wmape"] == wmape


def test_perfect_prediction(spark):
    row = metrics.forecast_metrics(frame(spark, (10, 20, 30), (10, 20, 30), (0, 0, 0))).first()
    assert tuple(row) == (0.0, 0.0, 0.0, 1.0)


def test_weighted_error_worked_example(spark):
    df = spark.createDataFrame([(100.0, 150.0, False), (1000.0, 990.0, True)], "y double, p double, h boolean")
    assert round(metrics.weighted_errors(df, "y", "p", "h").first()["wmape"], 4) == 0.0196


def test_split_of_hundred_days(spark):
    df = spark.range(100).select(F.date_add(F.lit("2010-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    bounds = splits.boundaries(df).first()
    assert [str(b) for b in bounds] == ["2010-03-11", "2010-03-26"]
    spans = splits.chronological(df).groupBy("split").agg(F.count("*").alias("n"), F.min("date"), F.max("date"))
    got = {r[0]: r[1:] for r in spans.collect()}
    assert {k: v[0] for k, v in got.items()} == {"train": 70, "val": 15, "test": 15}
    assert got["train"][2] < got["val"][1] and got["val"][2] < got["test"][1]


def test_candidate_choice_uses_defaults_and_ties(spark):
    runs = spark.createDataFrame(
        [("a", 8.0, None, None), ("b", 8.2, 1.0, 1.0), ("c", 8.2, 1.0, 1.0), ("d", 9.0, 0.0, 0.0)],
        "run_id string, wmape_val double, latency_ms double, model_size_mb double",
    )
    best = metrics.select_candidate(runs).first()
    assert best["run_id"] == "b" and best["score"] == pytest.approx(8.2 * 0.7 + 0.2 + 0.1)


def test_gates_fail_on_missing_figures(spark):
    df = spark.createDataFrame([(8.0, 0.96, 10.0), (8.0, 0.90, 10.0), (8.0, None, 10.0)], "wmape double, r2 double, latency_ms double")
    assert [r["promoted"] for r in metrics.quality_gates(df).collect()] == [True, False, False]


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_equal_numpy_on_skewed_values(spark, accuracy):
    rng = np.random.default_rng(3)
    # a third of all rows is one value
    values = np.concatenate([np.full(1000, 7.25), rng.lognormal(2, 2, 2000)])
    df = spark.createDataFrame(pd.DataFrame({"g": ["x", "y", "z"] * 1000, "v": values}))
    probs = [0.0, 0.005, 0.25, 0.5, 0.9, 1.0]
    got = {r["prob"]: r["value"] for r in quantiles(df, ["v"], probs, accuracy=accuracy).collect()}
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in probs})
    by = quantiles(df, ["v"], [0.3], by=["g"], accuracy=accuracy).collect()
    pdf = df.toPandas()
    assert {r["g"]: r["value"] for r in by} == pytest.approx(
        {g: float(np.quantile(x["v"], 0.3)) for g, x in pdf.groupby("g")}
    )


def test_discrete_quantile_is_an_observed_value(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    assert [r["value"] for r in quantiles(df, ["v"], [0.25], discrete=True).collect()] == [3.0]


def test_running_totals_match_one_window(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 4000), "v": rng.normal(size=4000).round(3)})
    pdf = pdf.drop_duplicates().sort_values(["g", "v"]).assign(m=lambda d: np.arange(len(d)) % 7)
    # so little data would otherwise be merged into one range
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        table = ranges(spark.createDataFrame(pdf), ["g"], "v")
    finally:
        spark.conf.set(merge, "true")
    assert table.select("bucket").distinct().count() > 2
    got = running_totals(table, ["g"], "v", ["m"]).toPandas().sort_values(["g", "v"]).reset_index(drop=True)
    want = pdf.reset_index(drop=True)
    assert got["m_upto"].tolist() == want.groupby("g")["m"].cumsum().tolist()
    follow = want.groupby("g")["v"].shift(-1)
    assert got["next_value"].fillna(-9).tolist() == follow.fillna(-9).tolist()


def test_correlations_equal_pandas_and_skip_constants(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc")).assign(k=1.0)
    pdf.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = {(r["a"], r["b"]): r["score"] for r in pair_correlations(df, list("abck")).collect()}
    want = pdf.corr()
    for x, y in [("a", "b"), ("a", "c"), ("b", "c")]:
        assert got[(x, y)] == pytest.approx(want.loc[x, y])
    assert got[("a", "k")] is None


def test_skewness_equals_pandas(spark):
    pdf = pd.DataFrame({"v": [1.0, 2.0, 9.0, 4.0], "k": [3.0] * 4})
    got = {r["column"]: r["skew"] for r in profiling.skewness(spark.createDataFrame(pdf), ["v", "k"]).collect()}
    assert got["v"] == pytest.approx(pdf["v"].skew()) and got["k"] is None


def test_histogram_counts_every_value(spark):
    values = [0.0, 0.5, 1.0, 9.99, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["bin"]: r["n"] for r in profiling.histogram(df, "v", 10).collect()}
    counts, _ = np.histogram(values, 10)
    assert got == {i: int(c) for i, c in enumerate(counts) if c}


def test_constant_column_histogram_and_scaling(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [(r["bin"], r["n"]) for r in profiling.histogram(df, "v").collect()] == [(0, 2)]
    assert [r["v"] for r in prep.robust_scale(df, ["v"]).collect()] == [0.0, 0.0]


def test_mode_imputation_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "v string")
    assert sorted(r["v"] for r in prep.mode_impute(df, ["v"]).collect()) == ["a", "a", "b"]


def test_one_hot_drops_first_and_zeroes_unknown(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "t string")
    got = prep.one_hot(df, "t", ["B", "A"])
    assert got.columns == ["t", "t_B"]
    assert [r["t_B"] for r in got.collect()] == [0, 1, 0, 0]


def test_residual_fixture(spark):
    rows = [(1, 90, "2011-01-07", 50000.0, 50000.0), (1, 90, "2011-01-14", 60000.0, 10000.0), (1, 90, "2011-01-21", 5.0, None)]
    df = spark.createDataFrame(rows, "store int, dept int, date string, weekly_sales double, sales_last_year double")
    assert sorted(r["residual_sales"] for r in affinity.residuals(df).collect()) == [0.0, 50000.0]


@pytest.mark.parametrize("block, batch", [(2, 10_000), (512, 10_000), (512, 3), (2, 1)])
def test_pair_scores_equal_zero_filled_matrix(spark, monkeypatch, block, batch):
    """Also with batches that cut baskets apart."""
    monkeypatch.setattr(affinity, "BLOCK", block)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(size)
    spark.conf.set(size, str(batch))
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame([(s, d, w, rng.normal()) for s in range(4) for d in (1, 2, 5, 9, 12) for w in range(9)],
                       columns=["store", "dept", "date", "residual_sales"])
    pdf = pdf[rng.random(len(pdf)) < 0.7]
    # two departments that never share a basket
    pdf = pdf[~((pdf["dept"] == 12) & (pdf["date"] < 5)) & ~((pdf["dept"] == 9) & (pdf["date"] >= 5))]
    want = pdf.pivot(index=["store", "date"], columns="dept", values="residual_sales").fillna(0).corr()
    try:
        got = affinity.pair_scores(spark.createDataFrame(pdf)).collect()
    finally:
        spark.conf.set(size, kept)
    assert len(got) == 10
    for r in got:
        assert r["correlation_score"] == pytest.approx(want.loc[r["department_a"], r["department_b"]])


def test_decompose_equals_direct_computation(spark):
    n, period = 40, 8
    t = np.arange(n)
    y = 0.5 * t + 3 * np.sin(2 * np.pi * t / period) + np.cos(t)
    days = pd.date_range("2010-01-01", periods=n, freq="7D").date
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "date": days, "y": y}))
    got = timeseries.decompose(df, ["k"], "y", period=period).toPandas().sort_values("date").reset_index(drop=True)
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(n, np.nan)
    trend[4:-4] = np.convolve(y, weights, "valid")
    swing = np.array([np.nanmean((y - trend)[i::period]) for i in range(period)])
    seasonal = np.tile(swing - swing.mean(), n // period)
    np.testing.assert_allclose(got["trend"].astype(float), trend)
    np.testing.assert_allclose(got["seasonal"].astype(float), seasonal)
    np.testing.assert_allclose(got["resid"].astype(float), y - trend - seasonal)


def ar_frame(spark, phi, n=400):
    rng = np.random.default_rng(9)
    y = np.zeros(n)
    for i in range(1, n):
        y[i] = phi * y[i - 1] + rng.normal()
    days = pd.date_range("2000-01-07", periods=n, freq="7D").date
    return y, spark.createDataFrame(pd.DataFrame({"k": "s", "date": days, "y": y}))


def test_correlograms(spark):
    y, df = ar_frame(spark, 0.7)
    d = y - y.mean()
    acf = timeseries.autocorrelation(df, ["k"], "y", lags=12)
    got = {r["lag"]: r["acf"] for r in acf.collect()}
    want = [float((d[k:] * d[: len(d) - k]).sum() / (d * d).sum()) for k in range(13)]
    assert [got[k] for k in range(13)] == pytest.approx(want)
    pacf = {r["lag"]: r["pacf"] for r in timeseries.partial_autocorrelation(acf, ["k"]).collect()}
    for k in (1, 2, 5, 12):
        system = np.array([[want[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pacf[k] == pytest.approx(np.linalg.solve(system, want[1 : k + 1])[-1])


def test_unit_root_separates_stationary_from_walk(spark):
    _, still = ar_frame(spark, 0.3)
    _, walk = ar_frame(spark, 1.0)
    a = timeseries.unit_root(still, ["k"], "y").first()
    b = timeseries.unit_root(walk, ["k"], "y").first()
    assert a["stationary"] and a["p_value"] < 0.01 and a["statistic"] < a["crit_1"]
    assert not b["stationary"] and b["p_value"] > 0.05


def test_unit_root_far_from_zero(spark):
    """A constant changes no statistic, however large it is next to the movements."""
    walk = np.cumsum(np.random.default_rng(3).normal(size=344))
    rows = [(k, i, float(v + level)) for k, level in (("near", 0.0), ("far", 1e9)) for i, v in enumerate(1e3 * walk)]
    df = spark.createDataFrame(rows, "k string, date int, y double")
    for limit in (0, 4):
        got = {r["k"]: r for r in timeseries.unit_root(df, ["k"], "y", max_lag=limit).collect()}
        assert got["far"]["lags"] == got["near"]["lags"]
        assert got["far"]["statistic"] == pytest.approx(got["near"]["statistic"], rel=1e-6)
    y, dy = 1e3 * walk[:-1], 1e3 * np.diff(walk)
    x, d = y - y.mean(), dy - dy.mean()
    b = (x @ d) / (x @ x)
    want = b / np.sqrt(((d - b * x) ** 2).sum() / (len(x) - 2) / (x @ x))
    assert timeseries.unit_root(df.where("k = 'far'"), ["k"], "y", max_lag=0).first()["statistic"] == pytest.approx(want, rel=1e-6)


def test_unit_root_without_a_change_of_level(spark):
    df = spark.createDataFrame([("s", i, 5.0 if i < 9 else 7.0) for i in range(10)], "k string, date int, y double")
    assert timeseries.unit_root(df, ["k"], "y", max_lag=0).first()["statistic"] is None


def test_unit_root_without_enough_data(spark):
    df = spark.createDataFrame([("s", 1, 2.0), ("s", 2, 2.0)], "k string, date int, y double")
    assert timeseries.unit_root(df, ["k"], "y").first()["statistic"] is None


def test_numeric_drift_equals_direct_wasserstein(spark):
    rng = np.random.default_rng(4)
    a = np.round(rng.normal(0, 1, 900), 2)
    b = np.round(rng.normal(0.4, 1.5, 700), 2)
    one, two = (spark.createDataFrame(pd.DataFrame({"v": x, "few": np.arange(len(x)) % 3.0})) for x in (a, b))
    grid = np.unique(np.r_[a, b])
    fa = np.searchsorted(np.sort(a), grid, "right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, "right") / len(b)
    want = float((np.abs(fa - fb)[:-1] * np.diff(grid)).sum() / a.std())
    got = {r["column"]: r for r in drift.numeric(one, two, ["v", "few"]).collect()}
    assert got["v"]["score"] == pytest.approx(want) and got["v"]["drifted"]
    assert got["few"]["method"] == "jensen_shannon" and not got["few"]["drifted"]


def test_categorical_drift_bounds(spark):
    one = spark.createDataFrame([("x",), ("y",)], "c string")
    two = spark.createDataFrame([("z",)], "c string")
    assert drift.categorical(one, one, ["c"]).first()["score"] == pytest.approx(0.0)
    assert drift.categorical(one, two, ["c"]).first()["score"] == pytest.approx(math.sqrt(math.log(2)))


@pytest.mark.parametrize("drifted, severity", [(1, "ok"), (3, "warning"), (5, "critical")])
def test_drift_severity(spark, drifted, severity):
    df = spark.createDataFrame([(f"c{i}", i < drifted) for i in range(10)], "column string, drifted boolean")
    assert drift.report(df).first()["severity"] == severity


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"] for r in drift.sample(df.repartition(3), 50, ["k"]).collect()}
    b = {r["k"] for r in drift.sample(df.repartition(7), 50, ["k"]).collect()}
    assert a == b and len(a) == 50
