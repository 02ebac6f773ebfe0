"""Sales forecasting with Spark ML: log target, model registry, search, scoring."""

from __future__ import annotations

import math
import random
import statistics
import time
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from weekgrid.operators import boosting
from weekgrid.operators.gold import CATEGORICAL, NUMERIC, with_calendar
from weekgrid.operators.metrics import forecast_metrics, quality_gates, select_candidate
from weekgrid.operators.prep import fit_features
from weekgrid.session import bound_lineage, scratch_path, stored

TARGET = "weekly_sales"
ORDER_KEYS = ["store", "dept", "date"]
MODELS = ("linear", "random_forest", "boosting", "leafwise", "ordered")


def _estimator(model_type: str, train: DataFrame, params: dict, levels: int):
    """``levels``: of the category that has most; a tree needs a bin for each."""
    params = {"maxBins": max(128, levels), **params}
    common = {"featuresCol": "features", "labelCol": "label", "predictionCol": "log_prediction"}
    if model_type == "linear":
        # Ridge with penalty alpha: Spark divides the loss by n and the label by its deviation.
        alpha = params.pop("alpha", 1.0)
        params.pop("maxBins")
        row = train.agg(F.count("*").alias("n"), F.stddev_pop("label").alias("sd")).first()
        strength = alpha * (row["sd"] or 0.0) / max(row["n"], 1)
        return LinearRegression(
            elasticNetParam=0.0, standardization=False, regParam=strength, **common, **params
        )
    if model_type == "random_forest":
        return RandomForestRegressor(
            **common, **{"numTrees": 100, "maxDepth": 15, "seed": 42, **params}
        )
    if model_type == "boosting":
        bound_lineage(train.sparkSession)
        return GBTRegressor(**common, **{"maxIter": 100, "maxDepth": 6, "seed": 42, **params})
    raise ValueError(f"unknown model type {model_type!r}, expected one of {MODELS}")


def fit(
    train: DataFrame,
    model_type: str = "boosting",
    params: dict | None = None,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
) -> PipelineModel:
    """One saved-and-loadable model from raw columns to ``prediction`` in dollars.

    The label is log1p of sales; the last stage turns the fitted value back. Of the
    boosting variants ``boosting`` grows trees level by level, ``leafwise`` by the best
    leaf, and ``ordered`` grows symmetric trees on ordered target statistics of the
    categories (rows are named by store, department and date).
    """
    if model_type not in MODELS:
        raise ValueError(f"unknown model type {model_type!r}, expected one of {MODELS}")
    numeric = NUMERIC if numeric is None else numeric
    categorical = CATEGORICAL if categorical is None else categorical
    label = F.log1p(F.greatest(F.col(TARGET), F.lit(0.0)))
    before = []
    if model_type == "ordered":
        train = train.withColumn("label", label)
        prior = train.agg(F.avg("label")).first()[0] or 0.0
        before = [boosting.final_statistics(train, categorical, "label", prior)]
        train = boosting.ordered_statistics(train, categorical, "label", ORDER_KEYS, prior)
        numeric, categorical = [*numeric, *[f"{c}_stat" for c in categorical]], []
    features = fit_features(train, numeric, categorical, encode=model_type == "linear")
    ready = features.transform(train).select("features", label.alias("label"))
    ready = stored(ready, "training-matrix")
    if model_type in ("leafwise", "ordered"):
        growth = {"leafwise": {"growth": "leaf"}, "ordered": {"growth": "symmetric", "l2": 3.0}}[model_type]
        trees = boosting.fit_trees(ready, **{**growth, **(params or {})})
        return PipelineModel([*before, *features.stages, trees, _in_dollars()])
    indexers = [s for s in features.stages if isinstance(s, StringIndexerModel)]
    levels = max((len(labels) + 1 for s in indexers for labels in s.labelsArray), default=0)
    model = _estimator(model_type, ready, params or {}, levels).fit(ready)
    return PipelineModel([*features.stages, model, _in_dollars()])


def _in_dollars() -> SQLTransformer:
    return SQLTransformer(statement="SELECT *, expm1(log_prediction) AS prediction FROM __THIS__")


def regressor(model: PipelineModel):
    return model.stages[-2]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns and ``prediction``."""
    return model.transform(df).select(*df.columns, "prediction")


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The forecast as a business view."""
    return predict(model, df).select(
        "store", "dept", "date", TARGET, F.col("prediction").alias("predicted_weekly_sales")
    )


def fit_evaluate(
    train: DataFrame, test: DataFrame, model_type: str = "boosting", params: dict | None = None
) -> tuple[PipelineModel, DataFrame]:
    model = fit(train, model_type, params)
    return model, forecast_metrics(predict(model, test))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """The columns behind the places of the feature vector."""
    schema = PipelineModel(model.stages[:-2]).transform(df.limit(0)).schema["features"]
    attrs = schema.metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    return [names[i].removesuffix("_full").removesuffix("_index") for i in range(len(names))]


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance) of a tree model."""
    values = regressor(model).featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(feature_names(model, df), values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def live_window(gold: DataFrame, n: int = 1000) -> DataFrame:
    """The newest ``n`` complete rows, by date, store and department."""
    latest = [F.desc("date"), F.desc("store"), F.desc("dept")]
    return gold.na.drop("any").orderBy(*latest).limit(n)


def boosting_params(trees: int, rate: float, depth: int, subsample: float, share: float) -> dict:
    return {
        "maxIter": trees, "maxDepth": depth, "stepSize": rate, "subsamplingRate": subsample,
        "featureSubsetStrategy": str(round(share, 4)),
    }


def measured(model: PipelineModel, df: DataFrame, repeats: int = 5) -> tuple[float | None, float]:
    """Milliseconds to score one row of ``df`` (median of ``repeats``, after one that
    is not counted; None without a row) and megabytes of the saved model."""
    spark = df.sparkSession
    one, times = df.limit(1).collect(), []
    row = spark.createDataFrame(one, df.schema)
    for _ in range(repeats + 1 if one else 0):
        start = time.perf_counter()
        predict(model, row).collect()
        times.append(1000 * (time.perf_counter() - start))
    path = scratch_path(spark, "measured-model")
    save(model, path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    size = files.getContentSummary(place).getLength() / 1e6
    files.delete(place, True)
    return statistics.median(times[1:]) if one else None, size


SPACE = {
    # The ranges searched.
    "trees": (50, 1000), "learning_rate": (0.01, 0.3), "depth": (3, 10), "subsample": (0.6, 1.0), "feature_share": (0.6, 1.0),
}


def draw_params(draws: int, seed: int, space: dict) -> list[tuple]:
    """(trees, rate, depth, subsample, feature share) of each draw, the rate by its logarithm."""
    rng = random.Random(seed)
    out = []
    for _ in range(draws):
        low, high = space["learning_rate"]
        trees, depth = rng.randint(*space["trees"]), rng.randint(*space["depth"])
        rate = math.exp(rng.uniform(math.log(low), math.log(high)))
        out.append((trees, rate, depth, rng.uniform(*space["subsample"]), rng.uniform(*space["feature_share"])))
    return out


class SharedMatrix:
    """Features fitted once on the training weeks, with the training and the validation
    matrix stored once for all draws of a search."""

    def __init__(self, train: DataFrame, val: DataFrame, numeric: list[str] | None = None, categorical: list[str] | None = None):
        numeric, categorical = numeric or NUMERIC, categorical or CATEGORICAL
        self.features = fit_features(train, numeric, categorical, encode=False)
        label = F.log1p(F.greatest(F.col(TARGET), F.lit(0.0)))
        self.train = stored(self.features.transform(train).select("features", label.alias("label")), "search-train")
        self.val = stored(self.features.transform(val).select("features", TARGET, "isholiday"), "search-val")
        indexers = [s for s in self.features.stages if isinstance(s, StringIndexerModel)]
        self.levels = max((len(labels) + 1 for s in indexers for labels in s.labelsArray), default=0)

    def fit(self, drawn: tuple, rounds: int) -> PipelineModel:
        """A model of the first ``rounds`` trees of a draw, on vectors."""
        params = boosting_params(rounds, *drawn[1:])
        return PipelineModel([_estimator("boosting", self.train, params, self.levels).fit(self.train), _in_dollars()])

    def metrics(self, model: PipelineModel):
        return forecast_metrics(model.transform(self.val)).first()

    def whole(self, model: PipelineModel) -> PipelineModel:
        """The model from raw columns."""
        return PipelineModel([*self.features.stages, *model.stages])


def rungs(draws: int, eta: int) -> list[tuple[float, int]]:
    """(share of a draw's trees, draws kept) of each rung: all draws with the fewest
    trees first, one of ``eta`` of them with ``eta`` times as many next, one at last."""
    kept = [draws]
    while kept[-1] > 1:
        kept.append(-(-kept[-1] // eta))
    return [(float(eta) ** (i - len(kept) + 1), n) for i, n in enumerate(kept)]


def search(
    train: DataFrame, val: DataFrame, draws: int = 2, seed: int = 42, space: dict | None = None, eta: int = 3, parallelism: int = 4,
    numeric: list[str] | None = None, categorical: list[str] | None = None,
) -> DataFrame:
    """Random draws of boosting parameters, narrowed by successive halving: one row per
    draw with the validation metrics, measured latency and size of its last model.

    All draws are fitted on one stored feature matrix with a share of their trees; the
    best of them by error go on with ``eta`` times as many, until the last ones have all
    theirs. Up to ``parallelism`` fits are submitted side by side, so that small jobs
    fill a cluster; each is a distributed job over the whole table. ``n_estimators`` is
    the draw's own number and ``trees_fitted`` what its last model has.
    """
    matrix = SharedMatrix(train, val, numeric, categorical)
    drawn = draw_params(draws, seed, SPACE | (space or {}))
    alive, results = list(range(draws)), {}

    def run(task: tuple[int, int]):
        i, rounds = task
        model = matrix.fit(drawn[i], rounds)
        return i, rounds, model, matrix.metrics(model)

    with ThreadPool(max(1, min(parallelism, draws))) as pool:
        for share, count in rungs(draws, eta):
            alive = alive[:count]
            tasks = [(i, max(1, math.ceil(share * drawn[i][0]))) for i in alive]
            for i, rounds, model, found in pool.imap_unordered(inheritable_thread_target(val.sparkSession)(run), tasks):
                results[i] = (rounds, model, found)
            wmape = lambda i: results[i][2]["wmape"]
            alive.sort(key=lambda i: (wmape(i) is None, wmape(i), i))
    rows = []
    for i, (rounds, model, found) in sorted(results.items()):
        errors = (found["wmape"], found["mae"], found["rmse"], found["r2"])
        # One after the other: fits beside it would be in the measured latency.
        rows.append((f"run_{i:03d}", *errors, *measured(matrix.whole(model), val), *drawn[i], rounds))
    return val.sparkSession.createDataFrame(
        rows,
        "run_id string, wmape_val double, mae_val double, rmse_val double, r2_val double, latency_ms double,"
        " model_size_mb double, n_estimators int, learning_rate double, max_depth int, subsample double, colsample double,"
        " trees_fitted int",
    )


def champion(
    runs: DataFrame, train: DataFrame, val: DataFrame, test: DataFrame, max_wmape: float = 8.5, **gates
) -> tuple[PipelineModel | None, DataFrame]:
    """The selected run refitted on train and validation weeks, and one row of its
    test metrics, measured latency and size, and gates. No model and no row if no
    run has an error below ``max_wmape``."""
    chosen = select_candidate(runs, max_wmape).select(
        "run_id", "n_estimators", "learning_rate", "max_depth", "subsample", "colsample"
    ).first()
    if chosen is None:
        model, run_id, figures = None, None, (None, None)
        found = forecast_metrics(test, predicted=TARGET).limit(0)
    else:
        run_id, *drawn = chosen
        model, found = fit_evaluate(train.unionByName(val), test, "boosting", boosting_params(*drawn))
        figures = measured(model, test)
    names = {"run_id": F.lit(run_id).cast("string")}
    names |= {n: F.lit(v).cast("double") for n, v in zip(("latency_ms", "model_size_mb"), figures)}
    return model, quality_gates(found.withColumns(names), **gates)


def direct_year(gold: DataFrame, days: int = 364) -> DataFrame:
    """The 52 weeks after the last date from the anchor of a year before: a week's
    forecast is the same week's latest sales, with no recursion."""
    last = gold.agg(F.max("date")).scalar()
    recent = gold.where(F.col("date") > F.date_sub(last, days))
    return recent.select(
        "store", "dept", F.date_add("date", days).alias("date"), F.col(TARGET).alias("prediction")
    )


CARRIED = [
    "store_type", "store_size", "temperature", "fuel_price", "cpi", "unemployment", "markdown1",
    "markdown2", "markdown3", "markdown4", "markdown5", "total_markdown",
]


def recursive(model: PipelineModel, gold: DataFrame, horizon: int = 4) -> DataFrame:
    """Forecast week by week, each week's predictions feeding the next one's lags.

    A step reads the last 53 weeks of every series in one grouping and is
    written out, so the plan does not grow with the horizon. Indicators keep
    their last value; the holiday flag is that of the same week last year.
    """
    end = gold.agg(F.max("date").alias("d")).first()["d"]
    kept = ["store", "dept", "date", TARGET, "isholiday", *CARRIED]
    history = stored(
        gold.where(F.col("date") > F.date_sub(F.lit(end), 53 * 7)).select(*kept), "recent-weeks"
    )
    steps: list[DataFrame] = []
    sales, day = F.col(TARGET), F.col("date")
    for h in range(1, horizon + 1):
        target = F.date_add(F.lit(end), 7 * h)

        def ago(weeks: int, column=sales, target=target):
            return F.max(F.when(day == F.date_sub(target, 7 * weeks), column))

        known = history
        for done in steps:
            known = known.unionByName(done.withColumnRenamed("prediction", TARGET).select(*kept))
        features = known.groupBy("store", "dept").agg(
            ago(1).alias("lag_1_sales"),
            ago(5).alias("lag_5_sales"),
            ago(52).alias("sales_last_year"),
            F.avg(F.when(day >= F.date_sub(target, 28), sales)).alias("rolling_4_wk_sales_avg"),
            ago(12, F.col("cpi")).alias("cpi_lag_3_month"),
            F.coalesce(ago(52, F.col("isholiday")), F.lit(0)).alias("isholiday"),
            *[F.max_by(c, "date").alias(c) for c in CARRIED],
        )
        dated = with_calendar(features.withColumn("date", target))
        kept_out = ["store", "dept", "date", "isholiday", *CARRIED, "prediction"]
        steps.append(stored(predict(model, dated).select(*kept_out), f"horizon-{h}"))
    out = None
    for h, done in enumerate(steps, start=1):
        part = done.select("store", "dept", "date", F.lit(h).alias("horizon"), "prediction")
        out = part if out is None else out.unionByName(part)
    return out


def saved_and_loaded(model: PipelineModel, df: DataFrame) -> PipelineModel:
    """The model after a round trip through the shared folder."""
    path = scratch_path(df.sparkSession, "model")
    save(model, path)
    return load(path)
