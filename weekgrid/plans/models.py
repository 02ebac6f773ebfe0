"""Preparation and model queries.

Boosting fits have the operator's default size; forests are smaller than theirs
(100 trees of depth 15), which takes minutes a fit. All train on all rows. A model
is fitted once per panel and shared by the queries that need it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from weekgrid.functions.columns import rounded
from weekgrid.operators import attribution, boosting, drift, explain, forecast, metrics, prep, splits
from weekgrid.operators import gold as gold_ops
from weekgrid.plans.profile import typed_features
from weekgrid.plans.registry import query
from weekgrid.plans.shared import panel
from weekgrid.session import scratch_path, stored
from weekgrid.sources import tables

PARAMS = {"random_forest": {"numTrees": 20, "maxDepth": 8}}
KEYS = ["store", "dept", "date"]
_made: dict[tuple, object] = {}


def _once(spark, sf_dir, name, make):
    """``make()``, kept as long as the panel it was made from."""
    key = (panel(spark, sf_dir), name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def parts(spark, sf_dir):
    """The train, validation and test weeks."""

    def make():
        return stored(splits.chronological(splits.drop_warmup(panel(spark, sf_dir).stored_gold)), "labelled")

    return splits.parts(_once(spark, sf_dir, "labelled", make))


def fitted(spark, sf_dir, model_type, weeks="train+val"):
    named = dict(zip(("train", "val", "test"), parts(spark, sf_dir)))

    def make():
        rows = None
        for name in weeks.split("+"):
            rows = named[name] if rows is None else rows.unionByName(named[name])
        return forecast.fit(rows, model_type, PARAMS.get(model_type))

    return _once(spark, sf_dir, f"{model_type} on {weeks}", make)


def tested(spark, sf_dir, model_type):
    """Test metrics of a model of the train and validation weeks."""
    _, _, test = parts(spark, sf_dir)
    found = metrics.forecast_metrics(forecast.predict(fitted(spark, sf_dir, model_type), test))
    return labelled_metrics(found, model_type)


IMPUTED = ["markdown1", "markdown2", "cpi", "unemployment"]


@query(
    "prep_median_impute",
    "SELECT CAST(store AS INTEGER) AS store, date, "
    + ", ".join(
        f"round(coalesce(try_cast({c} AS DOUBLE), (SELECT quantile_cont(try_cast({c} AS DOUBLE), 0.5) FROM raw_features)), 4) AS {c}"
        for c in IMPUTED
    )
    + " FROM raw_features",
)
def prep_median_impute(spark, sf_dir):
    raw = typed_features(spark, sf_dir).select("store", "date", *IMPUTED)
    return rounded(prep.median_impute(raw, IMPUTED), 4)


ROBUST = ["weekly_sales", "temperature", "total_markdown"]


@query(
    "prep_robust_scale",
    "SELECT store, dept, date, "
    + ", ".join(
        f"""round(({c} - (SELECT quantile_cont({c}, 0.5) FROM gold)) /
            (SELECT CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1.0
                    ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM gold), 6) AS {c}"""
        for c in ROBUST
    )
    + " FROM gold",
)
def prep_robust_scale(spark, sf_dir):
    gold = panel(spark, sf_dir).stored_gold.select("store", "dept", "date", *ROBUST)
    return rounded(prep.robust_scale(gold, ROBUST), 6)


@query(
    "prep_mode_impute",
    """WITH g AS (SELECT store, dept, date, CASE WHEN month % 2 = 0 THEN store_type END AS store_type,
                         CASE WHEN dept <> 2 THEN month END AS month FROM gold)
       SELECT store, dept, date,
              coalesce(store_type, (SELECT first(store_type ORDER BY k DESC, store_type) FROM
                  (SELECT store_type, count(*) AS k FROM g WHERE store_type IS NOT NULL GROUP BY 1))) AS store_type,
              coalesce(month, (SELECT first(month ORDER BY k DESC, CAST(month AS VARCHAR)) FROM
                  (SELECT month, count(*) AS k FROM g WHERE month IS NOT NULL GROUP BY 1))) AS month
       FROM g""",
)
def prep_mode_impute(spark, sf_dir):
    holes = panel(spark, sf_dir).stored_gold.select(
        "store",
        "dept",
        "date",
        F.when(F.col("month") % 2 == 0, F.col("store_type")).alias("store_type"),
        F.when(F.col("dept") != 2, F.col("month")).alias("month"),
    )
    return prep.mode_impute(holes, ["store_type", "month"])


@query(
    "prep_one_hot",
    """SELECT store, dept, date, CAST(store_type = 'B' AS INTEGER) AS "store_type_B",
              CAST(isholiday = 1 AS INTEGER) AS isholiday_1 FROM gold""",
)
def prep_one_hot(spark, sf_dir):
    """Type C counts as unknown here and gets zeros."""
    gold = panel(spark, sf_dir).stored_gold.select("store", "dept", "date", "store_type", "isholiday")
    coded = prep.one_hot(prep.one_hot(gold, "store_type", ["A", "B"]), "isholiday", [0, 1])
    return coded.drop("store_type", "isholiday")


@query(
    "prep_one_hot_learned",
    """SELECT store, dept, date, CAST(store_type = 'B' AS INTEGER) AS "store_type_B", CAST(store_type = 'C' AS INTEGER) AS "store_type_C",
              CAST(isholiday = 1 AS INTEGER) AS isholiday_1 FROM gold""",
)
def prep_one_hot_learned(spark, sf_dir):
    gold = panel(spark, sf_dir).stored_gold.select("store", "dept", "date", "store_type", "isholiday")
    return prep.one_hot(prep.one_hot(gold, "store_type"), "isholiday").drop("store_type", "isholiday")


def labelled_metrics(found, model_type):
    return found.select(F.lit(model_type).alias("model"), "wmape", "mae", "rmse", "r2")


@query("forecast_ridge")
def forecast_ridge(spark, sf_dir):
    return tested(spark, sf_dir, "linear")


@query(
    "forecast_ridge_one_feature",
    """WITH known AS (SELECT CAST(sales_last_year AS DOUBLE) AS x, ln(1 + greatest(weekly_sales, 0)) AS y FROM splits WHERE split IN ('train', 'val')),
            q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3 FROM known),
            width AS (SELECT CASE WHEN q3 = q1 THEN 1.0 ELSE q3 - q1 END AS d FROM q),
            z AS (SELECT (x - q2) / d AS z, y FROM known, q, width),
            b AS (SELECT regr_sxy(y, z) / (regr_sxx(y, z) + 1.0) AS slope, avg(y) AS my, avg(z) AS mz FROM z),
            p AS (SELECT weekly_sales AS y, CASE WHEN isholiday = 1 THEN 5.0 ELSE 1.0 END AS w,
                         exp(my + slope * ((sales_last_year - q2) / d - mz)) - 1 AS f
                  FROM splits, q, width, b WHERE split = 'test')
       SELECT 'linear' AS model, round(100 * sum(w * abs(y - f)) / sum(w * y), 2) AS wmape, round(avg(abs(y - f)), 2) AS mae,
              round(sqrt(avg((y - f) ** 2)), 2) AS rmse, round(1 - sum((y - f) ** 2) / (count(*) * var_pop(y)), 4) AS r2
       FROM p""",
)
def forecast_ridge_one_feature(spark, sf_dir):
    """Refit on train and validation weeks with one feature, where ridge has a closed
    form: imputation, scaling, log target, fit, scoring and metrics are all checked."""
    train, val, test = parts(spark, sf_dir)
    model = forecast.fit(train.unionByName(val), "linear", {"solver": "normal"}, ["sales_last_year"], [])
    return labelled_metrics(metrics.forecast_metrics(forecast.predict(model, test)), "linear")


WEIGHTS = "0.5 * coalesce(lag_1_sales, 0) + 0.3 * coalesce(sales_last_year, 0) + 0.2 * coalesce(rolling_4_wk_sales_avg, 0)"


OFF_TIES = 3.14159e-7  # weights of round cents give ties, which no two systems round alike


def recursion_sql(weeks: int) -> str:
    known = ["k0 AS (SELECT store, dept, date, weekly_sales FROM gold WHERE date > (SELECT max(date) FROM gold) - 371)"]
    for h in range(1, weeks + 1):
        target = f"(SELECT max(date) FROM gold) + {7 * h}"
        known.append(
            f"""f{h} AS (SELECT store, dept, max(CASE WHEN date = {target} - 7 THEN weekly_sales END) AS lag_1_sales,
                         max(CASE WHEN date = {target} - 364 THEN weekly_sales END) AS sales_last_year,
                         avg(CASE WHEN date >= {target} - 28 THEN weekly_sales END) AS rolling_4_wk_sales_avg
                  FROM k{h - 1} GROUP BY store, dept),
            p{h} AS (SELECT store, dept, CAST({target} AS DATE) AS date, {WEIGHTS} AS weekly_sales FROM f{h}),
            k{h} AS (SELECT * FROM k{h - 1} UNION ALL SELECT * FROM p{h})"""
        )
    steps = " UNION ALL ".join(
        f"SELECT store, dept, date, CAST({h} AS INTEGER) AS horizon, round(weekly_sales + {OFF_TIES}, 4) AS prediction FROM p{h}" for h in range(1, weeks + 1)
    )
    return "WITH " + ", ".join(known) + " " + steps


@query("forecast_recursive_fixed", recursion_sql(4))
def forecast_recursive_fixed(spark, sf_dir):
    """Four weeks, each from the ones before, with fixed weights in place of a fit."""
    fixed = PipelineModel([SQLTransformer(statement=f"SELECT *, {WEIGHTS} AS prediction FROM __THIS__")])
    found = forecast.recursive(fixed, panel(spark, sf_dir).stored_gold, 4)
    return rounded(found.withColumn("prediction", F.col("prediction") + OFF_TIES), 4)


@query("forecast_random_forest")
def forecast_random_forest(spark, sf_dir):
    return tested(spark, sf_dir, "random_forest")


@query("forecast_gbt")
def forecast_gbt(spark, sf_dir):
    return tested(spark, sf_dir, "boosting")


STATISTICS = ["store_type", "month", "isholiday"]


@query(
    "ordered_target_statistics",
    "SELECT store, dept, date, "
    + ", ".join(
        f"""(CAST(coalesce(sum(CAST(weekly_sales AS DECIMAL(18, 2))) OVER {c}_before, 0) AS DOUBLE) + CAST(1000 * 2 AS DOUBLE))
            / CAST(count(weekly_sales) OVER {c}_before + 2 AS DOUBLE) AS {c}_stat"""
        for c in STATISTICS
    )
    + " FROM gold WINDOW "
    + ", ".join(
        f"""{c}_before AS (PARTITION BY {c} ORDER BY md5(store || '|' || dept || '|' || date)
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
        for c in STATISTICS
    ),
)
def ordered_target_statistics(spark, sf_dir):
    """Sums of cents are exact, so the quotients are equal without rounding."""
    gold = panel(spark, sf_dir).stored_gold
    rows = gold.select(*KEYS, *STATISTICS, F.col("weekly_sales").cast("decimal(18,2)").alias("y"))
    found = boosting.ordered_statistics(rows, STATISTICS, "y", KEYS, prior=1000.0, weight=2.0)
    return found.drop(*STATISTICS, "y")


@query("forecast_leafwise")
def forecast_leafwise(spark, sf_dir):
    """Boosting that splits the best leaf next."""
    return tested(spark, sf_dir, "leafwise")


@query("forecast_ordered")
def forecast_ordered(spark, sf_dir):
    """Symmetric trees on ordered target statistics."""
    return tested(spark, sf_dir, "ordered")


@query("forecast_fit_score")
def forecast_fit_score(spark, sf_dir):
    """Refit on train and validation weeks, evaluated on test next to the baseline."""
    _, _, test = parts(spark, sf_dir)
    naive = metrics.forecast_metrics(test, predicted="sales_last_year")
    return tested(spark, sf_dir, "boosting").unionByName(labelled_metrics(naive, "same_week_last_year"))


@query("forecast_importances")
def forecast_importances(spark, sf_dir):
    train, _, _ = parts(spark, sf_dir)
    return forecast.importances(fitted(spark, sf_dir, "random_forest"), train)


@query("batch_score")
def batch_score(spark, sf_dir):
    """Saved model, loaded again, over the newest 1,000 rows, through the CSV export."""
    gold = panel(spark, sf_dir).stored_gold
    model = forecast.saved_and_loaded(fitted(spark, sf_dir, "boosting"), gold)
    path = scratch_path(spark, "forecast-csv")
    tables.write_csv(forecast.score(model, forecast.live_window(gold, 1000)), path)
    schema = "store int, dept int, date date, weekly_sales double, predicted_weekly_sales double"
    return tables.read_csv(spark, path, schema)


def searched(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    return _once(spark, sf_dir, "search", lambda: forecast.search(train, val, draws=4))


@query("hyperparam_search")
def hyperparam_search(spark, sf_dir):
    """Four draws of the default space (50 to 1,000 trees), halved twice."""
    return searched(spark, sf_dir)


@query("champion_gates")
def champion_gates(spark, sf_dir):
    """Search, selection, refit and the deployment gates at their default limits. The
    selection takes any error, as no model of the derived panel is below the default."""
    _, gates = forecast.champion(searched(spark, sf_dir), *parts(spark, sf_dir), max_wmape=float("inf"))
    return gates


@query("drift_model_predictions")
def drift_model_predictions(spark, sf_dir):
    """Drift of the target and of the forest's predictions, training against test weeks."""
    train, _, test = parts(spark, sf_dir)
    model = fitted(spark, sf_dir, "random_forest", "train")
    sides = [
        forecast.predict(model, side).select(F.col("weekly_sales").alias("target"), "prediction")
        for side in (train, test)
    ]
    return rounded(drift.numeric(*sides, ["target", "prediction"]), 6)


@query("forecast_permutation_importance")
def forecast_permutation_importance(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    columns = gold_ops.NUMERIC + gold_ops.CATEGORICAL
    return explain.permutation_importance(fitted(spark, sf_dir, "random_forest", "train"), val, columns, KEYS)


@query("forecast_shapley")
def forecast_shapley(spark, sf_dir):
    """Attributions for the first holiday row and the first ordinary row."""
    train, _, _ = parts(spark, sf_dir)
    columns = gold_ops.NUMERIC + gold_ops.CATEGORICAL
    first = F.min(F.struct(*KEYS, *[c for c in columns if c not in KEYS]))
    rows = train.groupBy("isholiday").agg(first.alias("r")).select("r.*")
    return explain.shapley(fitted(spark, sf_dir, "random_forest", "train"), rows, train, columns, KEYS)


@query("forecast_tree_attribution")
def forecast_tree_attribution(spark, sf_dir):
    """How much each column moves the log forecasts of the test weeks, over all rows,
    against all training weeks."""
    train, _, test = parts(spark, sf_dir)
    found = attribution.tree_attribution(fitted(spark, sf_dir, "leafwise"), test, train, KEYS)
    return found.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"), F.avg("attribution").alias("mean"))


def fixed_tree_sql() -> str:
    """Expected values of a three-split tree for all four coalitions of two features."""

    def worth(a: bool, b: bool) -> str:
        low = "CASE WHEN a <= 500 THEN 2.0 ELSE -1.0 END" if a else "(3.0 * p3 - 1.0)"
        split = f"CASE WHEN b <= 0 THEN {low} ELSE 4.0 END" if b else f"(p2 * {low} + (1.0 - p2) * 4.0)"
        return f"CASE WHEN a <= 0 THEN 1.0 ELSE {split} END" if a else f"(p0 + (1.0 - p0) * {split})"

    none, a, b, both = worth(False, False), worth(True, False), worth(False, True), worth(True, True)
    return f"""WITH g AS (SELECT store, dept, date, CAST(coalesce(lag_1_sales, 0) AS DOUBLE) AS a, CAST(coalesce(sales_last_year, 0) AS DOUBLE) AS b FROM gold),
            p AS (SELECT count(*) FILTER (a <= 0) / count(*) AS p0, count(*) FILTER (a > 0 AND b <= 0) / count(*) FILTER (a > 0) AS p2,
                         count(*) FILTER (a > 0 AND b <= 0 AND a <= 500) / count(*) FILTER (a > 0 AND b <= 0) AS p3 FROM g),
            w AS (SELECT store, dept, date, {none} AS v0, {a} AS va, {b} AS vb, {both} AS vab FROM g, p),
            f AS (SELECT *, 'lag_1_sales' AS feature, ((va - v0) + (vab - vb)) / 2 AS phi FROM w
                  UNION ALL SELECT *, 'sales_last_year', ((vb - v0) + (vab - va)) / 2 FROM w)
       SELECT store, dept, date, feature, round(phi + {OFF_TIES}, 6) AS attribution, round(v0 + {OFF_TIES}, 6) AS base_value,
              round(vab + {OFF_TIES}, 6) AS score FROM f"""


@query("tree_attribution_fixed", fixed_tree_sql())
def tree_attribution_fixed(spark, sf_dir):
    """Attribution of every gold row by a given tree, in which one feature splits twice."""
    of = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    names = ["lag_1_sales", "sales_last_year"]
    rows = panel(spark, sf_dir).stored_gold.select(*KEYS, F.array(*[of(c) for c in names]).alias("x"))
    tree = boosting.Tree(feature=[0, -1, 1, 0, -1, -1, -1], bin=[0] * 7, cut=[0.0, 0.0, 0.0, 500.0, 0.0, 0.0, 0.0],
                         left=[1, 0, 3, 5, 0, 0, 0], right=[2, 0, 4, 6, 0, 0, 0], value=[0.0, 1.0, 0.0, 0.0, 4.0, 2.0, -1.0])
    model = boosting.TreesModel(trees=boosting.as_json([tree], 0.0))
    found = attribution.attributed(rows, rows, attribution.ensemble_of(model, spark), KEYS, names)
    off = {c: F.col(c) + OFF_TIES for c in ("attribution", "base_value", "score")}
    return rounded(found.withColumns(off), 6)


@query("forecast_recursive_4wk")
def forecast_recursive_4wk(spark, sf_dir):
    model = fitted(spark, sf_dir, "boosting", "train+val+test")
    return forecast.recursive(model, panel(spark, sf_dir).stored_gold, 4)
