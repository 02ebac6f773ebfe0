"""Profiling queries.

Means of amounts in cents can fall on a rounding tie; they are rounded to seven
digits first, on both sides, so the order of summation cannot decide the tie.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from weekgrid.functions import correlation
from weekgrid.functions.columns import lenient_double, normalise_columns, numeric_names, rounded, truncate_to_long
from weekgrid.operators import profiling
from weekgrid.plans.registry import query
from weekgrid.plans.shared import panel
from weekgrid.sources.panel import Panel, table

MARKDOWNS = [f"markdown{i}" for i in range(1, 6)]
MEASURES = ["weekly_sales", "temperature", "fuel_price", "cpi", "unemployment", "total_markdown"]


def _union(template: str, names: list[str]) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in names)


def typed_features(spark, sf_dir):
    """Raw indicators with numbers read leniently and nothing filled."""
    raw = normalise_columns(panel(spark, sf_dir).bronze_features)
    return raw.select(
        "store", F.to_date("date", "dd/MM/yyyy").alias("date"), "temperature", "fuel_price",
        *[lenient_double(F.col(c)).alias(c) for c in [*MARKDOWNS, "cpi", "unemployment"]], "isholiday",
    )


TYPED = "typed_features AS (SELECT CAST(store AS INTEGER) AS store, date, temperature, fuel_price, " + ", ".join(
    f"try_cast({c} AS DOUBLE) AS {c}" for c in [*MARKDOWNS, "cpi", "unemployment"]
) + ", isholiday FROM raw_features)"


@query(
    "profile_schema",
    f"WITH {TYPED} "
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null FROM typed_features"
        for c, t in [
            ("store", "int"), ("date", "date"), ("temperature", "double"), ("fuel_price", "double"),
            *[(m, "double") for m in MARKDOWNS], ("cpi", "double"), ("unemployment", "double"),
            ("isholiday", "boolean"),
        ]
    ),
)
def profile_schema(spark, sf_dir):
    return profiling.schema(typed_features(spark, sf_dir))


FEATURE_NAMES = ["store", "date", "temperature", "fuel_price", *MARKDOWNS, "cpi", "unemployment", "isholiday"]


@query(
    "profile_missing",
    f"WITH {TYPED} "
    + _union(
        "SELECT '{c}' AS column, count(*) - count({c}) AS null_count,"
        " round(100.0 * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM typed_features",
        FEATURE_NAMES,
    ),
)
def profile_missing(spark, sf_dir):
    return rounded(profiling.missing(typed_features(spark, sf_dir)), 6)


def _corr_sql(a: str, b: str, source: str) -> str:
    spread = (
        f"nullif(stddev_pop({a}) FILTER ({b} IS NOT NULL) * stddev_pop({b}) FILTER ({a} IS NOT NULL), 0)"
    )
    return f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}) / {spread}, 6) AS score FROM {source}"


NULLABLE = [*MARKDOWNS, "cpi", "unemployment"]


@query(
    "profile_null_corr",
    f"WITH {TYPED}, flags AS (SELECT "
    + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in NULLABLE)
    + " FROM typed_features) SELECT * FROM ("
    + "\nUNION ALL\n".join(_corr_sql(a, b, "flags") for a, b in combinations(NULLABLE, 2))
    + ") WHERE score IS NOT NULL",
)
def profile_null_corr(spark, sf_dir):
    return rounded(profiling.null_correlation(typed_features(spark, sf_dir), NULLABLE), 6)


@query(
    "profile_null_range",
    f"""WITH {TYPED}
        SELECT 'markdowns' AS what, min(date) AS first_date, max(date) AS last_date, count(*) AS n
        FROM typed_features WHERE markdown1 IS NULL AND markdown2 IS NULL AND markdown3 IS NULL
             AND markdown4 IS NULL AND markdown5 IS NULL
        UNION ALL
        SELECT 'macro', min(date), max(date), count(*)
        FROM typed_features WHERE cpi IS NULL AND unemployment IS NULL""",
)
def profile_null_range(spark, sf_dir):
    df = typed_features(spark, sf_dir)

    def spell(names, label):
        missing = " AND ".join(f"{c} IS NULL" for c in names)
        return df.where(missing).agg(
            F.lit(label).alias("what"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.count("*").alias("n"),
        )

    return spell(MARKDOWNS, "markdowns").unionByName(spell(["cpi", "unemployment"], "macro"))


@query(
    "profile_summary",
    _union(
        """SELECT '{c}' AS column, count({c}) AS n, round(round(avg({c}), 7), 4) AS mean,
                  round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
                  round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
                  round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM gold""",
        MEASURES,
    ),
)
def profile_summary(spark, sf_dir):
    found = profiling.summary(panel(spark, sf_dir).stored_gold, MEASURES)
    return rounded(rounded(found, 7, ["mean"]), 4)


@query(
    "profile_categorical",
    _union(
        """SELECT '{c}' AS column, sum(k)::BIGINT AS n, count(*) AS distinct_values,
                  first(v ORDER BY k DESC, v) AS top, max(k) AS freq
           FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM gold GROUP BY 1)""",
        ["store_type", "dept", "month", "isholiday"],
    ),
)
def profile_categorical(spark, sf_dir):
    return profiling.categorical(
        panel(spark, sf_dir).stored_gold, ["store_type", "dept", "month", "isholiday"]
    )


@query(
    "profile_duplicates",
    """SELECT l_orderkey, l_linenumber, l_returnflag, count(*) - 1 AS extra_copies
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def profile_duplicates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return profiling.duplicates(lines)


CARD = ["store", "dept", "date", "store_type", "isholiday", "month", "week_of_year"]


@query(
    "profile_cardinality",
    _union("SELECT '{c}' AS column, count(DISTINCT {c}) AS distinct_values FROM gold", CARD),
)
def profile_cardinality(spark, sf_dir):
    return profiling.cardinality(panel(spark, sf_dir).stored_gold, CARD)


SKEWED = ["weekly_sales", "sales_log", "total_markdown", "fuel_price", "unemployment"]


@query(
    "profile_skew",
    _union("SELECT '{c}' AS column, round(skewness({c}), 6) AS skew FROM gold", SKEWED),
)
def profile_skew(spark, sf_dir):
    return rounded(profiling.skewness(panel(spark, sf_dir).stored_gold, SKEWED), 6)


@query(
    "profile_histogram",
    """WITH e AS (SELECT min(weekly_sales) AS lo, max(weekly_sales) AS hi FROM gold)
       SELECT CAST(least(floor((weekly_sales - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin,
              round(min(lo) + least(floor((weekly_sales - lo) / ((hi - lo) / 50)), 49) * ((max(hi) - min(lo)) / 50), 4)
                  AS bin_start,
              count(*) AS n
       FROM gold, e GROUP BY least(floor((weekly_sales - lo) / ((hi - lo) / 50)), 49)""",
)
def profile_histogram(spark, sf_dir):
    return rounded(profiling.histogram(panel(spark, sf_dir).stored_gold, "weekly_sales"), 4)


OUT = ["weekly_sales", "total_markdown", "unemployment"]


@query(
    "profile_outliers_iqr",
    _union(
        """SELECT '{c}' AS column, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
                  round(q1 - 1.5 * (q3 - q1), 4) AS lower, round(q3 + 1.5 * (q3 - q1), 4) AS upper,
                  (SELECT count(*) FROM gold WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))
                      AS n_outliers
           FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                        quantile_cont({c}, 0.75) AS q3 FROM gold)""",
        OUT,
    ),
)
def profile_outliers_iqr(spark, sf_dir):
    return rounded(profiling.outliers(panel(spark, sf_dir).stored_gold, OUT), 4)


# --- group summaries ---------------------------------------------------------


@query(
    "macro_weekly_total",
    "SELECT date, CAST(floor(round(sum(weekly_sales), 2)) AS BIGINT) AS total_weekly_sales FROM sales GROUP BY date",
)
def macro_weekly_total(spark, sf_dir):
    sales = Panel(spark, sf_dir, reuse=False).silver_sales
    return sales.groupBy("date").agg(truncate_to_long(F.sum("weekly_sales")).alias("total_weekly_sales"))


@query(
    "sales_by_month",
    """SELECT CAST(month(date) AS INTEGER) AS month, round(round(avg(weekly_sales), 7), 4) AS mean_sales
       FROM sales GROUP BY 1 ORDER BY 1""",
)
def sales_by_month(spark, sf_dir):
    sales = Panel(spark, sf_dir, reuse=False).silver_sales
    means = sales.groupBy(F.month("date").alias("month")).agg(F.avg("weekly_sales").alias("mean_sales"))
    return rounded(rounded(means, 7), 4).orderBy("month")


@query(
    "seasonality_by_week",
    """SELECT week_of_year, round(round(avg(weekly_sales), 7), 4) AS mean_sales,
              round(round(avg(total_markdown), 7), 4) AS mean_markdown FROM gold GROUP BY week_of_year""",
)
def seasonality_by_week(spark, sf_dir):
    means = panel(spark, sf_dir).stored_gold.groupBy("week_of_year").agg(
        F.avg("weekly_sales").alias("mean_sales"), F.avg("total_markdown").alias("mean_markdown")
    )
    return rounded(rounded(means, 7), 4)


@query(
    "macro_sales_fuel",
    """SELECT date, round(sum(weekly_sales), 2) AS total_sales, round(avg(fuel_price), 6) AS mean_fuel
       FROM gold GROUP BY date""",
)
def macro_sales_fuel(spark, sf_dir):
    return panel(spark, sf_dir).stored_gold.groupBy("date").agg(
        F.round(F.sum("weekly_sales"), 2).alias("total_sales"),
        F.round(F.avg("fuel_price"), 6).alias("mean_fuel"),
    )


@query(
    "holiday_lift",
    """WITH m AS (SELECT avg(weekly_sales) AS base FROM gold WHERE isholiday = 0)
       SELECT isholiday, round(round(avg(weekly_sales), 7), 4) AS mean_sales, count(*) AS n,
              round(quantile_cont(weekly_sales, 0.5), 4) AS median_sales,
              round(100.0 * (avg(weekly_sales) - max(base)) / max(base), 6) AS lift_pct
       FROM gold, m GROUP BY isholiday""",
)
def holiday_lift(spark, sf_dir):
    lift = profiling.lift_by_flag(panel(spark, sf_dir).stored_gold, "isholiday", "weekly_sales")
    lift = rounded(rounded(lift, 7, ["mean_sales"]), 4, ["mean_sales", "median_sales"])
    return rounded(lift, 6, ["lift_pct"])


@query(
    "sales_by_date_interval",
    """SELECT date, round(round(avg(weekly_sales), 7), 4) AS mean,
              round(avg(weekly_sales) - 1.96 * stddev_samp(weekly_sales) / sqrt(count(*)), 4) AS low,
              round(avg(weekly_sales) + 1.96 * stddev_samp(weekly_sales) / sqrt(count(*)), 4) AS high,
              count(*) AS n FROM gold GROUP BY date""",
)
def sales_by_date_interval(spark, sf_dir):
    found = profiling.mean_interval(panel(spark, sf_dir).stored_gold, "date", "weekly_sales")
    return rounded(rounded(found, 7, ["mean"]), 4)


# --- correlation -------------------------------------------------------------

CORRELATED = [
    "weekly_sales", "sales_last_year", "rolling_4_wk_sales_avg", "temperature", "fuel_price", "cpi",
    "unemployment", "total_markdown", "store_size",
]


@query(
    "corr_matrix_long",
    "\nUNION ALL\n".join(_corr_sql(a, b, "gold") for a, b in combinations(CORRELATED, 2)),
)
def corr_matrix_long(spark, sf_dir):
    gold = panel(spark, sf_dir).stored_gold
    return rounded(correlation.pair_correlations(gold, CORRELATED), 6)


@query(
    "corr_numeric_columns",
    "\nUNION ALL\n".join(_corr_sql(a, b, "gold") for a, b in combinations(["weekly_sales", "temperature", "cpi", "sales_last_year"], 2)),
)
def corr_numeric_columns(spark, sf_dir):
    """Columns chosen by type: the date and the store type are left out."""
    some = panel(spark, sf_dir).stored_gold.select("date", "weekly_sales", "store_type", "temperature", "cpi", "sales_last_year")
    return rounded(correlation.pair_correlations(some, numeric_names(some)), 6)


LATE = ["weekly_sales", *MARKDOWNS]


@query(
    "corr_markdown_after_date",
    "WITH late AS (SELECT * FROM gold WHERE date > DATE '1998-01-01') "
    + "\nUNION ALL\n".join(_corr_sql(a, b, "late") for a, b in combinations(LATE, 2)),
)
def corr_markdown_after_date(spark, sf_dir):
    gold = panel(spark, sf_dir).stored_gold.where(F.col("date") > F.lit("1998-01-01").cast("date"))
    return rounded(correlation.pair_correlations(gold, LATE), 6)


TARGETED = [
    "lag_1_log", "lag_5_log", "lag_52_log", "rolling_4_wk_log_sales_avg", "temperature", "fuel_price",
    "cpi", "unemployment", "total_markdown", "store_size", "sin_week", "cos_week",
]


@query(
    "target_corr_ranking",
    _union(
        """SELECT '{c}' AS column, round(covar_pop(sales_log, {c}) /
                  nullif(stddev_pop(sales_log) FILTER ({c} IS NOT NULL) * stddev_pop({c}), 0), 6) AS score
           FROM gold""",
        TARGETED,
    ),
)
def target_corr_ranking(spark, sf_dir):
    gold = panel(spark, sf_dir).stored_gold
    return rounded(correlation.target_correlations(gold, "sales_log", TARGETED), 6)
