"""Affinity, segmentation, anomaly and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekgrid.functions.columns import rounded, storage_types
from weekgrid.operators import affinity, anomaly, drift, segments, splits
from weekgrid.operators import gold as gold_ops
from weekgrid.plans.registry import query
from weekgrid.plans.shared import panel
from weekgrid.sources.panel import DEPTS, table

# --- department affinity -----------------------------------------------------

RESID = "resid AS (SELECT store, dept, date, weekly_sales - sales_last_year AS residual_sales FROM warm)"
PIVOT = "SELECT store, date, " + ", ".join(
    f"coalesce(max(residual_sales) FILTER (dept = {d}), 0) AS dept_{d}" for d in DEPTS
) + " FROM resid GROUP BY store, date"
PAIRS = "\nUNION ALL\n".join(
    f"SELECT {a}::BIGINT AS department_a, {b}::BIGINT AS department_b, corr(dept_{a}, dept_{b}) AS correlation_score FROM basket"
    for a in DEPTS
    for b in DEPTS
    if a < b
)


@query("residual_sales", f"WITH {RESID} SELECT store, dept, date, round(residual_sales, 2) AS residual_sales FROM resid")
def residual_sales(spark, sf_dir):
    resid = affinity.residuals(panel(spark, sf_dir).stored_gold)
    return rounded(resid.select("store", "dept", "date", "residual_sales"), 2)


@query(
    "basket_pivot",
    f"WITH {RESID}, basket AS ({PIVOT}) SELECT store, date, "
    + ", ".join(f"round(dept_{d}, 2) AS dept_{d}" for d in DEPTS)
    + " FROM basket",
)
def basket_pivot(spark, sf_dir):
    resid = affinity.residuals(panel(spark, sf_dir).stored_gold)
    return rounded(affinity.basket_matrix(resid, DEPTS), 2)


@query(
    "basket_unpivot",
    f"WITH {RESID}, basket AS ({PIVOT}) SELECT store, date, dept, round(residual_sales, 2) AS residual_sales"
    " FROM basket UNPIVOT (residual_sales FOR dept IN (" + ", ".join(f"dept_{d}" for d in DEPTS) + "))",
)
def basket_unpivot(spark, sf_dir):
    resid = affinity.residuals(panel(spark, sf_dir).stored_gold)
    names = [f"dept_{d}" for d in DEPTS]
    long = affinity.basket_matrix(resid, DEPTS).unpivot(["store", "date"], names, "dept", "residual_sales")
    return rounded(long, 2)


@query(
    "market_basket_pairs",
    f"""WITH {RESID}, basket AS ({PIVOT})
        SELECT department_a, department_b, round(correlation_score, 6) AS correlation_score FROM ({PAIRS})""",
)
def market_basket_pairs(spark, sf_dir):
    return rounded(affinity.pair_scores(affinity.residuals(panel(spark, sf_dir).stored_gold)), 6)


@query(
    "market_basket_rules",
    f"""WITH {RESID}, basket AS ({PIVOT})
        SELECT department_a, department_b, round(correlation_score, 6) AS correlation_score
        FROM ({PAIRS}) WHERE correlation_score > 0.0 ORDER BY correlation_score DESC""",
)
def market_basket_rules(spark, sf_dir):
    return rounded(affinity.rules(panel(spark, sf_dir).stored_gold, min_score=0.0), 6)


@query(
    "market_basket_rules_by_year",
    """WITH yearly AS (SELECT year(date) AS y, store, sum(weekly_sales - sales_last_year) AS v
                      FROM gold WHERE sales_last_year IS NOT NULL GROUP BY ALL),
            years AS (SELECT DISTINCT y FROM yearly), shops AS (SELECT DISTINCT store FROM yearly),
            full_grid AS (SELECT years.y, shops.store, coalesce(v, 0) AS v
                          FROM years CROSS JOIN shops LEFT JOIN yearly USING (y, store))
       SELECT a.store AS department_a, b.store AS department_b, round(corr(a.v, b.v), 6) AS correlation_score
       FROM full_grid a JOIN full_grid b ON a.y = b.y AND a.store < b.store
       GROUP BY ALL HAVING corr(a.v, b.v) > 0.6""",
)
def market_basket_rules_by_year(spark, sf_dir):
    """The default threshold of 0.6 on stores and years: a year is the basket."""
    resid = affinity.residuals(panel(spark, sf_dir).stored_gold)
    yearly = resid.groupBy(F.lit(0).alias("store"), F.year("date").alias("date"), F.col("store").alias("dept")).agg(
        F.sum("residual_sales").alias("residual_sales")
    )
    return rounded(affinity.pair_scores(yearly, 0.6), 6)


# --- store segments ----------------------------------------------------------

PROFILES = """profiles AS (
    SELECT store, avg(weekly_sales) AS avg_weekly_sales, max(store_size) AS store_size,
           avg(coalesce(total_markdown, 0)) AS avg_weekly_markdown FROM gold GROUP BY store)"""


def scaled_sql(c):
    return f"({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0) AS {c}_scaled"


SCALED = f"""{PROFILES}, scaled AS (SELECT *, {", ".join(scaled_sql(c) for c in segments.FEATURES)} FROM profiles)"""


@query(
    "store_profiles",
    f"""WITH {PROFILES} SELECT store, round(round(avg_weekly_sales, 7), 4) AS avg_weekly_sales, store_size,
        round(round(avg_weekly_markdown, 7), 4) AS avg_weekly_markdown FROM profiles""",
)
def store_profiles(spark, sf_dir):
    return rounded(rounded(segments.profiles(panel(spark, sf_dir).stored_gold), 7), 4)


@query(
    "store_profiles_scaled",
    f"WITH {SCALED} SELECT store, "
    + ", ".join(f"round({c}_scaled, 6) AS {c}_scaled" for c in segments.FEATURES)
    + " FROM scaled",
)
def store_profiles_scaled(spark, sf_dir):
    scaled = segments.standardised(segments.profiles(panel(spark, sf_dir).stored_gold))
    return rounded(scaled.select("store", *[f"{c}_scaled" for c in segments.FEATURES]), 6)


@query("store_segments")
def store_segments(spark, sf_dir):
    return segments.archetypes(segments.kmeans(segments.profiles(panel(spark, sf_dir).stored_gold)))


@query("store_segment_centers")
def store_segment_centers(spark, sf_dir):
    return segments.centres(segments.kmeans(segments.profiles(panel(spark, sf_dir).stored_gold)))


@query("store_elbow")
def store_elbow(spark, sf_dir):
    return segments.elbow(segments.profiles(panel(spark, sf_dir).stored_gold))


DISTANCE = "sqrt(" + " + ".join(f"(a.{c}_scaled - b.{c}_scaled) ^ 2" for c in segments.FEATURES) + ")"


@query(
    "store_silhouette",
    f"""WITH {SCALED}, p AS (SELECT scaled.*, type AS cluster FROM scaled JOIN stores USING (store)),
        d AS (SELECT a.store, a.cluster, b.cluster AS near, sum({DISTANCE}) AS total, count(*) AS members
              FROM p a CROSS JOIN p b GROUP BY 1, 2, 3),
        f AS (SELECT store, cluster, max(members) FILTER (near = cluster) AS size,
                     max(total / nullif(members - 1, 0)) FILTER (near = cluster) AS a,
                     min(total / members) FILTER (near <> cluster) AS b FROM d GROUP BY 1, 2)
        SELECT store, cluster,
               round(CASE WHEN size = 1 THEN 0.0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END, 6) AS silhouette
        FROM f""",
)
def store_silhouette(spark, sf_dir):
    """Silhouette of the store types as fixed clusters."""
    p = panel(spark, sf_dir)
    scaled = segments.standardised(segments.profiles(p.stored_gold))
    typed = scaled.join(p.silver_stores.select("store", F.col("type").alias("cluster")), "store")
    names = [f"{c}_scaled" for c in segments.FEATURES]
    return rounded(segments.silhouette(typed, "store", names, "cluster"), 6)


@query("store_segment_silhouette")
def store_segment_silhouette(spark, sf_dir):
    clustered = segments.kmeans(segments.profiles(panel(spark, sf_dir).stored_gold))
    names = [f"{c}_scaled" for c in segments.FEATURES]
    return segments.silhouette(clustered, "store", names, "cluster").agg(
        F.count("*").alias("stores"), F.avg("silhouette").alias("silhouette")
    )


# --- anomalies ---------------------------------------------------------------


@query(
    "anomaly_ratios",
    "SELECT store, dept, date, " + ", ".join(f"round({c}, 6) AS {c}" for c in anomaly.RATIOS) + " FROM ratios",
)
def anomaly_ratios(spark, sf_dir):
    found = anomaly.ratios(panel(spark, sf_dir).stored_gold)
    return rounded(found.select("store", "dept", "date", *anomaly.RATIOS), 6)


@query(
    "holiday_miss",
    """SELECT store, dept, date, weekly_sales, round(trend_deviation_ratio, 6) AS trend_deviation_ratio
       FROM ratios WHERE isholiday = 1 AND trend_deviation_ratio < 1.0""",
)
def holiday_miss(spark, sf_dir):
    misses = anomaly.holiday_misses(anomaly.ratios(panel(spark, sf_dir).stored_gold))
    shown = misses.select("store", "dept", "date", "weekly_sales", "trend_deviation_ratio")
    return rounded(shown, 6)


LITERAL_TREES = [
    # feature, threshold, left, right, depth of each node; leaves point to themselves
    [(0, 1.0, 1, 2, 0.0), (1, 0.5, 3, 4, 0.0), (0, 0.0, 2, 2, 1.5), (0, 0.0, 3, 3, 2.0), (0, 0.0, 4, 4, 3.25)],
    [(1, 1.2, 1, 2, 0.0), (0, 0.0, 1, 1, 1.0), (0, 2.0, 3, 4, 0.0), (0, 0.0, 3, 3, 2.5), (0, 0.0, 4, 4, 2.0)],
]


@query(
    "isolation_scores",
    f"""SELECT store, dept, date, round(pow(2, -(
            CASE WHEN coalesce({anomaly.RATIOS[0]}, 0) <= 1.0
                 THEN CASE WHEN coalesce({anomaly.RATIOS[1]}, 0) <= 0.5 THEN 2.0 ELSE 3.25 END ELSE 1.5 END
          + CASE WHEN coalesce({anomaly.RATIOS[1]}, 0) <= 1.2
                 THEN 1.0 ELSE CASE WHEN coalesce({anomaly.RATIOS[0]}, 0) <= 2.0 THEN 2.5 ELSE 2.0 END END)
          / (2 * (2 * (ln(7.0) + 0.5772156649015329) - 2 * 7.0 / 8))), 9) AS anomaly_score
        FROM ratios""",
)
def isolation_scores(spark, sf_dir):
    """Scores of two written-out trees of a sample of eight."""
    forest = anomaly.literal_forest(anomaly.RATIOS[:2], LITERAL_TREES, 8)
    scored = forest.score(anomaly.ratios(panel(spark, sf_dir).stored_gold))
    return rounded(scored.select("store", "dept", "date", "anomaly_score"), 9)


@query("anomaly_flags")
def anomaly_flags(spark, sf_dir):
    return anomaly.report(anomaly.flag(anomaly.ratios(panel(spark, sf_dir).stored_gold)))


# --- drift -------------------------------------------------------------------

NUMERIC = gold_ops.NUMERIC
CATEGORICAL = gold_ops.CATEGORICAL


def numeric_sql(c, source="splits", ref="split = 'train'", cur="split = 'test'"):
    return f"""
    SELECT '{c}' AS "column",
           CASE WHEN count(*) <= 5 THEN 'jensen_shannon' ELSE 'wasserstein' END AS method,
           CASE WHEN count(*) <= 5
                THEN sqrt(greatest(sum(CASE WHEN p > 0 THEN 0.5 * p * ln(2 * p / (p + q)) ELSE 0 END
                                     + CASE WHEN q > 0 THEN 0.5 * q * ln(2 * q / (p + q)) ELSE 0 END), 0))
                ELSE sum(abs(fp - fq) * coalesce(nxt - v, 0)) / greatest(max(sd), 0.001) END AS score
    FROM (SELECT v, p, q, sd, sum(p) OVER (ORDER BY v) AS fp, sum(q) OVER (ORDER BY v) AS fq,
                 lead(v) OVER (ORDER BY v) AS nxt
          FROM (SELECT CAST({c} AS DOUBLE) AS v,
                       count(*) FILTER ({ref}) / (SELECT count({c}) FROM {source} WHERE {ref}) AS p,
                       count(*) FILTER ({cur}) / (SELECT count({c}) FROM {source} WHERE {cur}) AS q,
                       (SELECT stddev_pop({c}) FROM {source} WHERE {ref}) AS sd
                FROM {source} WHERE ({ref} OR {cur}) AND {c} IS NOT NULL GROUP BY 1))"""


def categorical_sql(c, source="splits", ref="split = 'train'", cur="split = 'test'"):
    return f"""
    SELECT '{c}' AS "column", 'jensen_shannon' AS method,
           sqrt(greatest(sum(CASE WHEN p > 0 THEN 0.5 * p * ln(2 * p / (p + q)) ELSE 0 END
                           + CASE WHEN q > 0 THEN 0.5 * q * ln(2 * q / (p + q)) ELSE 0 END), 0)) AS score
    FROM (SELECT {c}, count(*) FILTER ({ref}) / (SELECT count(*) FROM {source} WHERE {ref}) AS p,
                 count(*) FILTER ({cur}) / (SELECT count(*) FROM {source} WHERE {cur}) AS q
          FROM {source} WHERE {ref} OR {cur} GROUP BY 1)"""


NUMERIC_SQL = "\nUNION ALL\n".join(numeric_sql(c) for c in NUMERIC)
CATEGORICAL_SQL = "\nUNION ALL\n".join(categorical_sql(c) for c in CATEGORICAL)
SCORES = "SELECT \"column\", method, round(score, 6) AS score, score >= 0.1 AS drifted FROM ({})"


def drift_rows(spark, sf_dir):
    """Training weeks (side 0) and test weeks (side 1); validation weeks have no side."""
    labelled = splits.chronological(splits.drop_warmup(panel(spark, sf_dir).stored_gold))
    return labelled.withColumn("side", F.when(F.col("split") == "train", 0).when(F.col("split") == "test", 1))


def drift_sides(spark, sf_dir):
    """Training weeks against test weeks."""
    labelled = splits.chronological(splits.drop_warmup(panel(spark, sf_dir).stored_gold))
    train, _, test = splits.parts(labelled)
    return train, test


@query("drift_numeric", SCORES.format(NUMERIC_SQL))
def drift_numeric(spark, sf_dir):
    return rounded(drift.numeric(*drift_sides(spark, sf_dir), NUMERIC), 6)


@query("drift_categorical", SCORES.format(CATEGORICAL_SQL))
def drift_categorical(spark, sf_dir):
    return rounded(drift.categorical(*drift_sides(spark, sf_dir), CATEGORICAL), 6)


@query(
    "drift_report",
    f"""WITH scores AS ({NUMERIC_SQL} UNION ALL {CATEGORICAL_SQL})
        SELECT count(*) AS n_columns, count(*) FILTER (score >= 0.1) AS n_drifted,
               round(count(*) FILTER (score >= 0.1) / count(*), 6) AS drift_share,
               CASE WHEN count(*) FILTER (score >= 0.1) / count(*) >= 0.5 THEN 'critical'
                    WHEN count(*) FILTER (score >= 0.1) / count(*) >= 0.3 THEN 'warning' ELSE 'ok' END AS severity
        FROM scores""",
)
def drift_report(spark, sf_dir):
    every = drift.columns_report(drift_rows(spark, sf_dir), NUMERIC, CATEGORICAL)
    return rounded(drift.report(every), 6)


def chi_sql(c, source, ref, cur):
    """Chi-square statistic, or the squared z of two proportions, with its tail from gamma functions."""
    return f"""
    SELECT '{c}' AS "column", CASE WHEN k = 2 THEN 'proportion' ELSE 'chi_square' END AS method, statistic,
           CASE WHEN k = 1 OR statistic <= 0 THEN 1.0
                WHEN isinf(statistic) OR statistic / 2 > a + 12 * sqrt(a) + 60 THEN 0.0
                ELSE greatest(0, 1 - list_sum(list_transform(range(0, CAST(ceil(greatest(statistic / 2 - a, 0) + 12 * sqrt(statistic / 2 + a) + 60) AS BIGINT)),
                     lambda i: exp((a + i) * ln(statistic / 2) - statistic / 2 - lgamma(a + i + 1))))) END AS p
    FROM (SELECT k, (CASE WHEN k = 2 THEN 1 ELSE k - 1 END) / 2.0 AS a,
                 CASE WHEN k = 2 THEN z ELSE chi END AS statistic
          FROM (SELECT count(*) AS k,
                       sum(CASE WHEN r > 0 THEN (u - r * m / n) ** 2 / (r * m / n) WHEN u > 0 THEN 'inf'::DOUBLE ELSE 0 END) AS chi,
                       max((r / n - u / m) ** 2 / nullif(((r + u) / (n + m)) * (1 - (r + u) / (n + m)) * (1 / n + 1 / m), 0)) AS z
                FROM (SELECT {c}, CAST(count(*) FILTER ({ref}) AS DOUBLE) AS r, CAST(count(*) FILTER ({cur}) AS DOUBLE) AS u,
                             (SELECT CAST(count({c}) AS DOUBLE) FROM {source} WHERE {ref}) AS n,
                             (SELECT CAST(count({c}) AS DOUBLE) FROM {source} WHERE {cur}) AS m
                      FROM {source} WHERE ({ref} OR {cur}) AND {c} IS NOT NULL GROUP BY 1)))"""


def ks_sql(c, source, ref, cur):
    return f"""
    SELECT '{c}' AS "column", 'kolmogorov_smirnov' AS method, d AS statistic,
           CASE WHEN z2 < 0.04 THEN 1.0
                ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
                     lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * z2))), 0), 1) END AS p
    FROM (SELECT d, d * d * n * m / (n + m) AS z2
          FROM (SELECT max(abs(fr / n - fu / m)) AS d, max(n) AS n, max(m) AS m
                FROM (SELECT CAST(sum(r) OVER (ORDER BY v) AS DOUBLE) AS fr, CAST(sum(u) OVER (ORDER BY v) AS DOUBLE) AS fu,
                             (SELECT CAST(count({c}) AS DOUBLE) FROM {source} WHERE {ref}) AS n,
                             (SELECT CAST(count({c}) AS DOUBLE) FROM {source} WHERE {cur}) AS m
                      FROM (SELECT CAST({c} AS DOUBLE) AS v, count(*) FILTER ({ref}) AS r, count(*) FILTER ({cur}) AS u
                            FROM {source} WHERE ({ref} OR {cur}) AND {c} IS NOT NULL GROUP BY 1))))"""


def tests_sql(numeric, categorical, source="splits", ref="split = 'train'", cur="split = 'test'"):
    few = f"(SELECT count(DISTINCT {{0}}) FROM {source} WHERE {ref} OR {cur}) <= 5"
    parts = [f"SELECT * FROM ({ks_sql(c, source, ref, cur)}) WHERE NOT {few.format(c)}" for c in numeric]
    parts += [f"SELECT * FROM ({chi_sql(c, source, ref, cur)}) WHERE {few.format(c)}" for c in numeric]
    parts += [chi_sql(c, source, ref, cur) for c in categorical]
    return """SELECT "column", method, round(p, 6) AS score, p < 0.05 AS drifted, round(statistic, 6) AS statistic
              FROM (""" + "\nUNION ALL\n".join(parts) + ")"


TESTED = ["weekly_sales", "lag_1_sales", "sales_last_year", "temperature", "fuel_price", "store_size", "isholiday"]
TESTED_CATEGORIES = ["store_type", "month", "store"]


@query("drift_tests", tests_sql(TESTED, TESTED_CATEGORIES))
def drift_tests(spark, sf_dir):
    """Two-sample tests of training against test weeks, over all rows."""
    return rounded(drift.tests(drift_rows(spark, sf_dir), TESTED, TESTED_CATEGORIES), 6)


BEFORE, AFTER = "ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'"
EVENT_SIDES = "(SELECT *, user_id % 2 AS half, user_id % 7 AS seventh FROM events)"


@query("drift_tests_events", tests_sql(["value", "user_id", "half"], ["event_type", "seventh"], EVENT_SIDES, BEFORE, AFTER))
def drift_tests_events(spark, sf_dir):
    """Two-sample tests of the first half of the month's events against the second."""
    events = table(spark, sf_dir, "events").withColumns({"half": F.col("user_id") % 2, "seventh": F.col("user_id") % 7})
    half = F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    rows = events.withColumn("side", F.when(F.col("ts") < half, 0).when(F.col("ts") >= half, 1))
    return rounded(drift.tests(rows, ["value", "user_id", "half"], ["event_type", "seventh"]), 6)


@query(
    "drift_target",
    "WITH s AS (SELECT *, weekly_sales AS target, rolling_4_wk_sales_avg AS prediction FROM splits) "
    + SCORES.format("\nUNION ALL\n".join(numeric_sql(c, "s") for c in ("target", "prediction"))),
)
def drift_target(spark, sf_dir):
    """Drift of the target and of the four-week-mean forecast."""
    train, test = (
        side.select(
            F.col("weekly_sales").alias("target"), F.col("rolling_4_wk_sales_avg").alias("prediction")
        )
        for side in drift_sides(spark, sf_dir)
    )
    return rounded(drift.numeric(train, test, ["target", "prediction"]), 6)


@query(
    "drift_events",
    SCORES.format(
        numeric_sql("value", "events", "ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'")
        + "\nUNION ALL\n"
        + categorical_sql("event_type", "events", "ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'")
    ),
)
def drift_events(spark, sf_dir):
    """First half of the month's events against the second."""
    events = table(spark, sf_dir, "events")
    half = F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    before, after = events.where(F.col("ts") < half), events.where(F.col("ts") >= half)
    found = drift.numeric(before, after, ["value"]).unionByName(
        drift.categorical(before, after, ["event_type"])
    )
    return rounded(found, 6)


@query(
    "drift_sample",
    """SELECT CAST(store AS DOUBLE) AS store, CAST(dept AS DOUBLE) AS dept, date, CAST(isholiday AS VARCHAR) AS isholiday, weekly_sales
       FROM splits WHERE split = 'train' ORDER BY md5('42|' || store || '|' || dept || '|' || date) LIMIT 5000""",
)
def drift_sample(spark, sf_dir):
    train, _ = drift_sides(spark, sf_dir)
    drawn = drift.sample(train.select("store", "dept", "date", "isholiday", "weekly_sales"), 5000, ["store", "dept", "date"])
    return storage_types(drawn, ["isholiday"])
