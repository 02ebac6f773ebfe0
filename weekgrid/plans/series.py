"""Time-series diagnostics of the network total and of every store."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekgrid.functions.columns import rounded
from weekgrid.operators import timeseries
from weekgrid.plans.registry import query
from weekgrid.plans.shared import panel

NETWORK = """network AS (
    SELECT date, ln(sum(weekly_sales) + 1) AS y, row_number() OVER (ORDER BY date) AS t
    FROM gold GROUP BY date)"""


def network(spark, sf_dir):
    return timeseries.network_series(panel(spark, sf_dir).stored_gold)


@query(
    "seasonal_decompose",
    f"""WITH {NETWORK}, tr AS (
          SELECT a.date, a.t, a.y,
                 CASE WHEN count(b.y) = 53 THEN sum(b.y * CASE WHEN abs(a.t - b.t) = 26 THEN 0.5 ELSE 1.0 END) / 52 END
                     AS trend
          FROM network a JOIN network b ON abs(a.t - b.t) <= 26 GROUP BY a.date, a.t, a.y),
        ph AS (SELECT (t - 1) % 52 AS p, avg(y - trend) AS raw FROM tr GROUP BY 1),
        se AS (SELECT p, raw - (SELECT avg(raw) FROM ph) AS seasonal FROM ph)
        SELECT 'network' AS series, date, round(y, 6) AS observed, round(trend, 6) AS trend,
               round(seasonal, 6) AS seasonal, round(y - trend - seasonal, 6) AS resid
        FROM tr JOIN se ON (t - 1) % 52 = p""",
)
def seasonal_decompose(spark, sf_dir):
    return rounded(timeseries.decompose(network(spark, sf_dir), ["series"], "total_log"), 6)


@query(
    "seasonal_decompose_by_store",
    """WITH s AS (
          SELECT store, date, sum(weekly_sales) AS y, row_number() OVER (PARTITION BY store ORDER BY date) AS t
          FROM gold GROUP BY store, date),
        tr AS (
          SELECT a.store, a.date, a.t, a.y,
                 CASE WHEN count(b.y) = 53 THEN sum(b.y * CASE WHEN abs(a.t - b.t) = 26 THEN 0.5 ELSE 1.0 END) / 52 END
                     AS trend
          FROM s a JOIN s b ON a.store = b.store AND abs(a.t - b.t) <= 26 GROUP BY a.store, a.date, a.t, a.y),
        ph AS (SELECT store, (t - 1) % 52 AS p, avg(y - trend) AS raw FROM tr GROUP BY 1, 2),
        se AS (SELECT store, p, raw - avg(raw) OVER (PARTITION BY store) AS seasonal FROM ph)
        SELECT tr.store, date, round(y, 6) AS observed, round(trend, 6) AS trend,
               round(seasonal, 6) AS seasonal, round(y - trend - seasonal, 6) AS resid
        FROM tr JOIN se ON tr.store = se.store AND (t - 1) % 52 = p""",
)
def seasonal_decompose_by_store(spark, sf_dir):
    totals = panel(spark, sf_dir).stored_gold.groupBy("store", "date").agg(F.sum("weekly_sales").alias("y"))
    return rounded(timeseries.decompose(totals, ["store"], "y"), 6)


@query("adf_residuals")
def adf_residuals(spark, sf_dir):
    parts = timeseries.decompose(network(spark, sf_dir), ["series"], "total_log")
    return timeseries.unit_root(parts, ["series"], "resid")


@query("adf_by_store")
def adf_by_store(spark, sf_dir):
    totals = panel(spark, sf_dir).stored_gold.groupBy("store", "date").agg(F.sum("weekly_sales").alias("y"))
    parts = timeseries.decompose(totals, ["store"], "y")
    return timeseries.unit_root(parts, ["store"], "resid")


@query(
    "unit_root_lag0_by_store",
    """WITH y AS (SELECT store, date, sum(weekly_sales) AS y FROM gold GROUP BY ALL),
            d AS (SELECT store, lag(y) OVER (PARTITION BY store ORDER BY date) AS x,
                         y - lag(y) OVER (PARTITION BY store ORDER BY date) AS dy FROM y),
            r AS (SELECT store, count(x) AS n, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy
                  FROM d GROUP BY store)
       SELECT store, CAST(0 AS INTEGER) AS lags, CAST(n AS INTEGER) AS n,
              round(b / sqrt((syy - b * b * sxx) / (n - 2) / sxx), 6) AS statistic
       FROM r""",
)
def unit_root_lag0_by_store(spark, sf_dir):
    """The unit-root statistic without lagged differences, a plain regression."""
    totals = panel(spark, sf_dir).stored_gold.groupBy("store", "date").agg(F.sum("weekly_sales").alias("y"))
    found = timeseries.unit_root(totals, ["store"], "y", max_lag=0)
    return rounded(found.select("store", "lags", "n", "statistic"), 6)


ACF = f"""WITH {NETWORK}, c AS (SELECT t, y - (SELECT avg(y) FROM network) AS d FROM network)
    SELECT 'network' AS series, CAST(k AS INTEGER) AS lag,
           round(coalesce(sum(a.d * b.d), 0) / (SELECT sum(d * d) FROM c), 6) AS acf
    FROM (SELECT unnest(range(61)) AS k) lags
    JOIN c a ON true JOIN c b ON b.t = a.t - k GROUP BY k"""


@query("acf_60", ACF)
def acf_60(spark, sf_dir):
    return rounded(timeseries.autocorrelation(network(spark, sf_dir), ["series"], "total_log"), 6)


PACF = f"""WITH RECURSIVE {NETWORK}, c AS (SELECT t, y - (SELECT avg(y) FROM network) AS d FROM network),
    acf AS (SELECT k, coalesce(sum(a.d * b.d), 0) / (SELECT sum(d * d) FROM c) AS r
            FROM (SELECT unnest(range(61)) AS k) lags JOIN c a ON true JOIN c b ON b.t = a.t - k GROUP BY k),
    rr AS (SELECT list(r ORDER BY k) AS r FROM acf),
    step AS (
      SELECT 1 AS k, [r[2]] AS phi, 1 - r[2] * r[2] AS v, r[2] AS pacf, r FROM rr
      UNION ALL
      SELECT k + 1,
             list_append(list_transform(range(1, k + 1),
                         lambda i: phi[i] - (r[k + 2] - list_dot_product(phi, list_reverse(r[2:k + 1]))) / v * phi[k + 1 - i]),
                         (r[k + 2] - list_dot_product(phi, list_reverse(r[2:k + 1]))) / v),
             v * (1 - ((r[k + 2] - list_dot_product(phi, list_reverse(r[2:k + 1]))) / v) ^ 2),
             (r[k + 2] - list_dot_product(phi, list_reverse(r[2:k + 1]))) / v, r
      FROM step WHERE k < 60)
    SELECT 'network' AS series, CAST(k AS INTEGER) AS lag, round(pacf, 6) AS pacf FROM step
    UNION ALL SELECT 'network', 0, 1.0"""


@query("pacf_60", PACF)
def pacf_60(spark, sf_dir):
    acf = timeseries.autocorrelation(network(spark, sf_dir), ["series"], "total_log")
    return rounded(timeseries.partial_autocorrelation(acf, ["series"]), 6)


@query(
    "ccf_fuel_sales",
    """WITH m AS (SELECT date, avg(fuel_price) AS x, sum(weekly_sales) AS y FROM gold GROUP BY date),
       c AS (SELECT row_number() OVER (ORDER BY date) AS t, x - avg(x) OVER () AS x, y - avg(y) OVER () AS y FROM m)
       SELECT 'network' AS series, CAST(k AS INTEGER) AS lag,
              round(sum(a.x * b.y) / (SELECT sqrt(sum(x * x) * sum(y * y)) FROM c), 6) AS ccf,
              round(1.96 / sqrt((SELECT count(*) FROM c)), 6) AS band
       FROM (SELECT unnest(range(13)) AS k) lags JOIN c a ON true JOIN c b ON b.t = a.t - k GROUP BY k""",
)
def ccf_fuel_sales(spark, sf_dir):
    weekly = panel(spark, sf_dir).stored_gold.groupBy("date").agg(
        F.avg("fuel_price").alias("fuel"), F.sum("weekly_sales").alias("total")
    )
    named = weekly.withColumn("series", F.lit("network"))
    return rounded(timeseries.cross_correlation(named, ["series"], "fuel", "total"), 6)


BY_STORE = """s AS (
          SELECT store, date, sum(weekly_sales) AS y, avg(fuel_price) AS x FROM gold GROUP BY store, date),
        c AS (
          SELECT store, row_number() OVER (PARTITION BY store ORDER BY date) AS t,
                 y - avg(y) OVER (PARTITION BY store) AS y, x - avg(x) OVER (PARTITION BY store) AS x FROM s),
        scale AS (SELECT store, sum(y * y) AS yy, sum(x * x) AS xx, count(*) AS n FROM c GROUP BY store)"""
ACF_BY_STORE = f"""{BY_STORE},
        acf AS (
          SELECT a.store, k, coalesce(sum(a.y * b.y), 0) / nullif(any_value(yy), 0) AS r
          FROM (SELECT unnest(range(61)) AS k) lags JOIN c a ON true JOIN scale ON scale.store = a.store
          LEFT JOIN c b ON b.store = a.store AND b.t = a.t - k GROUP BY a.store, k)"""


def by_store(spark, sf_dir):
    return panel(spark, sf_dir).stored_gold.groupBy("store", "date").agg(
        F.sum("weekly_sales").alias("y"), F.avg("fuel_price").alias("fuel")
    )


@query(
    "acf_60_by_store",
    f"WITH {ACF_BY_STORE} SELECT store, CAST(k AS INTEGER) AS lag, round(r, 6) AS acf FROM acf",
)
def acf_60_by_store(spark, sf_dir):
    return rounded(timeseries.autocorrelation(by_store(spark, sf_dir), ["store"], "y"), 6)


@query(
    "pacf_60_by_store",
    f"""WITH RECURSIVE {ACF_BY_STORE},
    rr AS (SELECT store, list(r ORDER BY k) AS r FROM acf GROUP BY store),
    step AS (
      SELECT store, 1 AS k, [r[2]] AS phi, 1 - r[2] * r[2] AS v, r[2] AS pacf, r FROM rr
      UNION ALL
      SELECT store, k + 1,
             list_append(list_transform(range(1, k + 1), lambda i: phi[i] - p * phi[k + 1 - i]), p),
             v * (1 - p ^ 2), p, r
      FROM (SELECT *, (r[k + 2] - list_dot_product(phi, list_reverse(r[2:k + 1]))) / v AS p FROM step) WHERE k < 60)
    SELECT store, CAST(k AS INTEGER) AS lag, round(pacf, 6) AS pacf FROM step
    UNION ALL SELECT store, 0, 1.0 FROM rr""",
)
def pacf_60_by_store(spark, sf_dir):
    acf = timeseries.autocorrelation(by_store(spark, sf_dir), ["store"], "y")
    return rounded(timeseries.partial_autocorrelation(acf, ["store"]), 6)


@query(
    "ccf_fuel_sales_by_store",
    f"""WITH {BY_STORE}
        SELECT a.store, CAST(k AS INTEGER) AS lag,
               round(coalesce(sum(a.x * b.y), 0) / nullif(sqrt(any_value(xx) * any_value(yy)), 0), 6) AS ccf,
               round(1.96 / sqrt(any_value(n)), 6) AS band
        FROM (SELECT unnest(range(13)) AS k) lags JOIN c a ON true JOIN scale ON scale.store = a.store
        LEFT JOIN c b ON b.store = a.store AND b.t = a.t - k GROUP BY a.store, k""",
)
def ccf_fuel_sales_by_store(spark, sf_dir):
    return rounded(timeseries.cross_correlation(by_store(spark, sf_dir), ["store"], "fuel", "y"), 6)
