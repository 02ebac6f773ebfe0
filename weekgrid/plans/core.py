"""Queries over the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekgrid.functions import calendar, columns
from weekgrid.functions.trailing import series, trailing_max, trailing_mean, trailing_std
from weekgrid.operators import clean, forecast, grid, splits
from weekgrid.operators import gold as gold_ops
from weekgrid.plans.registry import query
from weekgrid.plans.shared import panel
from weekgrid.session import scratch_path
from weekgrid.sources import tables
from weekgrid.sources.panel import Panel, table

EXACT = {
    "store", "dept", "date", "isholiday", "store_type", "store_size", "month", "week_of_year",
    "is_original_row",
}


def sql_rounded(names, digits=6):
    return ", ".join(n if n in EXACT else f"round({n}, {digits}) AS {n}" for n in names)


# --- sources and sinks -------------------------------------------------------

BRONZE_TEXT = """
    SELECT CAST(store AS INTEGER) AS "Store", CAST(dept AS INTEGER) AS "Dept",
           strftime(date, '%d/%m/%Y') AS "Date", weekly_sales AS "Weekly_Sales",
           isholiday AS "IsHoliday"
    FROM raw_sales"""


@query("bronze_csv_roundtrip", BRONZE_TEXT)
def bronze_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw-sales-csv")
    tables.write_csv(panel(spark, sf_dir).bronze_sales, path)
    return tables.read_csv(spark, path)


@query(
    "bronze_csv_null_text",
    """SELECT CAST(store AS INTEGER) AS store, date,
              CASE WHEN markdown3 = 'NA' THEN NULL ELSE CAST(markdown3 AS DOUBLE) END AS markdown3,
              CASE WHEN cpi = 'NA' THEN NULL ELSE CAST(cpi AS DOUBLE) END AS cpi
       FROM raw_features""",
)
def bronze_csv_null_text(spark, sf_dir):
    path = scratch_path(spark, "raw-features-csv")
    raw = panel(spark, sf_dir).bronze_features
    tables.write_csv(raw, path)
    schema = "Store int, Date string, Temperature double, Fuel_Price double, MarkDown1 double," \
        " MarkDown2 double, MarkDown3 double, MarkDown4 double, MarkDown5 double, CPI double," \
        " Unemployment double, IsHoliday boolean"
    back = columns.normalise_columns(tables.read_csv(spark, path, schema, null_text="NA"))
    return back.select(
        "store", calendar.parse_date(F.col("date"), lenient=False).alias("date"), "markdown3", "cpi"
    )


@query("bronze_partitioned_write", BRONZE_TEXT)
def bronze_partitioned_write(spark, sf_dir):
    path = scratch_path(spark, "bronze-sales")
    tables.write_table(panel(spark, sf_dir).bronze_sales, path, ["Store"])
    return tables.read_table(spark, path)


@query(
    "bronze_sql_path_scan",
    """SELECT CAST(dept AS INTEGER) AS dept, count(*) AS n FROM raw_sales GROUP BY dept""",
)
def bronze_sql_path_scan(spark, sf_dir):
    path = scratch_path(spark, "bronze-sales")
    tables.write_table(panel(spark, sf_dir).bronze_sales, path)
    tables.read_sql(spark, path, "Dept AS dept").createOrReplaceTempView("bronze_depts")
    return spark.sql("SELECT dept, count(*) AS n FROM bronze_depts GROUP BY dept")


@query("silver_named_table", "SELECT store, dept, date, weekly_sales FROM sales")
def silver_named_table(spark, sf_dir):
    """Create or replace, then create only if absent, read by another session."""
    name, shown = "weekgrid_silver_sales", ["store", "dept", "date", "weekly_sales"]
    sales = panel(spark, sf_dir).silver_sales.select(shown)
    tables.create_table(sales.limit(1), name, scratch_path(spark, "named"))
    tables.create_table(sales, name, scratch_path(spark, "named"))
    tables.create_table(sales.limit(1), name, replace=False)
    return spark.newSession().table(name)


@query("gold_parquet_roundtrip", f"SELECT {sql_rounded(gold_ops.COLUMNS)} FROM gold")
def gold_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gold-table")
    tables.write_table(panel(spark, sf_dir).gold, path, order_by=["date", "store", "dept"])
    return columns.rounded(tables.read_table(spark, path), 6)


@query(
    "csv_export_roundtrip",
    """SELECT store, dept, date, round(weekly_sales, 2) AS weekly_sales,
              round(sales_last_year, 2) AS sales_last_year FROM warm""",
)
def csv_export_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "kpi-csv")
    view = splits.drop_warmup(panel(spark, sf_dir).stored_gold).select(
        "store", "dept", "date", "weekly_sales", "sales_last_year"
    )
    tables.write_csv(view, path)
    schema = "store int, dept int, date date, weekly_sales double, sales_last_year double"
    return columns.rounded(tables.read_csv(spark, path, schema), 2)


@query(
    "snapshot_version_as_of",
    """SELECT CAST(store AS INTEGER) AS store, CAST(dept AS INTEGER) AS dept, date, weekly_sales
       FROM raw_sales""",
)
def snapshot_version_as_of(spark, sf_dir):
    path = scratch_path(spark, "sales-versions")
    p = panel(spark, sf_dir)
    shown = ["store", "dept", "date", "weekly_sales"]
    tables.write_snapshot(p.sales.select(shown), path, 0, "2024-01-01 00:00:00")
    tables.write_snapshot(p.silver_sales.select(shown), path, 1, "2024-02-01 00:00:00")
    return tables.read_snapshot(spark, path, 0)


@query("snapshot_latest", "SELECT store, dept, date, weekly_sales FROM sales")
def snapshot_latest(spark, sf_dir):
    path = scratch_path(spark, "sales-versions")
    p = panel(spark, sf_dir)
    shown = ["store", "dept", "date", "weekly_sales"]
    tables.write_snapshot(p.sales.select(shown), path, 0, "2024-01-01 00:00:00")
    tables.write_snapshot(p.silver_sales.select(shown), path, 1, "2024-02-01 00:00:00")
    return tables.read_snapshot(spark, path)


@query(
    "snapshot_timestamp_as_of",
    """SELECT CAST(store AS INTEGER) AS store, CAST(dept AS INTEGER) AS dept, date, weekly_sales
       FROM raw_sales""",
)
def snapshot_timestamp_as_of(spark, sf_dir):
    path = scratch_path(spark, "sales-versions")
    p = panel(spark, sf_dir)
    shown = ["store", "dept", "date", "weekly_sales"]
    tables.write_snapshot(p.sales.select(shown), path, 0, "2024-01-01 00:00:00")
    tables.write_snapshot(p.silver_sales.select(shown), path, 1, "2024-02-01 00:00:00")
    return tables.read_snapshot(spark, path, as_of="2024-01-15 00:00:00")


# --- silver ------------------------------------------------------------------


@query(
    "silver_rename",
    """SELECT CAST(store AS INTEGER) AS store, strftime(date, '%d/%m/%Y') AS date, temperature,
              round(fuel_price, 4) AS fuel_price, markdown1, markdown2, markdown3, markdown4, markdown5,
              cpi, unemployment, isholiday FROM raw_features""",
)
def silver_rename(spark, sf_dir):
    return columns.rounded(columns.normalise_columns(panel(spark, sf_dir).bronze_features), 4)


@query(
    "silver_sales_dedup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
              l_discount, l_returnflag
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                         l_discount DESC, l_returnflag DESC) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def silver_sales_dedup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag",
    )
    return clean.first_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


@query("silver_sales_clean", "SELECT * FROM sales")
def silver_sales_clean(spark, sf_dir):
    return Panel(spark, sf_dir, reuse=False).silver_sales


FEATURE_COLUMNS = """store, date, temperature, round(fuel_price, 4) AS fuel_price,
    markdown1, markdown2, markdown3, markdown4, markdown5, cpi, unemployment, isholiday"""


@query("silver_features_clean", f"SELECT {FEATURE_COLUMNS} FROM features")
def silver_features_clean(spark, sf_dir):
    return columns.rounded(panel(spark, sf_dir).silver_features, 4, ["fuel_price"])


@query("silver_stores_clean", "SELECT * FROM stores")
def silver_stores_clean(spark, sf_dir):
    return panel(spark, sf_dir).silver_stores


@query(
    "silver_macro_ffill",
    "SELECT store, date, cpi, unemployment FROM features",
)
def silver_macro_ffill(spark, sf_dir):
    return panel(spark, sf_dir).silver_features.select("store", "date", "cpi", "unemployment")


@query(
    "silver_master_inner",
    """SELECT s.store, s.dept, s.date, s.weekly_sales, s.isholiday, t.type, t.size, f.temperature,
              round(f.fuel_price, 4) AS fuel_price, f.cpi, f.unemployment
       FROM sales s JOIN stores t ON s.store = t.store
                    JOIN features f ON s.store = f.store AND s.date = f.date""",
)
def silver_master_inner(spark, sf_dir):
    p = panel(spark, sf_dir)
    markdowns = [f"markdown{i}" for i in range(1, 6)]
    joined = (
        p.silver_sales.join(p.silver_features.drop("isholiday", *markdowns), ["store", "date"])
        .join(p.silver_stores, "store")
    )
    return columns.rounded(joined, 4, ["fuel_price"])


# --- gold --------------------------------------------------------------------


@query("gold_calendar", "SELECT date FROM weeks")
def gold_calendar(spark, sf_dir):
    return grid.calendar(Panel(spark, sf_dir, reuse=False).sales)


@query(
    "gold_calendar_anchored",
    """SELECT CAST(unnest(generate_series(d0 + CAST((12 - isodow(d0)) % 7 AS INTEGER), d1, INTERVAL 7 DAYS)) AS DATE) AS date
       FROM (SELECT CAST(min(l_shipdate) AS DATE) AS d0, CAST(max(l_shipdate) AS DATE) AS d1 FROM lineitem)""",
)
def gold_calendar_anchored(spark, sf_dir):
    ends = table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi")
    )
    return ends.select(F.explode(calendar.anchored_spine(F.col("lo"), F.col("hi"))).alias("date"))


@query("gold_scaffold", "SELECT * FROM scaffold")
def gold_scaffold(spark, sf_dir):
    return grid.scaffold(panel(spark, sf_dir).silver_sales, ["store", "dept"])


MERGED = [
    "store", "dept", "date", "weekly_sales", "isholiday", "store_type", "store_size", "temperature",
    "fuel_price", "cpi", "unemployment", "markdown1", "markdown2", "markdown3", "markdown4", "markdown5",
    "total_markdown", "is_original_row",
]


@query("gold_merged", f"SELECT {sql_rounded(MERGED, 4)} FROM merged")
def gold_merged(spark, sf_dir):
    p = panel(spark, sf_dir)
    full = gold_ops.sales_grid(p.silver_sales)
    merged = gold_ops.merge_context(full, p.silver_features, p.silver_stores)
    return columns.rounded(merged.select(*MERGED), 4)


CALENDAR = ["store", "dept", "date", "month", "week_of_year", "sin_week", "cos_week"]


@query("gold_calendar_features", f"SELECT {sql_rounded(CALENDAR, 9)} FROM gold")
def gold_calendar_features(spark, sf_dir):
    keys = grid.scaffold(panel(spark, sf_dir).silver_sales, ["store", "dept"])
    return columns.rounded(gold_ops.with_calendar(keys).select(*CALENDAR), 9)


@query("gold_log_target", "SELECT store, dept, date, round(sales_log, 9) AS sales_log FROM gold")
def gold_log_target(spark, sf_dir):
    full = gold_ops.sales_grid(panel(spark, sf_dir).silver_sales)
    log = columns.log_plus_one(F.col("weekly_sales"))
    return full.select("store", "dept", "date", F.round(log, 9).alias("sales_log"))


LAGS = [
    "store", "dept", "date", "lag_1_log", "lag_5_log", "lag_52_log", "lag_1_sales", "lag_5_sales",
    "sales_last_year",
]
ROLLING = ["store", "dept", "date", "rolling_4_wk_log_sales_avg", "rolling_4_wk_sales_avg"]


@query("gold_lags", f"SELECT {sql_rounded(LAGS)} FROM gold")
def gold_lags(spark, sf_dir):
    full = gold_ops.sales_grid(panel(spark, sf_dir).silver_sales)
    return columns.rounded(gold_ops.with_lags(full).select(*LAGS), 6)


@query("gold_rolling", f"SELECT {sql_rounded(ROLLING)} FROM gold")
def gold_rolling(spark, sf_dir):
    full = gold_ops.sales_grid(panel(spark, sf_dir).silver_sales)
    return columns.rounded(gold_ops.with_lags(full).select(*ROLLING), 6)


@query("gold_cpi_lag", "SELECT store, date, cpi, cpi_lag_3_month FROM features_lagged")
def gold_cpi_lag(spark, sf_dir):
    lagged = gold_ops.with_macro_lag(panel(spark, sf_dir).silver_features)
    return lagged.select("store", "date", "cpi", "cpi_lag_3_month")


@query("gold_obt", f"SELECT {sql_rounded(gold_ops.COLUMNS)} FROM gold")
def gold_obt(spark, sf_dir):
    return columns.rounded(Panel(spark, sf_dir).gold, 6)


@query(
    "gold_storage_types",
    """SELECT CAST(store AS VARCHAR) AS store, CAST(dept AS VARCHAR) AS dept, date,
              CAST(isholiday AS VARCHAR) AS isholiday, store_type,
              CAST(store_size AS DOUBLE) AS store_size, CAST(month AS VARCHAR) AS month,
              CAST(week_of_year AS VARCHAR) AS week_of_year FROM gold""",
)
def gold_storage_types(spark, sf_dir):
    shown = ["store", "dept", "date", "isholiday", "store_type", "store_size", "month", "week_of_year"]
    return columns.storage_types(panel(spark, sf_dir).stored_gold.select(shown), gold_ops.CATEGORICAL)


@query(
    "warmup_drop",
    "SELECT store, dept, date, weekly_sales, sales_last_year FROM warm",
)
def warmup_drop(spark, sf_dir):
    warm = splits.drop_warmup(panel(spark, sf_dir).stored_gold)
    return warm.select("store", "dept", "date", "weekly_sales", "sales_last_year")


@query(
    "scaffold_features_observed",
    """WITH f AS (
         SELECT store, dept, date, weekly_sales, is_original_row,
                lag(weekly_sales, 1) OVER w AS sales_lag_1,
                CASE WHEN count(weekly_sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) = 4
                     THEN avg(weekly_sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) END
                     AS rolling_4wk_avg
         FROM merged WINDOW w AS (PARTITION BY store, dept ORDER BY date))
       SELECT store, dept, date, weekly_sales, sales_lag_1, round(rolling_4wk_avg, 6) AS rolling_4wk_avg
       FROM f WHERE is_original_row""",
)
def scaffold_features_observed(spark, sf_dir):
    full = gold_ops.sales_grid(panel(spark, sf_dir).silver_sales)
    w, sales = series(["store", "dept"]), F.col("weekly_sales")
    features = full.withColumns(
        {
            "sales_lag_1": F.lag(sales).over(w),
            "rolling_4wk_avg": F.round(trailing_mean(sales, w, 4, needed=4), 6),
        }
    )
    return features.where("is_original_row").drop("is_original_row", "isholiday")


@query(
    "rolling_full_window",
    """SELECT store, dept, date,
              CASE WHEN count(weekly_sales) OVER f = 4 THEN round(avg(weekly_sales) OVER f, 6) END
                  AS rolling_4wk_avg
       FROM sales WINDOW f AS (PARTITION BY store, dept ORDER BY date
                               ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
)
def rolling_full_window(spark, sf_dir):
    mean = trailing_mean(F.col("weekly_sales"), series(["store", "dept"]), 4, needed=4)
    return panel(spark, sf_dir).silver_sales.select(
        "store", "dept", "date", F.round(mean, 6).alias("rolling_4wk_avg")
    )


@query(
    "rolling_stats",
    """WITH g AS (SELECT store, dept, date, ln(weekly_sales + 1) AS x FROM merged)
       SELECT store, dept, date,
              round(avg(x) OVER f4, 6) AS rolling_4wk_mean,
              CASE WHEN count(x) OVER f4 = 4 THEN round(stddev_samp(x) OVER f4, 6) END AS rolling_4wk_std,
              round(max(x) OVER f12, 6) AS rolling_12wk_max
       FROM g
       WINDOW f4 AS (PARTITION BY store, dept ORDER BY date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
              f12 AS (PARTITION BY store, dept ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)""",
)
def rolling_stats(spark, sf_dir):
    full = gold_ops.sales_grid(panel(spark, sf_dir).silver_sales)
    w, x = series(["store", "dept"]), columns.log_plus_one(F.col("weekly_sales"))
    stats = full.select(
        "store",
        "dept",
        "date",
        trailing_mean(x, w, 4).alias("rolling_4wk_mean"),
        trailing_std(x, w, 4, needed=4).alias("rolling_4wk_std"),
        trailing_max(x, w, 12).alias("rolling_12wk_max"),
    )
    return columns.rounded(stats, 6)


@query(
    "gap_audit",
    """SELECT store, dept, date, days_since_previous FROM (
         SELECT store, dept, date,
                CAST(datediff('day', lag(date) OVER (PARTITION BY store, dept ORDER BY date), date) AS INTEGER)
                    AS days_since_previous
         FROM sales) WHERE days_since_previous <> 7""",
)
def gap_audit(spark, sf_dir):
    return grid.gaps(panel(spark, sf_dir).silver_sales, ["store", "dept"])


@query(
    "live_feature_window",
    """SELECT store, dept, date, weekly_sales, round(rolling_4_wk_sales_avg, 6) AS rolling_4_wk_sales_avg
       FROM gold WHERE sales_last_year IS NOT NULL AND cpi_lag_3_month IS NOT NULL
       ORDER BY date DESC, store DESC, dept DESC LIMIT 1000""",
)
def live_feature_window(spark, sf_dir):
    live = forecast.live_window(panel(spark, sf_dir).stored_gold, 1000)
    shown = live.select("store", "dept", "date", "weekly_sales", "rolling_4_wk_sales_avg")
    return columns.rounded(shown, 6)


@query(
    "holiday_mask",
    """SELECT CAST(isholiday AS VARCHAR) IN ('1', '1.0', 'True', 'true') AS holiday, count(*) AS n,
              min(date) AS first_date, first(store ORDER BY date, store, dept) AS store,
              first(dept ORDER BY date, store, dept) AS dept
       FROM warm GROUP BY 1""",
)
def holiday_mask(spark, sf_dir):
    warm = splits.drop_warmup(panel(spark, sf_dir).stored_gold)
    holiday = F.col("isholiday").cast("string").isin("1", "1.0", "True", "true")
    first = F.min(F.struct("date", "store", "dept"))
    return (
        warm.groupBy(holiday.alias("holiday"))
        .agg(F.count("*").alias("n"), first.alias("first"))
        .select("holiday", "n", F.col("first.date").alias("first_date"), "first.store", "first.dept")
    )


# --- splits ------------------------------------------------------------------


@query("split_boundaries", "SELECT b1, b2 FROM split_bounds")
def split_boundaries(spark, sf_dir):
    return splits.boundaries(splits.drop_warmup(panel(spark, sf_dir).stored_gold))


@query("split_chronological", "SELECT store, dept, date, weekly_sales, split FROM splits")
def split_chronological(spark, sf_dir):
    """Written one directory per part and read back."""
    path = scratch_path(spark, "splits")
    warm = splits.drop_warmup(panel(spark, sf_dir).stored_gold)
    labelled = splits.chronological(warm).select("store", "dept", "date", "weekly_sales", "split")
    tables.write_table(labelled, path, ["split"])
    return tables.read_table(spark, path)


@query(
    "split_counts",
    """SELECT split, count(*) AS n, min(date) AS first_date, max(date) AS last_date
       FROM splits GROUP BY split""",
)
def split_counts(spark, sf_dir):
    labelled = splits.chronological(splits.drop_warmup(panel(spark, sf_dir).stored_gold))
    return labelled.groupBy("split").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query(
    "split_two_way",
    """WITH q AS (SELECT quantile_cont(datediff('day', DATE '1970-01-01', date)::DOUBLE, 0.8) AS d FROM warm)
       SELECT CASE WHEN datediff('day', DATE '1970-01-01', date) < d THEN 'train' ELSE 'test' END AS split,
              count(*) AS n, min(date) AS first_date, max(date) AS last_date
       FROM warm, q GROUP BY 1""",
)
def split_two_way(spark, sf_dir):
    labelled = splits.two_way(splits.drop_warmup(panel(spark, sf_dir).stored_gold))
    return labelled.groupBy("split").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query(
    "train_val_union",
    """SELECT store, dept, date, weekly_sales FROM splits WHERE split = 'train'
       UNION ALL SELECT store, dept, date, weekly_sales FROM splits WHERE split = 'val'""",
)
def train_val_union(spark, sf_dir):
    labelled = splits.chronological(splits.drop_warmup(panel(spark, sf_dir).stored_gold))
    train, val, _ = splits.parts(labelled.select("store", "dept", "date", "weekly_sales", "split"))
    return train.unionByName(val)
