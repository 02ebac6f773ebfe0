"""SQL definitions of the panel tables, written independently of the DataFrame code.

Each entry may refer to the entries above it. ``with_tables`` puts those a
query needs in front of it as common table expressions.
"""

from __future__ import annotations

import re

MARKDOWN_NAMES = [f"markdown{i}" for i in range(1, 6)]


def _each(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(i=i) for i in range(1, 6))


TABLES: dict[str, str] = {
    "order_lines": """
        SELECT c_nationkey + 1 AS store,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
                    WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS dept,
               CAST(date_trunc('week', o_orderdate) AS DATE) + 4 AS date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CAST(l_discount AS DECIMAL(6,4)) AS disc,
               l_returnflag, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN customer ON o_custkey = c_custkey""",
    "raw_sales": """
        SELECT store, dept, date,
               CAST(round(sum(CASE WHEN l_returnflag = 'R' THEN -price ELSE price END), 2) AS DOUBLE)
                   AS weekly_sales,
               week(date) IN (6, 36, 47, 52) AS isholiday
        FROM order_lines GROUP BY store, dept, date""",
    "raw_stores": """
        SELECT n_nationkey + 1 AS store,
               CASE n_regionkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS type,
               30000 + (n_nationkey * 7919 % 25) * 8000 AS size
        FROM nation""",
    "weeks": """
        SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAYS)) AS DATE) AS date,
               min(date) AS lo, max(date) AS hi
        FROM raw_sales""",
    "store_markdowns": "SELECT store, date, "
    + ", ".join(
        f"CAST(round(sum(price * disc) FILTER (l_linenumber % 5 = {i - 1}), 2) AS DECIMAL(18,2)) AS m{i}"
        for i in range(1, 6)
    )
    + " FROM order_lines GROUP BY store, date",
    "raw_features": """
        SELECT s.store, w.date, datediff('day', w.lo, w.date) // 7 AS k,
               CAST(30 + ((datediff('day', w.lo, w.date) // 7) * 7 + s.store * 3) % 60 AS DOUBLE)
                   AS temperature,
               2.5::DOUBLE + ((datediff('day', w.lo, w.date) // 7) % 40) / 20.0::DOUBLE AS fuel_price, """
    + ", ".join(
        f"CASE WHEN w.date >= DATE '1997-01-01' AND m{i} IS NOT NULL THEN CAST(m{i} AS VARCHAR) ELSE 'NA' END AS markdown{i}"
        for i in range(1, 6)
    )
    + """,
               CASE WHEN datediff('day', w.date, w.hi) < 91 THEN 'NA'
                    ELSE CAST(CAST(120 + s.store + (datediff('day', w.lo, w.date) // 7) * 0.25 AS DECIMAL(20,2)) AS VARCHAR)
               END AS cpi,
               CASE WHEN datediff('day', w.date, w.hi) < 91 THEN 'NA'
                    ELSE CAST(CAST(5 + ((s.store * 13 + datediff('day', w.lo, w.date) // 7) % 50) / 10.0 AS DECIMAL(20,1)) AS VARCHAR)
               END AS unemployment,
               week(w.date) IN (6, 36, 47, 52) AS isholiday
        FROM raw_stores s CROSS JOIN weeks w
        LEFT JOIN store_markdowns m ON m.store = s.store AND m.date = w.date""",
    "sales": """
        SELECT CAST(store AS INTEGER) AS store, CAST(dept AS INTEGER) AS dept, date,
               greatest(weekly_sales, 0.0) AS weekly_sales, isholiday
        FROM raw_sales""",
    "features": "SELECT CAST(store AS INTEGER) AS store, date, temperature, fuel_price, "
    + _each("greatest(coalesce(try_cast(markdown{i} AS DOUBLE), 0.0), 0.0) AS markdown{i}")
    + """,
               last_value(try_cast(cpi AS DOUBLE) IGNORE NULLS) OVER up_to_now AS cpi,
               last_value(try_cast(unemployment AS DOUBLE) IGNORE NULLS) OVER up_to_now AS unemployment,
               isholiday
        FROM raw_features
        WINDOW up_to_now AS (PARTITION BY store ORDER BY date ROWS UNBOUNDED PRECEDING)""",
    "stores": """
        SELECT CAST(store AS INTEGER) AS store, type, CAST(size AS INTEGER) AS size FROM raw_stores""",
    "features_lagged": """
        SELECT *, lag(cpi, 12) OVER (PARTITION BY store ORDER BY date) AS cpi_lag_3_month FROM features""",
    "scaffold": """
        SELECT k.store, k.dept, w.date
        FROM (SELECT DISTINCT store, dept FROM sales) k CROSS JOIN weeks w""",
    "merged": """
        SELECT g.store, g.dept, g.date,
               coalesce(s.weekly_sales, 0.0) AS weekly_sales,
               coalesce(CAST(s.isholiday AS INTEGER), CAST(f.isholiday AS INTEGER), 0) AS isholiday,
               t.type AS store_type, t.size AS store_size,
               f.temperature, f.fuel_price, f.cpi, f.unemployment, """
    + _each("f.markdown{i}")
    + ", "
    + _each("coalesce(f.markdown{i}, 0)", " + ")
    + """ AS total_markdown,
               f.cpi_lag_3_month, s.store IS NOT NULL AS is_original_row
        FROM scaffold g
        LEFT JOIN sales s ON g.store = s.store AND g.dept = s.dept AND g.date = s.date
        LEFT JOIN features_lagged f ON g.store = f.store AND g.date = f.date
        LEFT JOIN stores t ON g.store = t.store""",
    "gold": """
        SELECT store, dept, date, weekly_sales, isholiday, store_type, store_size, temperature,
               fuel_price, cpi, unemployment, markdown1, markdown2, markdown3, markdown4, markdown5,
               total_markdown,
               CAST(month(date) AS INTEGER) AS month, CAST(week(date) AS INTEGER) AS week_of_year,
               ln(weekly_sales + 1) AS sales_log,
               sin(2 * pi() * week(date) / 52) AS sin_week, cos(2 * pi() * week(date) / 52) AS cos_week,
               lag(ln(weekly_sales + 1), 1) OVER w AS lag_1_log,
               lag(ln(weekly_sales + 1), 5) OVER w AS lag_5_log,
               lag(ln(weekly_sales + 1), 52) OVER w AS lag_52_log,
               lag(weekly_sales, 1) OVER w AS lag_1_sales,
               lag(weekly_sales, 5) OVER w AS lag_5_sales,
               lag(weekly_sales, 52) OVER w AS sales_last_year,
               avg(ln(weekly_sales + 1)) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
                   AS rolling_4_wk_log_sales_avg,
               avg(weekly_sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
                   AS rolling_4_wk_sales_avg,
               cpi_lag_3_month, is_original_row
        FROM merged
        WINDOW w AS (PARTITION BY store, dept ORDER BY date)""",
    "warm": "SELECT * FROM gold WHERE sales_last_year IS NOT NULL",
    "split_days": """
        SELECT quantile_disc(datediff('day', DATE '1970-01-01', date), 0.70) AS d1,
               quantile_disc(datediff('day', DATE '1970-01-01', date), 0.85) AS d2
        FROM warm""",
    "split_bounds": "SELECT DATE '1970-01-01' + CAST(d1 AS INTEGER) AS b1, DATE '1970-01-01' + CAST(d2 AS INTEGER) AS b2 FROM split_days",
    "splits": """
        SELECT g.*, CASE WHEN g.date <= b1 THEN 'train' WHEN g.date <= b2 THEN 'val' ELSE 'test' END AS split
        FROM warm g, split_bounds""",
    "ratios": """
        SELECT *,
               weekly_sales / (sales_last_year + 1) AS yoy_growth_ratio,
               weekly_sales / (rolling_4_wk_sales_avg + 1) AS trend_deviation_ratio,
               total_markdown / (weekly_sales + 1) AS markdown_intensity_ratio,
               (total_markdown / (weekly_sales + 1)) / (weekly_sales / (sales_last_year + 1) + 0.01)
                   AS markdown_cannibalization,
               weekly_sales / nullif(store_size, 0) AS footprint_yield,
               CASE WHEN isholiday = 1 THEN weekly_sales / (rolling_4_wk_sales_avg + 1) ELSE 1.0 END
                   AS holiday_miss_severity
        FROM warm""",
    "last_year": """
        SELECT s.store, s.dept, s.date, s.weekly_sales, s.isholiday, p.weekly_sales AS baseline_prediction
        FROM raw_sales s
        JOIN raw_sales p ON p.store = s.store AND p.dept = s.dept AND p.date + 364 = s.date""",
}


def _needs(text: str) -> set[str]:
    return {name for name in TABLES if re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text, re.IGNORECASE)}


def with_tables(sql: str) -> str:
    """Prefix ``sql`` with the panel tables it refers to, directly or not."""
    wanted: set[str] = set()
    queue = [sql]
    while queue:
        for name in _needs(queue.pop()) - wanted:
            wanted.add(name)
            queue.append(TABLES[name])
    sql = sql.strip()
    if not wanted:
        return sql
    parts = [f"{name} AS ({TABLES[name].strip()})" for name in TABLES if name in wanted]
    head = "WITH " + ",\n".join(parts)
    if re.match(r"WITH RECURSIVE\b", sql, re.IGNORECASE):
        return head.replace("WITH", "WITH RECURSIVE", 1) + ",\n" + sql[14:].strip()
    if re.match(r"WITH\b", sql, re.IGNORECASE):
        return head + ",\n" + sql[4:].strip()
    return head + "\n" + sql
