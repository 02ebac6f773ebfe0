"""Derives the weekly retail panel from the order tables.

A store is a customer nation, a department a market segment, and a week ends
on Friday. Sales, weekly indicators and stores come out in the raw form in
which retail files arrive: text dates, ``NA`` for missing numbers, returns as
negative sales.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from weekgrid.functions.calendar import span, week_spine
from weekgrid.operators.clean import clean_features, clean_sales, clean_stores
from weekgrid.operators.gold import build_gold
from weekgrid.session import stored

# Fixed values of the panel mapping.
DEPT_OF_SEGMENT = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}
OTHER_DEPT = 5
DEPTS = [1, 2, 3, 4, 5]
HOLIDAY_WEEKS = [6, 36, 47, 52]
MARKDOWNS = [f"markdown{i}" for i in range(1, 6)]
MARKDOWN_START = "1997-01-01"
LATE_INDICATOR_DAYS = 91
UNIT = 1_000_000  # markdown sums are kept in millionths


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def weekly_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net sales in cents and five markdown amounts per store, department and week.

    Money is summed in whole units (cents; millionths for price x discount), so
    the result does not depend on row order. Lines collapse to one row per
    order before the order join and to one row per customer and week before
    the customer join: the two joins then see pre-aggregated keys, so an order
    or a customer that owns a third of all lines is combined map-side. The last
    level sums whole and fractional markdown units apart, which keeps 64-bit
    sums clear of their limit.
    """
    per_order = (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "l_orderkey",
            "l_linenumber % 5 AS slot",
            "cast(rint(l_extendedprice * 100) AS bigint) AS cents",
            "cast(rint(l_discount * 10000) AS bigint) AS points",
            "l_returnflag = 'R' AS returned",
        )
        .groupBy("l_orderkey")
        .agg(
            F.expr("sum(if(returned, -cents, cents)) AS sales_cents"),
            *[
                F.expr(f"sum(if(slot = {i}, cents * points, NULL)) AS {m}")
                for i, m in enumerate(MARKDOWNS)
            ],
        )
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS l_orderkey",
        "o_custkey",
        "date_add(cast(date_trunc('week', o_orderdate) AS date), 4) AS date",
    )
    per_customer = (
        per_order.join(orders, "l_orderkey")
        .groupBy("o_custkey", "date")
        .agg(*[F.sum(c).alias(c) for c in ["sales_cents", *MARKDOWNS]])
    )
    segments = " ".join(f"WHEN '{s}' THEN {n}" for s, n in DEPT_OF_SEGMENT.items())
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS o_custkey",
        "cast(c_nationkey + 1 AS int) AS store",
        f"CASE c_mktsegment {segments} ELSE {OTHER_DEPT} END AS dept",
    )
    return (
        per_customer.join(customers, "o_custkey")
        .groupBy("store", "dept", "date")
        .agg(
            F.sum("sales_cents").alias("sales_cents"),
            *[
                F.expr(
                    f"cast(sum({m} div {UNIT}) AS decimal(20,0))"
                    f" + cast(sum({m} % {UNIT}) AS decimal(20,0)) / {UNIT} AS {m}"
                )
                for m in MARKDOWNS
            ],
        )
    )


HOLIDAY = f"weekofyear(date) IN ({', '.join(map(str, HOLIDAY_WEEKS))})"


class Panel:
    """Raw, cleaned and wide tables of one data directory.

    ``reuse`` writes the weekly amounts once: sales, calendar bounds and
    markdowns then read that small table and the order tables are scanned a
    single time. Plans that touch the amounts once stay fully lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, reuse: bool = True):
        self.spark, self.sf_dir, self.reuse = spark, sf_dir, reuse

    @functools.cached_property
    def amounts(self) -> DataFrame:
        lazy = weekly_amounts(self.spark, self.sf_dir)
        return stored(lazy, "weekly-amounts") if self.reuse else lazy

    @property
    def sales(self) -> DataFrame:
        """Typed weekly sales before any cleaning (returns stay negative)."""
        return self.amounts.selectExpr(
            "store", "dept", "date", "sales_cents / 100D AS weekly_sales", f"{HOLIDAY} AS isholiday"
        )

    @property
    def bronze_sales(self) -> DataFrame:
        return self.sales.selectExpr(
            "store AS Store",
            "dept AS Dept",
            "date_format(date, 'dd/MM/yyyy') AS Date",
            "weekly_sales AS Weekly_Sales",
            "isholiday AS IsHoliday",
        )

    @property
    def bronze_stores(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "nation").selectExpr(
            "cast(n_nationkey + 1 AS int) AS Store",
            "CASE n_regionkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS Type",
            "cast(30000 + (n_nationkey * 7919 % 25) * 8000 AS int) AS Size",
        )

    @property
    def bronze_features(self) -> DataFrame:
        """Weekly indicators of every store: markdowns from the discounts given,
        the others by a fixed rule on store and week number ``k``."""
        bounds = span(self.amounts)
        grid = (
            self.bronze_stores.select(
                F.col("Store").alias("store"),
                F.explode(week_spine(bounds["lo"], bounds["hi"])).alias("date"),
                bounds.alias("bounds"),
            )
            .selectExpr(
                "store",
                "date",
                "cast(datediff(date, bounds.lo) div 7 AS int) AS k",
                f"datediff(bounds.hi, date) < {LATE_INDICATOR_DAYS} AS late",
            )
        )
        per_week = self.amounts.groupBy("store", "date").agg(
            *[F.sum(m).alias(m) for m in MARKDOWNS]
        )

        def text(value: str, scale: int, missing: str) -> str:
            shown = f"cast(cast({value} AS decimal(20,{scale})) AS string)"
            return f"if({missing}, 'NA', coalesce({shown}, 'NA'))"

        early = f"date < DATE '{MARKDOWN_START}'"
        return grid.join(per_week, ["store", "date"], "left").selectExpr(
            "store AS Store",
            "date_format(date, 'dd/MM/yyyy') AS Date",
            "cast(30 + (k * 7 + store * 3) % 60 AS double) AS Temperature",
            "2.5D + (k % 40) / 20D AS Fuel_Price",
            *[f"{text(m, 2, early)} AS MarkDown{i}" for i, m in enumerate(MARKDOWNS, start=1)],
            f"{text('120 + store + k * 0.25', 2, 'late')} AS CPI",
            f"{text('5 + ((store * 13 + k) % 50) * 0.1', 1, 'late')} AS Unemployment",
            f"{HOLIDAY} AS IsHoliday",
        )

    @property
    def silver_sales(self) -> DataFrame:
        return clean_sales(self.bronze_sales)

    @property
    def silver_features(self) -> DataFrame:
        return clean_features(self.bronze_features)

    @property
    def silver_stores(self) -> DataFrame:
        return clean_stores(self.bronze_stores)

    @property
    def gold(self) -> DataFrame:
        # Cleaning moves no date, so the weekly amounts have the bounds of the sales.
        return build_gold(self.silver_sales, self.silver_features, self.silver_stores, bounds=span(self.amounts))

    @functools.cached_property
    def stored_gold(self) -> DataFrame:
        """Gold written once, for jobs that scan it several times."""
        return stored(self.gold, "gold")
