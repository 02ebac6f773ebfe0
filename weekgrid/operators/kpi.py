"""Business figures derived from the sales panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values of the business case.
WEEKS_PER_YEAR = 52
COGS_SHARE = 0.75
TURNS = 8.5
STOCK_CUT = 0.08
HOLDING_RATE = 0.20
MARKDOWN_SHARE = 0.045
MARKDOWN_CUT = 0.05


def roi(sales: DataFrame) -> DataFrame:
    """Annualised revenue, inventory value and the savings derived from them."""
    base = sales.agg(
        F.sum("weekly_sales").alias("total_sales"), F.count_distinct("date").alias("weeks")
    )
    yearly = base.withColumn(
        "annual_revenue", F.col("total_sales") / F.col("weeks") * F.lit(float(WEEKS_PER_YEAR))
    )
    stocked = yearly.withColumns(
        {
            "annual_cogs": F.col("annual_revenue") * COGS_SHARE,
            "inventory_value": F.col("annual_revenue") * COGS_SHARE / TURNS,
            "markdown_spend": F.col("annual_revenue") * MARKDOWN_SHARE,
        }
    )
    freed = stocked.withColumn("freed_capital", F.col("inventory_value") * STOCK_CUT)
    return freed.withColumns(
        {
            "holding_savings": F.col("freed_capital") * HOLDING_RATE,
            "markdown_savings": F.col("markdown_spend") * MARKDOWN_CUT,
        }
    )


def safety_stock(
    sales: DataFrame,
    keys: list[str],
    lead_time: float = 2.0,
    lead_time_std: float = 0.5,
    z: float = 1.65,
) -> DataFrame:
    """Safety stock per series: z * sqrt(LT * sd^2 + mean^2 * sd_LT^2)."""
    stats = sales.groupBy(*keys).agg(
        F.avg("weekly_sales").alias("mean_demand"), F.stddev_samp("weekly_sales").alias("std_demand")
    )
    variance = lead_time * F.pow("std_demand", F.lit(2.0)) + F.pow("mean_demand", F.lit(2.0)) * (
        lead_time_std**2
    )
    return stats.withColumn("safety_stock", z * F.sqrt(variance))


def inflate(
    panel: DataFrame,
    copies: int,
    date: str = "date",
    days: int = 364,
    drift: dict[str, float] | None = None,
) -> DataFrame:
    """Repeat a panel into later years, scaling the columns in ``drift`` by
    ``1 + rate * copy``. Rows unfold in place: no join and no shuffle."""
    out = panel.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    changed = {date: F.date_add(F.col(date), F.col("copy") * days)}
    for name, rate in (drift or {}).items():
        changed[name] = F.col(name) * (1.0 + rate * F.col("copy"))
    return out.withColumns(changed)
