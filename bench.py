"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Every query runs once to warm the JVM and once timed, and its whole result is
computed (``noop`` sink). ``baseline_lysw_metrics`` and ``gold_obt`` start from
the order tables each time. Queries on the gold table read the stored one, as
the jobs after the gold stage do; ``gold_build`` is its cost. The ``at_476k``
entries repeat the panel into later years until it has the row count of the
published 476,333-row figures: cleaning, building, and exporting that table.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from weekgrid.operators import clean, gold as gold_ops, kpi  # noqa: E402
from weekgrid.plans import all_queries  # noqa: E402
from weekgrid.plans.shared import panel  # noqa: E402
from weekgrid.session import build_session, scratch_path, stored  # noqa: E402
from weekgrid.sources.panel import Panel  # noqa: E402

HEADLINE = [
    "baseline_lysw_metrics", "gold_obt", "silver_sales_dedup", "gold_lags", "split_counts",
    "forecast_metrics", "profile_summary", "corr_matrix_long", "holiday_lift", "gap_audit",
    "market_basket_rules", "store_profiles_scaled", "anomaly_ratios", "seasonal_decompose", "acf_60",
    "drift_report", "dq_gold", "panel_inflate_drift",
]
COPIES = 11


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    jobs = {name: (lambda n=name: run(queries[n](spark, sf_dir))) for name in HEADLINE}
    jobs["gold_build"] = lambda: Panel(spark, sf_dir).stored_gold

    p = panel(spark, sf_dir)
    to_text = F.date_format("Date", "dd/MM/yyyy")
    longer = kpi.inflate(
        p.bronze_sales.withColumn("Date", F.to_date("Date", "dd/MM/yyyy")), COPIES, date="Date", days=345 * 7
    )
    raw = stored(longer.drop("copy").withColumn("Date", to_text), "bench-raw-sales")
    features = stored(
        kpi.inflate(p.silver_features, COPIES, days=345 * 7).drop("copy"), "bench-features"
    )
    sales = stored(clean.clean_sales(raw), "bench-sales")
    wide = stored(gold_ops.build_gold(sales, features, p.silver_stores), "bench-gold")
    jobs["silver_transform_at_476k"] = lambda: run(clean.clean_sales(raw))
    jobs["gold_build_at_476k"] = lambda: run(gold_ops.build_gold(sales, features, p.silver_stores))
    jobs["gold_export_at_476k"] = lambda: wide.write.mode("overwrite").parquet(
        scratch_path(spark, "bench-export")
    )

    timings = {}
    for name, job in jobs.items():
        job()
        start = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - start, 3)
    rows = {"raw_sales": raw.count(), "gold": wide.count()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "rows_at_476k": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
