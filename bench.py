"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local threads. Each query
is run to its end without keeping rows; the session and the file cache are
warmed by one small query first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tillwright.registry import QUERIES
from tillwright.session import build_session

HEADLINES = [
    "store_kpis", "product_margins", "store_products", "best_worst_combo", "recommendations", "sales_detail",
    "cleaning_audit", "daily_revenue", "net_lines", "trading_series", "upcoming_trading_days",
    "decomposition", "anomaly_days", "weekday_month_pattern", "unit_root_test",
    "smoothing_metrics", "model_metrics", "forecast_30_days", "stock_plan", "rolling_origin_errors",
    "click_prior_sensitivity", "figure_click_curves", "click_sequential", "click_stream",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(app="bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        # Each table is one small file, read by one task: a shuffle join spreads the rest over all threads.
        "spark.sql.autoBroadcastJoinThreshold": "2MB",
    })
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["category_totals"](spark, folder).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINES)
