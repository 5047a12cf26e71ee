"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query is timed from building its plan to writing its whole result to a sink that keeps
nothing. Every query runs once untimed first, which loads classes and compiles its code.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surtido.registry import QUERIES  # noqa: E402
from surtido.session import local_session  # noqa: E402

HEADLINE = (
    "clean_lines", "clean_audit", "exact_dedup", "valid_products", "split_counts",
    "catalog_top_price", "sales_fact", "kpis", "product_list", "sales_last_30d_all",
    "monthly_units_last_year", "daily_units", "monthly_units_filled", "iqr_fences",
    "feature_matrix", "alpha_selected", "backtest_metrics", "forecast_next_year",
    "forecast_next_year_by_country", "allocate_forecast", "forecast_by_product", "investment",
    "constraint_violations", "surrogate_key", "insert_ignore", "csv_roundtrip",
    "reloaded_kpis",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "8g"))
    times = {}
    for name in HEADLINE:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(repeats)), 3)
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else folder,
    }))


if __name__ == "__main__":
    main()
