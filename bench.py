"""Seconds per headline query: median of three warm runs, written to a sink that keeps nothing."""

from __future__ import annotations

import json
import os
import statistics
import time

from millrace import local_session, scratch
from millrace.plans import QUERIES

HEADLINE = [
    "sales_by_region",
    "active_join",
    "rollup_active",
    "month_positions",
    "monthly_history",
    "iqr_outliers",
    "describe_numeric",
    "offset_page",
    "keyset_page",
    "year_wrapped",
    "year_range",
    "heavy_users",
    "total_left_join",
    "lossless_rejoin",
    "validate_errors",
    "upper_row",
    "upper_vector",
    "upper_native",
    "goals_folded",
    "ledger_balances",
    "daily_completions_streamed",
]
RUNS = 3


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    for name in HEADLINE:  # warm up
        seconds(lambda: QUERIES[name](spark, folder))
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(seconds(lambda: QUERIES[name](spark, folder)) for _ in range(RUNS)), 3)
        scratch.clear(spark)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, sum of warm medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
