"""Time the headline queries: warm, median of three, one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Every query runs to the end through a ``noop`` write, so all
result rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallygrid.checks import all_queries
from tallygrid.session import local_session

RUNS = 3
HEADLINE = [
    # metrics over one or more facts
    "margin_by_segment_last_12_months", "hours_by_practice", "hours_by_month_against_last_year", "revenue_by_segment",
    "revenue_by_year_against_last_year", "billing_by_practice", "projects_by_year", "planning_by_team",
    "occupancy_by_week", "budget_by_year", "contract_margins_by_contract", "contract_margins_by_customer",
    "cloud_cost_by_resource_group", "timesheets_and_planning_by_year", "people_by_team",
    # context, totals, windows
    "table_with_grand_total", "part_of_selection", "rollup_by_year_and_quarter", "cumulative_revenue_by_day",
    "versions_numbered_per_key", "rows_numbered", "parts_ranked_by_size",
    # cleaning, lookups, loads
    "lines_deduplicated", "backfill_merged", "tags_widened", "surrogate_key_lookup", "facts_restricted_by_visible_values",
    "date_functions", "blank_aware_arithmetic", "sprint_issues_flattened", "task_dimension", "satisfaction_fact",
    "costs_loaded_twice", "cost_view_backfilled",
]


def timed(build, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    queries = all_queries()
    seconds = {}
    for name in [n for n in HEADLINE if not sys.argv[1:] or any(a in n for a in sys.argv[1:])]:
        timed(queries[name], spark, sf_dir)  # warm-up
        seconds[name] = round(statistics.median(timed(queries[name], spark, sf_dir) for _ in range(RUNS)), 3)
    result = {
        "metric": "headline queries, warm median of 3, sum", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
