"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated, or
"all") the queries. Every query runs once unmeasured and then BENCH_RUNS times (two unless set), of
which the best counts; all its rows and columns are computed and none are kept.
"""

from __future__ import annotations

import json
import os
import time

from checks.compare import session
from checks.queries import QUERIES

HEADLINE = (
    "parse_flat", "parse_nested", "scrub_pii", "upsert_latest", "clean", "dedup_latest",
    "term_match_documents", "term_extract", "demand_monthly", "skill_overview",
    "salary_benchmark", "market_kpi", "stage_counts", "mart_sink", "trend_pivot",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
