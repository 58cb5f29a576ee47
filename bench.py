"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then BENCH_RUNS times into a sink that discards the rows; the
median counts. The time includes deriving the star schema from the benchmark tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lectern.plans.catalog import queries  # noqa: E402
from lectern.session import build_session  # noqa: E402

HEADLINE = [
    "student_course_performance", "student_course_performance_compat", "course_analytics", "student_risk",
    "extract_submissions", "upsert_students", "upsert_enrollments", "upsert_submissions", "insert_new_activity",
    "submissions_base", "metrics_enrollment", "warehouse_daily_costs", "cost_dashboard", "constraint_report",
    "search_activity", "search_students",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(cpus, app="bench", scratch=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    known, times = queries(), {}

    def once(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
