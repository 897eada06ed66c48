"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (test tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query, the median
counts). Every query runs in full into Spark's no-op sink, after one untimed run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from harness.catalogue import QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = (
    "s7_staging_load",
    "w8_jira_issues",
    "w13_projects",
    "w18_users",
    "h5_fct_hrm_employees",
    "d1_dim_jira_issues",
    "d2_dim_members",
    "d4_dim_projects",
    "d8_fct_worklog",
    "d9_mview_member_free_effort",
    "d9_mview_member_free_effort_reference",
    "s11_view_refresh",
    "n1_moving_average",
    "q_f_suite",
    "x1_headcount_change",
    "x13_resolution_hours",
    "x15_project_sla",
    "x16_worked_time",
    "x17_contributions",
)


def run(spark, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    seconds = {}
    for name in names:
        run(spark, QUERIES[name], sf_dir)
        seconds[name] = round(statistics.median(run(spark, QUERIES[name], sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
