"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose data, cores and timed runs, five by default.  Each
query runs once to warm up; the median of the timed runs counts (fewer where they have taken
BENCH_SECONDS together, 30 by default).  Every run starts without cached lookup sides, computes all columns of
all rows and throws them away.
BENCH_SQL=1 also times the SQL form in DuckDB.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from jobtide.operators.lookup import release  # noqa: E402
from jobtide.session import open_session  # noqa: E402

HEADLINE = [
    "a1_jobs_by_city", "a3_jobs_by_state", "a5_jobs_daily", "a7_collapse", "a9_job_totals",
    "a10_daily_jobs", "a12_salary_by_state", "a13_distinct_links", "c1_clean_records",
    "c1_ingest", "c3_state_dimension", "c5_conformed", "c5_conformed_copies", "c6_posting_links",
    "c7_all_marts", "c8_job_details", "c11_refresh_run", "f7_translate", "j1_new_postings",
    "p4_title_phrase", "s1_read_json", "u2_facet_values", "w2_wow_to_date",
]


def once(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def timed(run, runs: int, most: float) -> tuple[float, float, int]:
    """Median, slowest and number of the timed runs."""
    once(run)
    taken: list[float] = []
    while len(taken) < runs and sum(taken) < most:
        taken.append(once(run))
    return round(statistics.median(taken), 3), round(max(taken), 3), len(taken)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs, most = int(os.environ.get("BENCH_RUNS", "5")), float(os.environ.get("BENCH_SECONDS", "30"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = open_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run_spark(name):
        def run():
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            release()
        return run

    times = {name: timed(run_spark(name), runs, most) for name in names}
    seconds = {name: median for name, (median, *_) in times.items()}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "slowest": {name: slowest for name, (_, slowest, _) in times.items()},
        "runs": {name: number for name, (*_, number) in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    if os.environ.get("BENCH_SQL"):
        from checks.compare import connect
        from checks.oracle import ORACLE

        con = connect(sf_dir)
        con.execute(f"SET threads = {int(cpus)}")
        line["sql"] = {
            name: timed(lambda: con.execute(f"CREATE OR REPLACE TEMP TABLE t AS {ORACLE[name]}"), runs, most)[0]
            for name in names
        }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
