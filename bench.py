"""Time the headline queries and print one JSON line.

Every query is run once to warm up, then three times; the median counts. Rows are
written to the ``noop`` sink, so all columns of all rows are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from lakeops.session import local_session
from lakeops.suite import REGISTRY

HEADLINE = (
    "top_customer_nation",
    "trips_gold_daily",
    "trips_dq_view",
    "missing_profile",
    "city_clean_summary",
    "neighbourhood_metrics",
    "occupancy_by_month",
    "median_exact_lineitem",
    "fk_orphans",
    "pk_violations",
    "count_reconcile",
    "dedupe_rows",
    "hash_sample",
    "amenity_counts",
    "score_last_day",
    "fare_model",
    "param_search",
)
RUNS = 3


def run_once(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def jobs_of(spark, name: str, folder: str) -> int:
    """Spark jobs of one run. Adaptive execution may split one aggregate into several."""
    spark.sparkContext.setJobGroup(f"count-{name}", name)
    run_once(spark, name, folder)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"count-{name}"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus)
    spark.conf.set("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    times, jobs = {}, {}
    for name in names:
        jobs[name] = jobs_of(spark, name, folder)
        times[name] = round(statistics.median(run_once(spark, name, folder) for _ in range(RUNS)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_median",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "jobs": jobs,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
