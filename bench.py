"""Time the headline queries and print one JSON line.

Every query is run once untimed on the smallest tables, so that times do not hold JVM warm-up.
"""

import contextlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pedalpath.plans.driver_queries import QUERIES  # noqa: E402
from pedalpath.session import local_session  # noqa: E402

HEADLINE = [
    "hot_path_all", "hot_path_all_1h", "hot_path_longest", "hot_path_longest_overlapping",
    "hot_path_longest_arrival", "hot_path_counts", "hot_path_totals", "detail_sample", "top_bikes",
    "trip_sequence", "chain_summary", "open_chains", "late_drop", "clean_strict", "compare_counts",
    "latency_buckets", "overload_switch", "trip_flags", "stream_hot_paths",
]
SMALL = "/root/testdata/sf0.001"


def run(spark, name, folder):
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session(cpus, cpus, "bench")
        times = {}
        for name in names:
            if os.path.isdir(SMALL):
                run(spark, name, SMALL)
            start = time.perf_counter()
            run(spark, name, folder)
            times[name] = round(time.perf_counter() - start, 3)
        trips = spark.read.parquet(f"{folder}/events.parquet").count()
        spark.stop()
    print(json.dumps({
        "metric": "hot_path_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "trips": trips,
        "trips_per_sec": {n: round(trips / t) for n, t in times.items()},
    }))


if __name__ == "__main__":
    main()
