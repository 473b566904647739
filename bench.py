"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
The clean stage is timed from the raw tables; the analytics run on the
materialised clean table (as in the pipeline, where it is written once and
read by every analytic). Each query: one warm-up, then the median of 3 runs,
each fully materialised through the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_pipeline", "popular_destinations", "type_summary", "price_rating_stats", "kpis",
    "top_locations", "balanced_cap", "proportional_cap", "rating_box_by_type", "price_histogram_log",
    "assign_centers", "features", "batch_recommend", "recommend_preferences", "sentiment",
    "booking_demand", "import_sources", "dedup_listings", "kmeans_tiers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    from wayfarer.session import build_session, checkpoint_dir, has_checkpoint_dir
    from wayfarer.plans.queries import QUERIES

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          conf={"spark.driver.memory": "16g"})
    if not has_checkpoint_dir(spark):
        checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="wayfarer-bench-"))
    times, rows = {}, {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        rows[name] = fn(spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
