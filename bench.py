"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and writes it to Spark's ``noop`` sink, so the whole
plan executes without pulling rows to the driver.  Each query runs
``$BENCH_RUNS`` times (default 2, the first warms JIT and codegen); the best
run is reported in ``queries`` and the first in ``first_run``.  The one-time
landing of the data derived from the test tables (the cube as parquet and as
JSON pages, the event pages) is reported under ``setup``, outside ``value``
(the sum of the per-query times).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statlake.plans.registry import QUERIES  # noqa: E402
from statlake.session import get_spark  # noqa: E402

HEADLINE = [
    "tidy_decode",        # value split + decode of the whole landed cube
    "cube_pages_tidy",    # JSON parse + value split + decode of the whole cube (one job)
    "value_pages",        # JSON page scan -> observations
    "pages_tidy",         # landed JSON pages -> parquet lake -> tidy (the whole path)
    "filter_codes",
    "time_window",
    "limit_offset",
    "pivot_wide",
    "annotation_counts",
    "class_pages",
    "catalog_search",
    "status_classes",
    "page_gaps",
    "fresh_metadata",
    "prefer_language",
    "range_rollup",
    "dissolve_area",
    "dissolve_rings",     # iterative ring stitching
    "geometry_join",
    "lake_tidy",          # decode of many tables in two languages
    "axis_hierarchy",
    "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    # Warm the JVM (class loading, codegen caches) on a tiny query.
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    # One-time landing of the cube derived from lineitem/orders/customer
    # (parsed observations + code lists as parquet), timed on its own.
    from statlake.plans import testdata as td
    from statlake.plans.lake import landed_cube, landed_derived

    t0 = time.perf_counter()
    landed_cube(spark, sf_dir)
    landed_derived(spark, sf_dir, "cube-pages", lambda s, d: td.cube_pages(landed_cube(s, d)["observations"]))
    landed_derived(spark, sf_dir, "event-pages", td.event_pages)
    setup = {"land_derived": round(time.perf_counter() - t0, 3)}
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    first: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for i in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i == 0:
                first[name] = round(dt, 3)
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "setup": setup,
        "runs": runs,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
