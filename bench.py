"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_EVENT_LOG (an
existing folder for Spark's event log; off by default).
Each query runs to completion through a ``noop`` sink (nothing is
collected to the driver); the time includes planning and every job the
query starts (size checks, checkpoints).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "jaccard_pairs",          # J1 set-similarity join (>= 0.30)
    "best_match_floor",       # minimum slice: best match >= 0.41, 17 columns
    "cascade_none",           # closed-form cascade, 81 rounds, no band
    "cascade_none_banded",    # + direct semantic band (embeddings)
    "assisted_band",          # search-assisted band with hits
    "multi_vendor",           # six vendors in one job
    "consolidate_by_left",    # round expansion + keep-first consolidation
    "cascade_matched",        # exclusion policy, iterative rounds, whole grid
    "semantic_pair_score",    # embeddings of 2 x 4 texts per pair
    "stopword_filter",        # whole-document tokenise + stop words
    "listing_two_hop",        # page extraction + two-hop join
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    from skulink.plans.queries import QUERIES
    from skulink.session import get_spark
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage and task times for later analysis, written to a scratch folder
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_spark(f"local[{cpus}]", app_name="skulink-bench",
                      shuffle_partitions=max(8, 2 * cpus), extra=extra)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf_val = sf.rsplit("sf", 1)[-1]
    try:
        sf_num = float(sf_val)
    except ValueError:
        sf_num = sf_val
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_num, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
