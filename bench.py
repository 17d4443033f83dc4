"""Benchmark: run the registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is produced, nothing is
collected to the driver). Prints one JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

BENCH_QUERIES=a,b,c limits the run to some keys; by default every registered key runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forecourt.plans.registry import QUERIES, load_all  # noqa: E402
from forecourt.session import build_session  # noqa: E402


WARMUP = "margin_base"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    load_all()
    spark = build_session(f"local[{cpus}]", app_name="forecourt-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    keys = only or sorted(QUERIES)
    timings: dict[str, float] = {}
    # Warm-up (not timed): JVM JIT, parquet footers, codegen caches, via the flagship query.
    QUERIES[WARMUP](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for key in keys:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[key] = round(time.perf_counter() - t0, 3)
        print(f"{key}: {timings[key]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "warmup": WARMUP,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
