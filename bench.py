"""Benchmark: run every catalogue key that asks a question at $BENCH_SF_DIR on local[$BENCH_CPUS]
(keys that replay streams or loads into stored tables are left out).

Prints one JSON line: {"metric", "value" (sum of per-key medians), "unit",
"queries": {key: median sec}, "sf"}. Each key is timed end to end (plan +
full execution of every result row) with a warm session; the median of
$BENCH_REPS runs. Results go to Spark's ``noop`` sink, which runs the whole
plan without shipping rows to the Python driver, so the time is the engine's
work rather than Python row conversion.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = os.environ.get("BENCH_KEYS")

    from ledgerlens.session import local_session
    from ledgerlens.plans.catalog import KEPT, QUERIES

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="ledgerlens-bench")
    keys = only.split(",") if only else [k for k in QUERIES if k not in KEPT]
    # Warm-up: JIT, file listing and the first codegen happen once.
    QUERIES["product_funnel"](spark, sf_dir).collect()
    timings = {}
    for key in keys:
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[key] = round(statistics.median(runs), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "catalogue_wall_seconds", "value": round(sum(timings.values()), 3),
           "unit": "sec", "queries": timings, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
