"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect to the
driver), once, after an untimed warm-up pass over a smaller table set. Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary.plans.catalog import QUERIES as ALL_QUERIES  # noqa: E402
from tributary.session import get_session  # noqa: E402


# The streaming forms (t*, which also write their input topics and sinks) are
# timed as well; BENCH_STREAMS=0 leaves them out.
QUERIES = {k: v for k, v in ALL_QUERIES.items()
           if not k.startswith("t") or os.environ.get("BENCH_STREAMS") != "0"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    spark = get_session(f"local[{cpus}]", app="tributary-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM (class loading, JIT, codegen caches) with one untimed pass of
    # every query over a smaller table set next to the measured one. The sf0.01
    # tables give the JIT enough rows to compile the hot loops; a pass over
    # sf0.001 (about a thousand rows) left the timed pass mostly measuring compilation.
    parent = os.path.dirname(sf_dir.rstrip("/"))
    warm_dir = os.environ.get("BENCH_WARM_DIR") or next(
        (d for d in (os.path.join(parent, "sf0.01"), os.path.join(parent, "sf0.001"))
         if os.path.isdir(d) and os.path.abspath(d) != os.path.abspath(sf_dir)), sf_dir)
    for name, fn in QUERIES.items():
        if not only or name in only:
            fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
