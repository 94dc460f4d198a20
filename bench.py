"""Benchmark: run every registered query over the tables in $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line with wall seconds per query.

Each query is built (which runs its key-assignment jobs, if any) and then
fully executed into Spark's no-op sink, so every row and column is computed
and nothing is collected to the driver.  Every query first runs once on the
smallest tables (sf0.001) so that the measured runs see a warm JVM; that
warm-up is reported apart as ``warmup_sec``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from starloom import build_session
    from starloom.catalog import queries

    spark = build_session(
        f"local[{cpus}]",
        app_name="starloom-bench",
        shuffle_partitions=int(cpus) * 2,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    qs = queries()
    names = [n for n in sorted(qs) if not only or n in only]
    # warm-up (timed apart): every query once on the smallest generated tables,
    # so that class loading and JIT compilation of each code path happen
    # before the measured runs, as on a long-running cluster
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    w0 = time.perf_counter()
    for name in names:
        qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.perf_counter() - w0, 3)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_wall_seconds_all_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "warmup_sec": warmup,
        "warmup_dir": warm_dir,
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
