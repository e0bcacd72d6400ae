"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a ``noop`` write (the whole plan runs, nothing is
collected to the driver).  One untimed warm-up pass over all queries, then
$BENCH_REPEATS timed passes; the per-query figure is the median.  Prints one
JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
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
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cohortkit.plans.registry import load_all
    from cohortkit.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    queries, _ = load_all()
    names = only or list(queries)

    def run(name: str) -> float:
        t = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for n in names:                       # warm-up: JIT, file listing caches
        run(n)
    times: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(repeats):
        for n in names:
            times[n].append(run(n))
    med = {n: round(statistics.median(v), 3) for n, v in times.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(med.values()), 3),
        "unit": "sec",
        "queries": med,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
