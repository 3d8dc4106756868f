"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default the headline set),
BENCH_REPEAT (default 1: best of N runs per query).
Each query is fully executed through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linepulse.plans.plant import stage_testdata  # noqa: E402
from linepulse.plans.registry import queries  # noqa: E402
from linepulse.session import build_session  # noqa: E402

HEADLINE = [
    "oee_positive",             # flagship: the batch report (K12)
    "oee_rows",                 # OEE multiset as (row, multiplicity)
    "today_oee",                # one day, pruned inputs
    "machine_time",             # K1
    "state_islands",            # E3 gaps-and-islands, skew-bounded
    "lot_output_count",         # C3 range counts (prefix sums)
    "order_window_ship_count",  # C3 at orders x lineitem scale
    "lot_throughput",           # C6 containment lookup + K10
    "line_state_timeline",      # C4 interval overlap
    "machine_state_intervals",  # next-sample intervals from raw events
    "stream_lot_counts",        # I2 Structured Streaming
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = queries()
    # One-time setup, part of the total: derive the domain tables from the raw
    # parquet files and store them (what ingestion would have produced).
    t0 = time.perf_counter()
    stage_testdata(spark, sf_dir, force=True)
    setup = time.perf_counter() - t0
    times, errors = {}, {}
    for name in names:
        best = None
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_and_staging_total",
        "value": round(sum(times.values()) + setup, 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "setup_stage_domain_tables_sec": round(setup, 3),
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
