"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8), executing the whole plan into Spark's
``noop`` sink (nothing is collected to the driver), and prints one JSON line:

    {"metric": "headline_total_sec", "value": N, "unit": "sec",
     "queries": {"name": sec, ...}, "sf": ...}

Per-query detail (input rows, rows/s) goes to stderr.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")  # pandas notices in workers

from relaywatch.plans import QUERIES  # noqa: E402
from relaywatch.session import get_session  # noqa: E402

HEADLINE = [
    "a2_delivery_summary",     # reliability per mode (flagship)
    "a3_mode_reliability",     # web-side decode + rejects + per-mode base
    "a6_operations_kpis",      # KPIs per epoch
    "w1_running_kpis",         # running KPIs, bucketed prefix sums
    "w2_running_reliability",  # running reliability per mode (3 hot keys)
    "w3_breach_events",        # trigger firing
    "j9_diagnose",             # diagnosis per breach event
    "l2_top_documents",        # TF-IDF top-k over documents x benchmark
    "a7_hourly_demand",        # hourly series
    "m1_demand_model",         # ARMA(1,1) per item (applyInPandas)
    "st6_live_unique",         # streaming exact unique (4 micro-batches)
    "st9_breach_stream",       # streaming trigger state machine
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app="relaywatch-bench",
                        shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": "16g"})
    names = [n for n in HEADLINE if n in QUERIES]
    # Warm-up: JIT and Python workers, on the smallest query.
    QUERIES["a8_latest_sequence"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name:28s} {times[name]:8.3f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
