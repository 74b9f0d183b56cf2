"""Times the headline queries; prints one JSON line.

Each query is run once to warm up and then BENCH_RUNS times (default 3); the median
counts. Batch queries write all their rows to the no-op sink. The streaming query is a
whole replay, from an empty checkpoint to its last micro-batch.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from merchant_ledger.plans.queries import QUERIES
from merchant_ledger.session import local_session

BATCH = [
    "merchant_running",
    "merchant_totals",
    "merchant_totals_from_deltas",
    "merchant_latest",
    "incremental_deltas",
    "order_latest_state",
    "cdc_parse",
    "cdc_quarantine",
    "stats_report",
    "negative_net_alerts",
    "event_metrics",
]
STREAM = ["stream_merchant_totals"]


def seconds(query, spark, folder) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    times = {}
    for name in BATCH + STREAM:
        query = QUERIES[name]
        seconds(query, spark, folder)
        measured = [seconds(query, spark, folder) for _ in range(runs)]
        times[name] = round(statistics.median(measured), 3)
        print(f"{name}: {times[name]} s", file=sys.stderr)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "events": events,
        "events_per_sec": {name: round(events / t) for name, t in times.items()},
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
