"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: the tables (default /root/testdata/sf0.1); BENCH_CPUS: threads of
the local master (default 8); BENCH_RUNS: warm runs of which the median counts
(default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tickloom.plans import catalogue  # noqa: E402
from tickloom.session import session  # noqa: E402

HEADLINE = (
    "market_aggregate_1h",
    "grid_asof_book",
    "event_sync_snapshots",
    "late_events_count",
    "trade_dedup_report",
    "trade_continuity",
    "possible_dropped_estimate",
    "taker_aggregate",
    "rehydrate_merge",
    "book_metrics",
    "book_final_state",
    "book_rank",
    "l3_to_l2",
    "book_state_pruned",
    "tx_match_roles",
    "validate_report",
    "json_frames",
    "symbol_codec",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(f"local[{cpus}]", cpus, spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(took[1:]), 4)
    print(json.dumps({"metric": "headline queries, median of warm runs, summed", "value": round(sum(seconds.values()), 4), "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
