"""Time the headline queries; prints one JSON line.

Data folder: $BENCH_SF_DIR (default /root/testdata/sf0.1); cores: $BENCH_CPUS (default 8).
Each query runs to the end on all rows, into a sink that discards them. Before the clock
starts, each runs once on the smallest data set beside that folder, so that class loading
and code generation are not counted.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from railstream.plans.catalog import QUERIES
from railstream.session import configure

# Streaming queries, file loads and batch operators; one of each kind of work.
HEADLINE = (
    "idle_time_by_station", "headway_by_station", "headway_default_cap", "headway_on_day",
    "busiest_stations_top10", "positions_on_local_day",
    "flatten_vehicle_messages", "flatten_trip_updates", "enrich_positions",
    "prepare_stop_times", "context_windows", "context_windows_join", "context_matrix",
    "split_counts", "train_split_read", "shuffled_samples",
    "monthly_row_counts", "tolerant_csv_load", "archive_expand",
    "stream_windowed_counts", "stream_live_positions",
    "stream_dedupe_positions", "stream_rejects", "stream_flushed_rows",
)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # One machine: driver and executors share this folder.
        .config("spark.checkpoint.dir", scratch)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    names = names or list(HEADLINE)
    small = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            run(name, small)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(name, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")}))
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)


if __name__ == "__main__":
    main(sys.argv[1:])
