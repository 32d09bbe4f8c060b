"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Each query
runs once to warm up and once for the clock. Results are
computed in full and written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from tidewatch.catalog.queries import QUERIES  # noqa: E402

HEADLINE = [
    "throughput_drop", "latency_spike", "latency_spike_grid", "session_anomalies", "anomaly_reports",
    "tumbling_stats", "sliding_p99", "p99_by_service", "error_rate", "heatmap", "events_per_second",
    "latency_histogram", "events_by_status", "json_round_trip", "decode_quarantine", "dedupe",
    "label_hits", "scale_advice", "report_docs",
    "stream_throughput_drop", "stream_latency_spike_grid", "stream_sessions",
]

MANY_FILES = ["anomaly_reports", "report_docs", "latency_spike", "json_round_trip", "stream_throughput_drop"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))  # one machine; a cluster sets a shared folder
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    # the same events in 16 files: scans are no longer one task
    many = f"{spark.conf.get('spark.checkpoint.dir')}/many"
    events = spark.read.parquet(f"{folder}/events.parquet")
    events.repartition(16).sortWithinPartitions("ts").write.parquet(f"{many}/events.parquet")
    for name in MANY_FILES:
        start = time.perf_counter()
        QUERIES[name](spark, many).write.format("noop").mode("overwrite").save()
        times[f"{name}_16_files"] = round(time.perf_counter() - start, 3)
    rows = events.count()
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")), "input_rows": rows,
        "events_per_sec": {name: round(rows / t) for name, t in times.items()},
    }))


if __name__ == "__main__":
    main()
