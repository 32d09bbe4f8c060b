"""Run the streaming job.

    python -m tidewatch --source kafka --servers host:9092 --topic analytics-events --out /data/incidents
    python -m tidewatch --source files --path /data/json --out /data/incidents --once
    python -m tidewatch --source connector --format NAME --option key=value --column data --out /data/incidents
"""

from __future__ import annotations

import argparse
import dataclasses
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tidewatch.session import prepare
from tidewatch.settings import DEFAULTS, seconds
from tidewatch.sources import ingest
from tidewatch.streaming import pipeline, sinks
from tidewatch.streaming.progress import ProgressRecorder


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidewatch", description="Detect incidents in service events")
    p.add_argument("--source", choices=["kafka", "connector", "files"], default="kafka")
    p.add_argument("--servers", default="localhost:9092", help="Kafka servers")
    p.add_argument("--topic", default=DEFAULTS.topic)
    p.add_argument("--alert-topic", help="also send anomalies to this Kafka topic")
    p.add_argument("--alert-index", help="also store anomalies in this document index")
    p.add_argument("--path", help="folder of JSON lines")
    p.add_argument("--format", help="data source of a connector")
    p.add_argument("--option", action="append", default=[], help="key=value for a connector")
    p.add_argument("--column", default="data", help="text column of a connector")
    p.add_argument("--max-per-trigger", type=int, default=DEFAULTS.max_records_per_trigger, help="Kafka records per batch")
    p.add_argument("--position", choices=["LATEST", "TRIM_HORIZON", "AT_TIMESTAMP"], default="LATEST")
    p.add_argument("--at", help="ISO time for AT_TIMESTAMP")
    p.add_argument("--out", required=True, help="folder of the result tables")
    p.add_argument("--checkpoints", help="folder of the checkpoints (default: below --out)")
    p.add_argument("--spikes", choices=["grid", "exact"], default="grid")
    p.add_argument("--once", action="store_true", help="process what is there, then stop")
    return p.parse_args(argv)


def messages(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, str]:
    """The raw stream and the name of its text column."""
    cfg = dataclasses.replace(DEFAULTS, topic=args.topic)
    if args.source == "kafka":
        at = datetime.fromisoformat(args.at) if args.at else None
        at_ms = int((at if at.tzinfo else at.replace(tzinfo=UTC)).timestamp() * 1000) if at else None
        options = ingest.source_options(args.servers, cfg, args.position, at_ms, args.max_per_trigger)
        return ingest.read_stream(spark, options), "value"
    if args.source == "files":
        return spark.readStream.option("maxBytesPerTrigger", str(cfg.max_bytes_per_trigger)).text(args.path), "value"
    options = dict(o.split("=", 1) for o in args.option)
    return ingest.read_stream(spark, options, args.format), args.column


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    prepare(spark)
    stream, text = messages(spark, args)
    handlers = []
    if args.alert_topic:
        handlers.append(sinks.message_writer(ingest.sink_options(args.servers, args.alert_topic)))
    if args.alert_index:
        handlers.append(sinks.document_writer(sinks.index_options(args.alert_index)))
    alerts = sinks.each(*handlers) if handlers else None
    recorder = ProgressRecorder(spark, f"{args.out}/progress")
    spark.streams.addListener(recorder)
    trigger = {"availableNow": True} if args.once else {"processingTime": seconds(DEFAULTS.trigger_s)}
    queries = pipeline.start(stream, args.out, args.checkpoints or f"{args.out}/checkpoints", alerts=alerts,
                             trigger=trigger, spikes=args.spikes, value=text,
                             arrival="timestamp" if args.source == "kafka" else None)
    if not args.once:
        spark.streams.awaitAnyTermination()
    for q in queries:
        q.awaitTermination()
        recorder.wait(q)
    spark.streams.removeListener(recorder)


if __name__ == "__main__":
    run(SparkSession.builder.appName("tidewatch").getOrCreate(), arguments())
