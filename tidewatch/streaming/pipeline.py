"""The whole job: decode messages, store events, detect, alert and report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators import detectors
from tidewatch.operators.matching import with_baseline
from tidewatch.settings import DEFAULTS, Settings, seconds
from tidewatch.sources.ingest import decode, with_watermark
from tidewatch.streaming import sinks
from tidewatch.streaming.batching import report_stream


def _start(stream: DataFrame, name: str, handler: sinks.BatchHandler, checkpoints: str,
           trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.queryName(name).outputMode("append")
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .foreachBatch(handler).trigger(**trigger).start()
    )


def start(messages: DataFrame, out: str, checkpoints: str, cfg: Settings = DEFAULTS,
          alerts: sinks.BatchHandler | None = None, trigger: dict | None = None,
          spikes: str = "grid", value: str = "value", arrival: str | None = None) -> list[StreamingQuery]:
    """Start the store of events and rejected messages, one query per detector, and the reports.

    Messages are read and decoded once. The detectors follow the store: they read
    only the columns they need, each with its own state and checkpoint, and can be
    restarted alone. ``arrival`` names the messages' own arrival time, if they have one. ``alerts`` receives each batch of anomalies, for a topic or an index.
    """
    spark = messages.sparkSession
    trigger = trigger or {"processingTime": seconds(cfg.trigger_s)}
    queries = [
        sinks.store_messages(decode(messages, value, arrival, cfg), f"{out}/events", f"{checkpoints}/events", trigger, value, cfg=cfg),
    ]
    if "availableNow" in trigger:  # one pass: the store is complete before the detectors read it
        queries[0].awaitTermination()
    stored = sinks.stored_stream(spark, f"{out}/events", cfg.max_bytes_per_trigger)
    found = detect(stored, out, checkpoints, cfg, alerts, trigger, spikes)
    queries += found
    once = "availableNow" in trigger
    for q in found if once else []:
        q.awaitTermination()
    # one report stream over the anomalies of all detectors; running on, its batches fill up across triggers
    anomalies = sinks.anomaly_stream(spark, f"{out}/anomalies")
    writer = sinks.summary_writer(f"{out}/summaries", f"{out}/incident_counts", cfg)
    if once:
        queries.append(_start(anomalies, "reports", writer, checkpoints, trigger))
    else:
        queries.append(_start(report_stream(anomalies, cfg), "reports_live", writer, checkpoints, trigger))
    return queries


def detect(events: DataFrame, out: str, checkpoints: str, cfg: Settings, alerts: sinks.BatchHandler | None,
           trigger: dict, spikes: str) -> list[StreamingQuery]:
    """One query per detector: anomalies and alerts. A call is slow if it takes more than twice its service's mean.

    The store holds each event once, so no detector keeps ids in its state.
    """
    ev = with_watermark(events, cfg)
    found = {
        "drops": detectors.throughput_drop(ev, cfg),
        "spikes": detectors.latency_spike(ev, cfg, spikes),
        "sessions": detectors.session_anomalies(
            with_baseline(ev), slow=F.col("latency_ms") > cfg.slow_factor * F.col("mu"), cfg=cfg),
    }
    queries = []
    for name, anomalies in found.items():
        handlers = [sinks.table_writer(f"{out}/anomalies/detector={name}")]
        if alerts:
            handlers.append(alerts)
        queries.append(_start(detectors.as_anomalies(anomalies), name, sinks.each(*handlers), checkpoints, trigger))
    return queries
