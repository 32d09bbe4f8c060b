"""Registered queries: name -> (spark, folder) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.catalog import derived
from tidewatch.functions.events import clean_latency, clock_drift_ms, is_server_error, or_unknown, pane_index, pane_time
from tidewatch.functions.text import matches_any
from tidewatch.operators import detectors, heavy, matching, ordering, search, sessions, sketches, windows
from tidewatch.plans import dashboards, evaluation, metrics, reports, scaling
from tidewatch.schemas import EVENT, INDEX_LATENCY_BOUNDS
from tidewatch.session import materialise, naive, new_path, prepare
from tidewatch.settings import Settings
from tidewatch.sources import bulk, ingest, tables
from tidewatch.streaming import compaction, sinks, state
from tidewatch.streaming.batching import report_stream
from tidewatch.streaming.progress import ProgressRecorder
from tidewatch.streaming.runner import latest_rows, run_to_end, stream_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; results get zone-free times and six decimals."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        out = naive(fn(prepare(spark), folder))
        return out.select(*[
            F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in out.schema
        ])

    QUERIES[fn.__name__] = run
    return fn


# --- windows and detectors ---------------------------------------------------------------

@query
def tumbling_stats(spark, folder):
    return windows.tumbling_stats(tables.events(spark, folder), 60)


@query
def sliding_p99(spark, folder):
    return windows.sliding_p99(tables.events(spark, folder))


@query
def throughput_drop(spark, folder):
    return detectors.throughput_drop(tables.events(spark, folder))


@query
def latency_spike(spark, folder):
    return detectors.latency_spike(tables.events(spark, folder))


@query
def latency_spike_grid(spark, folder):
    return detectors.latency_spike(tables.events(spark, folder), method="grid")


@query
def sessions_(spark, folder):
    return sessions.sessions(tables.events(spark, folder, tables.SESSIONS))


QUERIES["sessions"] = QUERIES.pop("sessions_")


@query
def null_service_p99(spark, folder):
    """Events without a service are a group like any other."""
    return windows.sliding_p99(derived.without_service(tables.events(spark, folder)))


@query
def null_service_stats(spark, folder):
    return windows.tumbling_stats(derived.without_service(tables.events(spark, folder)), 60)


@query
def session_anomalies_by_service(spark, folder):
    """Slow means more than twice the mean of the event's service."""
    ev = matching.with_baseline(tables.events(spark, folder, tables.SESSIONS))
    return detectors.session_anomalies(ev, slow=F.col("latency_ms") > 2 * F.col("mu"))


@query
def session_anomalies(spark, folder):
    return detectors.session_anomalies(tables.events(spark, folder, tables.SESSIONS))


def all_anomalies(spark, folder):
    return detectors.anomalies(
        *detectors.window_anomalies(tables.events(spark, folder)),
        detectors.session_anomalies(tables.events(spark, folder, tables.SESSIONS)),
    )


def stored_anomalies(spark, folder):
    """Anomalies as a stored table, as reports read them."""
    return materialise(all_anomalies(spark, folder), "anomalies")


def window_anomalies(spark, folder):
    return detectors.anomalies(*detectors.window_anomalies(tables.events(spark, folder)))


@query
def anomaly_reports(spark, folder):
    return all_anomalies(spark, folder)


# --- sketches -----------------------------------------------------------------------------

def _checked(windows, ev):
    """Which windows keep the stated errors; the values themselves depend on how sketches were merged."""
    checked = sketches.error_of(windows, ev)
    return checked.select(
        "service", "window_start", "window_end", "event_count",
        (F.col("rank_error") <= sketches.RANK_ERROR).alias("p99_within"),
        (F.col("distinct_error") <= sketches.DISTINCT_ERROR).alias("users_within"))


@query
def sketch_windows(spark, folder):
    """Sliding windows of five minutes from stored sketches of 30 seconds."""
    ev = tables.events(spark, folder)
    return _checked(sketches.merged(materialise(sketches.pane_sketches(ev), "sketches"), 10), ev)


@query
def sketch_days(spark, folder):
    """The whole timeline per service, from the same stored sketches."""
    ev = tables.events(spark, folder)
    return _checked(sketches.merged(materialise(sketches.pane_sketches(ev), "sketches"), 2880, 2880), ev)


@query
def stream_sketch_windows(spark, folder):
    """Sketches that a stream stored; panes leave when the watermark passes them."""
    panes = stream_table(sketches.pane_sketches(tables.event_stream(spark, folder)), "sketches")
    ev = tables.events(spark, folder)
    return _checked(sketches.merged(panes, 2, 2), ev).drop("users_within", "p99_within")


@query
def heartbeat_sketch(spark, folder):
    """Active consumers per minute and over the whole time, from HLL sketches: exact at so few."""
    records = derived.shard_records(tables.events(spark, folder)).withColumns({"service": F.col("stream"), "latency_ms": F.lit(None).cast("double")})
    panes = materialise(sketches.pane_sketches(records, "shard_id"), "sketches")
    windows = sketches.merged(panes, 2, 2).unionByName(sketches.merged(panes, 2880, 2880))
    return windows.select("window_start", "window_end", F.col("distinct_keys").alias("active_consumers"))


# --- the same detectors on streams -------------------------------------------------------

@query
def stream_throughput_drop(spark, folder):
    return stream_table(detectors.throughput_drop(tables.event_stream(spark, folder)), "drops")


@query
def throughput_drop_joined(spark, folder):
    return detectors.throughput_drop_joined(tables.events(spark, folder))


@query
def stream_throughput_drop_joined(spark, folder):
    """Drops as a stream-stream join of each window with the next."""
    return stream_table(detectors.throughput_drop_joined(tables.event_stream(spark, folder)), "drops")


@query
def stream_latency_spike(spark, folder):
    return stream_table(detectors.latency_spike(tables.event_stream(spark, folder)), "spikes")


@query
def stream_latency_spike_grid(spark, folder):
    return stream_table(detectors.latency_spike(tables.event_stream(spark, folder), method="grid"), "spikes")


@query
def stream_sessions(spark, folder):
    ev = tables.event_stream(spark, folder, tables.SESSIONS)
    return stream_table(sessions.sessions(ev), "sessions")


@query
def stream_tumbling_stats(spark, folder):
    return stream_table(windows.tumbling_stats(tables.event_stream(spark, folder), 60), "stats")


@query
def stream_sliding_p99(spark, folder):
    return stream_table(windows.sliding_p99(tables.event_stream(spark, folder)), "sliding")


@query
def stream_latency_spike_early(spark, folder):
    """Early alerts: the last state of every window that qualified, finished or not."""
    found = detectors.latency_spike(tables.event_stream(spark, folder), method="early")
    return latest_rows(found, ["service", "window_end"], "early")


@query
def stream_events_by_status(spark, folder):
    """Running totals: the latest state of each counter."""
    totals = metrics.events_by_status(tables.event_stream(spark, folder))
    return latest_rows(totals, ["service", "status"], "status")


@query
def stream_dedupe(spark, folder):
    ev = ingest.dedupe(derived.with_copies(tables.event_stream(spark, folder)))
    return stream_table(ev.select("event_id", "service", "timestamp"), "unique")


@query
def stream_replay_once(spark, folder):
    """Three quarters of the topic, then under a new checkpoint a replay of all of it, some messages twice: each event once."""
    ev = tables.events(spark, folder)
    path = new_path(spark, "replay")
    for run, part in enumerate((ev.where(f"{derived.NUMBER} % 4 <> 3"), derived.with_copies(ev))):
        ingest.encode(part).write.parquet(f"{path}/topic{run}")
        messages = spark.readStream.schema("key string, value string").parquet(f"{path}/topic{run}")
        sinks.store_messages(ingest.decode(messages), f"{path}/events", f"{path}/checkpoint{run}", {"availableNow": True}).awaitTermination()
    return sinks.stored_events(spark, f"{path}/events").select("event_id", "service", "timestamp")


def _compacted(spark, folder):
    """Store and clustered copy: three quarters of the events, half of the dates closed; then the rest, and more dates closed."""
    ev = tables.events(spark, folder, factor=1)
    path = new_path(spark, "compacted")
    for run, (part, before) in enumerate(((ev.where(f"{derived.NUMBER} % 4 <> 3"), date(2024, 1, 16)), (ev, date(2024, 1, 24)))):
        ingest.encode(part).write.parquet(f"{path}/topic{run}")
        messages = spark.readStream.schema("key string, value string").parquet(f"{path}/topic{run}")
        sinks.store_messages(ingest.decode(messages), f"{path}/events", f"{path}/checkpoint{run}", {"availableNow": True}).awaitTermination()
        compaction.compact(spark, f"{path}/events", f"{path}/clustered", before, FILE_ROWS)
    return f"{path}/events", f"{path}/clustered"


FILE_ROWS = 500


@query
def compacted_events(spark, folder):
    """Two services over some days, closed and open ones, from the clustered copy and the store."""
    since, until = (datetime(2024, 1, d, 6, tzinfo=timezone.utc) for d in (5, 26))
    return compaction.clustered_events(spark, *_compacted(spark, folder), since, until, ["user-auth", "search-service"]).select(
        "event_id", "service", "timestamp")


@query
def compacted_files(spark, folder):
    """Events of each closed date, and whether its files are as few as their size allows."""
    _, out = _compacted(spark, folder)
    files = compaction.manifest(spark, out, compaction.version(spark, out))
    return files.groupBy("event_date").agg(F.sum("n").alias("event_count"), F.count(F.lit(1)).alias("files")).select(
        "event_date", "event_count", (F.col("files") <= 2 + 2 * F.ceil(F.col("event_count") / FILE_ROWS)).alias("few_files"))


@query
def stream_late_windows(spark, folder):
    """Four arrivals, one per batch; rows behind the watermark are left out.

    The table is read once and dealt out to the arrivals; each is written in parallel, as many files as a batch takes.
    """
    ev = derived.with_arrival(tables.events(spark, folder))
    path, files = new_path(spark, "arrivals"), 4
    ev.withColumn("batch", F.expr("least(minute(arrival) div 8, 3)")).drop("arrival").write.partitionBy("batch").parquet(f"{path}/all")
    for batch in range(4):
        arrived = spark.read.schema(EVENT).parquet(f"{path}/all/batch={batch}")
        arrived.repartition(files).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files).parquet(f"{path}/in")
    return stream_table(windows.events_per_window(ingest.with_watermark(stream), 60, ["service"]), "late")


@query
def stream_bulk_documents(spark, folder):
    """Documents of a stream's published bulk bodies, and whether their body keeps to 500."""
    path = new_path(spark, "bulk")
    bulk.register(spark)
    sent = tables.event_stream(spark, folder).select("event_id", "service", "timestamp").writeStream.format("bulk").options(
        path=f"{path}/out", index="events", id="event_id")
    sent.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    small = bulk.published(spark, f"{path}/out").select("body", (F.col("documents") <= 500).alias("within"))
    return bulk.documents(spark, f"{path}/out", "event_id string, service string, timestamp timestamp").join(small, "body").select(
        F.col("_id").alias("document_id"), "event_id", "service", "timestamp", "within")


def _checkpoint(stream, name):
    """The checkpoint of a stream that has run to its end."""
    path = new_path(stream.sparkSession, name)
    run_to_end(stream, f"{path}/rows", f"{path}/checkpoint")
    return f"{path}/checkpoint"


@query
def open_sessions(spark, folder):
    """Sessions that a stream still holds at its end, from its state."""
    ev = tables.event_stream(spark, folder, tables.SESSIONS)
    return state.open_sessions(spark, _checkpoint(sessions.sessions(ev), "open_sessions"))


@query
def open_windows(spark, folder):
    """Minutes that a stream still holds at its end, from its state."""
    counts = windows.events_per_window(tables.event_stream(spark, folder), 60, ["service"])
    return state.open_windows(spark, _checkpoint(counts, "open_windows"))


def _recorded(spark, folder):
    """The progress table of a stream that has run to its end."""
    counts = windows.events_per_window(tables.event_stream(spark, folder), 60, ["service"])
    path = new_path(spark, "progress")
    recorder = ProgressRecorder(spark, f"{path}/progress")
    spark.streams.addListener(recorder)
    try:
        recorder.wait(run_to_end(counts, f"{path}/rows", f"{path}/checkpoint", name="events_per_minute"))
    finally:
        spark.streams.removeListener(recorder)
    return recorder.table()


@query
def stream_progress(spark, folder):
    """Rows read per source, from the stored progress of a stream."""
    return _recorded(spark, folder).groupBy("source").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


@query
def write_time_histogram(spark, folder):
    """Times of a stream's writes, as measured."""
    return metrics.histogram(_recorded(spark, folder), "source", "add_batch_ms", INDEX_LATENCY_BOUNDS)


# --- dashboards and searches --------------------------------------------------------------

@query
def events_per_second(spark, folder):
    return dashboards.events_per_second(tables.events(spark, folder))


@query
def event_rate(spark, folder):
    return dashboards.event_rate(tables.events(spark, folder))


@query
def anomaly_counts(spark, folder):
    return dashboards.anomaly_counts(all_anomalies(spark, folder))


@query
def p99_by_service(spark, folder):
    return dashboards.p99_by_service(tables.events(spark, folder))


@query
def error_rate(spark, folder):
    return dashboards.error_rate(tables.events(spark, folder))


@query
def heatmap(spark, folder):
    return dashboards.heatmap(tables.events(spark, folder))


@query
def heatmap_grid(spark, folder):
    return dashboards.heatmap_grid(derived.without_service(tables.events(spark, folder), "billing"))


@query
def active_anomalies(spark, folder):
    ev = tables.events(spark, folder)
    found = detectors.anomalies(*detectors.window_anomalies(ev), detectors.session_anomalies(ev))
    return dashboards.active_anomalies(found, dashboards.latest(ev))


@query
def summary_table(spark, folder):
    return dashboards.summary_table(reports.report_docs(stored_anomalies(spark, folder)))


@query
def recent_events(spark, folder):
    ev = tables.events(spark, folder, tables.SESSIONS, last_s=3600)
    hour = dashboards.last_hour(ev, dashboards.latest(ev))
    return dashboards.event_search(hour).orderBy(F.desc("timestamp"), "event_id")


@query
def recent_page(spark, folder):
    """Second page of ten of the newest events."""
    found = dashboards.event_search(tables.events(spark, folder))
    return ordering.page(found, [F.desc("timestamp"), F.col("event_id")], 2, 10)


@query
def filtered_events(spark, folder):
    ev = tables.events(spark, folder)
    return dashboards.event_search(ev, "service = 'payment-gateway' and latency_ms > 200")


@query
def top_services(spark, folder):
    counts = tables.events(spark, folder).groupBy("region", "service").agg(F.count(F.lit(1)).alias("event_count"))
    return ordering.top_k(counts, ["region"], [F.desc("event_count"), F.col("service")], 3)


def _callers(spark, folder):
    """Two thirds of the events under a few hundred keys, the rest under one for each user."""
    return tables.events(spark, folder).withColumn("caller", F.expr(
        f"if({derived.NUMBER} % 3 = 0, concat('user ', user_id), concat_ws(' ', region, service, event_type))"))


@query
def top_callers(spark, folder):
    """The eight most frequent callers, from stored summaries of each minute."""
    ev = _callers(spark, folder)
    return heavy.top_keys(ev, "caller", panes=materialise(heavy.pane_summaries(ev, "caller"), "summaries"))


@query
def top_users(spark, folder):
    """No user is heavy here, so all are counted."""
    return heavy.top_keys(tables.events(spark, folder), "user_id", tracked=64)


@query
def summaries(spark, folder):
    """Saved search over the summaries, newest first."""
    docs = reports.report_docs(stored_anomalies(spark, folder))
    return dashboards.summary_search(docs).orderBy(F.desc("generated_at"))


@query
def summary_keywords(spark, folder):
    docs = reports.report_docs(stored_anomalies(spark, folder))
    return dashboards.summary_search(docs, matches_any(F.col("summary"), "the outage or partition"))


# --- metrics, lag, scaling, alerts ----------------------------------------------------------

@query
def summary_search_ranked(spark, folder):
    """The ten summaries that fit a search best, by BM25 over an inverted index; a summary's id is the digest of its text."""
    docs = reports.report_docs(dense_anomalies(spark, folder))
    path = new_path(spark, "index")
    search.build_index(docs.withColumn("id", F.md5("summary")), "id", "summary", path)
    return search.search(spark, path, "throughput of the payment gateway and search service, nothing sent")


@query
def events_by_status(spark, folder):
    return metrics.events_by_status(tables.events(spark, folder))


@query
def summaries_by_model(spark, folder):
    return metrics.summaries_by_model(reports.report_docs(stored_anomalies(spark, folder)))


@query
def latency_histogram(spark, folder):
    return metrics.histogram(tables.events(spark, folder), "service")


@query
def index_latency_histogram(spark, folder):
    writes = tables.events(spark, folder).withColumn("index_pattern", F.concat(F.lit("events-"), "event_type"))
    return metrics.histogram(writes, "index_pattern", bounds=INDEX_LATENCY_BOUNDS)


@query
def metric_points(spark, folder):
    found = stored_anomalies(spark, folder)
    docs = reports.report_docs(found)
    space = "StreamingAnalytics"
    points = (
        metrics.metric_points(space, "EventLatencyMs", tables.events(spark, folder), "latency_ms",
                              ["service"], "Milliseconds")
        .unionByName(metrics.metric_points(space, "AnomaliesDetected", found, F.lit(1.0),
                                           ["service", "anomaly_type"]))
        .unionByName(metrics.metric_points(space, "LLMSummariesGenerated", docs, F.lit(1.0), ["model"]))
    )
    return points.withColumn("dimensions", F.to_json("dimensions"))


@query
def delivery_rate(spark, folder):
    return metrics.delivery_rate(derived.delivery_reports(tables.events(spark, folder)))


@query
def delivery_total(spark, folder):
    return metrics.delivery_total(derived.delivery_reports(tables.events(spark, folder)))


@query
def consumer_lag(spark, folder):
    ev = tables.events(spark, folder)
    return metrics.consumer_lag(derived.offsets(ev), derived.commits(ev))


@query
def lag_alerts(spark, folder):
    ev = tables.events(spark, folder)
    return metrics.lag_alerts(metrics.consumer_lag(derived.offsets(ev), derived.commits(ev)))


@query
def lag_alerts_low(spark, folder):
    ev = tables.events(spark, folder)
    lag = metrics.consumer_lag(derived.offsets(ev), derived.commits(ev))
    return metrics.lag_alerts(lag, Settings(lag_alert=20))


@query
def last_offset_gauge(spark, folder):
    """The last committed offset per partition, as a gauge shows it."""
    ev = tables.events(spark, folder)
    return metrics.last_value(derived.commits(ev), ["topic", "partition"], "offset", "timestamp")


@query
def shard_lag(spark, folder):
    return metrics.shard_lag(derived.reads(tables.events(spark, folder)))


@query
def anomaly_rate(spark, folder):
    return metrics.anomaly_rate(tables.events(spark, folder))


@query
def anomaly_rate_alerts(spark, folder):
    return metrics.anomaly_rate_alerts(tables.events(spark, folder))


@query
def anomaly_rate_alerts_high(spark, folder):
    return metrics.anomaly_rate_alerts(tables.events(spark, folder), Settings(anomaly_rate_alert=0.22))


@query
def shard_active(spark, folder):
    return scaling.active_shards(derived.shard_list(tables.events(spark, folder)))


@query
def shard_diff(spark, folder):
    ev = tables.events(spark, folder)
    return scaling.shard_diff(scaling.active_shards(derived.shard_list(ev)), derived.consumers(ev))


@query
def consumer_heartbeat(spark, folder):
    return scaling.consumer_heartbeat(derived.shard_records(tables.events(spark, folder)))


@query
def scale_advice(spark, folder):
    records = derived.with_idle_shard(derived.shard_records(tables.events(spark, folder)))
    return scaling.scale_advice(scaling.utilisation(records, derived.capacity(records)))


# --- transport ------------------------------------------------------------------------------

@query
def decode_quarantine(spark, folder):
    decoded = ingest.decode(derived.messages(tables.events(spark, folder)))
    return ingest.rejected(decoded).groupBy("key", "reason").agg(F.count(F.lit(1)).alias("records"))


@query
def strict_gate(spark, folder):
    decoded = ingest.decode(derived.messages(tables.events(spark, folder)))
    return decoded.where("reason <> 'malformed'").select(F.col("event.event_id").alias("event_id"), "reason")


@query
def time_gate(spark, folder):
    """Times that no clock can have sent; all else is accepted."""
    decoded = ingest.decode(derived.with_bad_times(ingest.encode(tables.events(spark, folder))))
    return decoded.groupBy("reason", F.year("event.timestamp").alias("year")).agg(F.count(F.lit(1)).alias("records"))


@query
def required_fields(spark, folder):
    decoded = ingest.decode(derived.messages(tables.events(spark, folder)))
    return evaluation.required_violations(ingest.accepted(decoded))


@query
def json_round_trip(spark, folder):
    back = ingest.accepted(ingest.decode(ingest.encode(tables.events(spark, folder))))
    return back.select("*", "metadata.client", "metadata.version").drop("metadata")


@query
def dedupe(spark, folder):
    ev = ingest.dedupe(derived.with_copies(tables.events(spark, folder)))
    return ev.select("event_id", "service", "timestamp")


@query
def null_id_dedupe(spark, folder):
    """Events without an id are kept, their copies are not."""
    ev = ingest.dedupe(derived.with_copies(tables.events(spark, folder)).transform(derived.without_id))
    return ev.select("event_id", "service", "timestamp")


def _resume(spark, folder, position):
    ev = tables.events(spark, folder)
    at = F.lit("2024-01-01 00:20:00").cast("timestamp")
    marks = materialise(derived.checkpoints(ev), "checkpoints")
    todo = ingest.after_checkpoint(derived.shard_records(ev), marks, position, at)
    return todo.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("records"), F.min("sequence_number").alias("first_sequence"),
        F.max("sequence_number").alias("last_sequence"))


@query
def shard_resume(spark, folder):
    return _resume(spark, folder, "TRIM_HORIZON")


@query
def shard_resume_latest(spark, folder):
    return _resume(spark, folder, "LATEST")


@query
def shard_resume_at_time(spark, folder):
    return _resume(spark, folder, "AT_TIMESTAMP")


# --- fields ---------------------------------------------------------------------------------

@query
def clock_drift(spark, folder):
    ev = tables.events(spark, folder).withColumn("epoch_ms", F.expr(f"epoch_ms - {derived.NUMBER} % 5"))
    return ev.groupBy(clock_drift_ms().alias("drift_ms")).agg(F.count(F.lit(1)).alias("event_count"))


@query
def client_versions(spark, folder):
    return tables.events(spark, folder).groupBy("metadata.client", "metadata.version").agg(
        F.count(F.lit(1)).alias("event_count"))


@query
def unknown_services(spark, folder):
    ev = tables.events(spark, folder).withColumn("service", F.expr(f"if({derived.NUMBER} % 10 = 4, null, service)"))
    return ev.groupBy(or_unknown("service").alias("service")).agg(F.count(F.lit(1)).alias("event_count"))


@query
def clean_latencies(spark, folder):
    return tables.events(spark, folder).select("event_id", clean_latency(F.col("latency_ms") / 3).alias("latency_ms"))


@query
def server_errors(spark, folder):
    return tables.events(spark, folder).where(is_server_error()).groupBy(
        "service", "event_type", "status_code").agg(F.count(F.lit(1)).alias("event_count"))


# --- evaluation -----------------------------------------------------------------------------

@query
def baseline_zscore(spark, folder):
    return matching.with_baseline(tables.events(spark, folder)).select("event_id", "service", "mu", "sigma", "zscore")


@query
def label_violations(spark, folder):
    return evaluation.label_violations(tables.events(spark, folder))


def _labelled(spark, folder, inside):
    ev = tables.events(spark, folder).where("is_anomaly")
    found = materialise(window_anomalies(spark, folder), "windows")
    return matching.in_windows(ev, found, inside).select("event_id", "service", "timestamp", "anomaly_type")


@query
def label_hits(spark, folder):
    return _labelled(spark, folder, True)


@query
def label_misses(spark, folder):
    return _labelled(spark, folder, False)


# --- reports --------------------------------------------------------------------------------

@query
def report_batches(spark, folder):
    return reports.report_batches(stored_anomalies(spark, folder)).select(
        "batch_window", "batch_no", "position", "service", "anomaly_type", "window_start", "session_key")


@query
def batch_prompts(spark, folder):
    return reports.batch_prompts(reports.report_batches(stored_anomalies(spark, folder))).drop("detected_at")


@query
def report_docs(spark, folder):
    return reports.report_docs(stored_anomalies(spark, folder))


#: Low thresholds on one timeline: report windows of more than ten records, of several types and services.
DENSE = Settings(drop_threshold=0.05, spike_multiplier=1.02, spike_min_events=5, session_score=0.5, session_min_events=2)


def dense_anomalies(spark, folder):
    ev = tables.events(spark, folder)
    found = detectors.anomalies(*detectors.window_anomalies(ev, DENSE), detectors.session_anomalies(ev, cfg=DENSE))
    return materialise(found, "anomalies")


@query
def report_batches_dense(spark, folder):
    return reports.report_batches(dense_anomalies(spark, folder)).select(
        "batch_window", "batch_no", "position", "service", "anomaly_type", "window_start", "session_key")


@query
def stream_report_batches(spark, folder):
    """The same batches from a stream of anomalies; what is left of a window leaves when the watermark passes its end."""
    stored = dense_anomalies(spark, folder)
    stream = spark.readStream.schema(stored.schema).parquet(stored.written_to).withWatermark("detected_at", "10 seconds")
    return stream_table(report_stream(stream, live=False), "report_batches").select(
        "batch_window", "batch_no", "position", "service", "anomaly_type", "window_start", "session_key")


@query
def batch_prompts_dense(spark, folder):
    return reports.batch_prompts(reports.report_batches(dense_anomalies(spark, folder))).drop("detected_at")


@query
def report_docs_dense(spark, folder):
    return reports.report_docs(dense_anomalies(spark, folder))


@query
def summary_table_dense(spark, folder):
    return dashboards.summary_table(reports.report_docs(dense_anomalies(spark, folder)))


@query
def summary_table_busy(spark, folder):
    """Reports by the two minutes they were made in: many for a service, and more than ten times."""
    docs = reports.report_docs(dense_anomalies(spark, folder))
    return dashboards.summary_table(docs.withColumn("generated_at", pane_time(pane_index("generated_at", 120), 120)))


@query
def missed_events(spark, folder):
    return reports.missed_events(all_anomalies(spark, folder))


@query
def prior_incidents(spark, folder):
    return reports.prior_incidents(stored_anomalies(spark, folder)).select(
        "service", "anomaly_type", "window_start", "session_key", "detected_at", "prior_count")


@query
def similar_incidents(spark, folder):
    """How many earlier report batches share at least half of the features."""
    return reports.similar_incidents(dense_anomalies(spark, folder), DENSE)
