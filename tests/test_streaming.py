import json
import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from tests.helpers import T0, event, file_stream, run_batches, table, write_files
from tidewatch.operators import detectors, windows
from tidewatch.operators.sessions import sessions
from tidewatch.sources import ingest
from tidewatch.streaming import pipeline, sinks
from tidewatch.streaming.progress import ProgressRecorder
from tidewatch.streaming.runner import run_to_end


def files_of(rows, n):
    """Rows in time order, cut into n files."""
    rows = sorted(rows, key=lambda r: r["timestamp"])
    size = -(-len(rows) // n)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def busy_rows():
    rows = [event(i, T0 + timedelta(seconds=i), "a" if i % 3 else "b", 20.0 + i % 7, session=f"s{i % 5}")
            for i in range(1800) if not 600 <= i < 660 or i % 3]
    for r in rows:
        if 900 <= (r["timestamp"] - T0).total_seconds() < 1100 and r["service"] == "a":
            r["latency_ms"] *= 9
    return rows


def same(got, want):
    def key(r):
        return json.dumps(r, default=str, sort_keys=True)

    assert sorted(map(key, got)) == sorted(map(key, want))


def test_each_detector_gives_the_same_rows_on_a_stream(spark, tmp_path):
    rows = busy_rows()
    write_files(spark, tmp_path / "in", files_of(rows, 4))
    plain = table(spark, rows)
    operators = {
        "drops": detectors.throughput_drop,
        "spikes": detectors.latency_spike,
        "grid": lambda e: detectors.latency_spike(e, method="grid"),
        "sessions": sessions,
    }
    for name, run in operators.items():
        stream = ingest.with_watermark(file_stream(spark, tmp_path / "in"))
        got, _ = run_batches(run(stream), tmp_path / name / "rows", tmp_path / name / "ck")
        want = [r.asDict() for r in run(plain).collect()]
        assert want or name == "sessions"
        same([_rounded(r) for r in got], [_rounded(r) for r in want])


def _rounded(row):
    return {k: round(v, 6) if isinstance(v, float) else v for k, v in row.items()}


def test_late_rows_leave_by_the_previous_watermark(spark, tmp_path):
    batches = [["0:00:30", "0:05:00"], ["0:04:55", "0:05:05"], ["0:01:20", "0:04:52", "0:09:00"]]
    ids = iter(range(100))
    write_files(spark, tmp_path / "in", [[event(next(ids), t) for t in b] for b in batches])
    stream = ingest.with_watermark(file_stream(spark, tmp_path / "in"))
    recorder = ProgressRecorder(spark, str(tmp_path / "progress"))
    spark.streams.addListener(recorder)
    got, query = run_batches(windows.events_per_window(stream, 60), tmp_path / "out", tmp_path / "ck")
    recorder.wait(query)
    spark.streams.removeListener(recorder)
    counts = {str(r["window_start"])[11:16]: r["event_count"] for r in got}
    assert counts == {"00:00": 1, "00:04": 2, "00:05": 2}
    assert recorder.table().agg(F.sum("late_rows")).first()[0] == 1


def test_progress_of_more_batches_than_spark_remembers(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    recorder = ProgressRecorder(spark, str(tmp_path / "progress"))
    try:
        write_files(spark, tmp_path / "in", [[event(f"{n}-{i}", T0 + timedelta(seconds=n)) for i in range(5)] for n in range(8)])
        spark.streams.addListener(recorder)
        recorder.wait(run_batches(file_stream(spark, tmp_path / "in"), tmp_path / "out", tmp_path / "ck")[1])
    finally:
        spark.streams.removeListener(recorder)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert recorder.table().agg(F.sum("input_rows")).first()[0] == 40


def test_duplicates_are_kept_once(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[event("x", "0:00:01"), event("y", "0:00:02")],
                                         [event("x", "0:00:01"), event("z", "0:00:03")]])
    stream = ingest.dedupe(ingest.with_watermark(file_stream(spark, tmp_path / "in")))
    got, _ = run_batches(stream.select("event_id"), tmp_path / "out", tmp_path / "ck")
    assert sorted(r["event_id"] for r in got) == ["x", "y", "z"]


def test_restart_continues_without_loss_or_repetition(spark, tmp_path):
    parts = files_of(busy_rows(), 3)

    def counts():
        stream = ingest.with_watermark(file_stream(spark, tmp_path / "in"))
        return run_batches(windows.events_per_window(stream, 60), tmp_path / "out", tmp_path / "ck")[0]

    write_files(spark, tmp_path / "in", parts[:1])
    first = counts()
    write_files(spark, tmp_path / "in", parts[1:])
    rows = counts()
    assert 0 < len(first) < len(rows)
    assert len({r["window_start"] for r in rows}) == len(rows)
    plain = {r["window_start"]: r["event_count"]
             for r in windows.events_per_window(table(spark, busy_rows()), 60).collect()}
    assert all(plain[r["window_start"]] == r["event_count"] for r in rows)
    assert len(rows) == len(plain) - 1  # the last window is still open


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = sinks.table_writer(str(tmp_path))
    batch = table(spark, [event(1, "0:00:01")])
    write(batch, 7)
    write(batch, 7)
    write(batch, 8)
    assert spark.read.parquet(str(tmp_path)).count() == 2


def test_event_store_is_split_by_date(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[event(1, "0:00:01"), event(2, "25:00:00")]])
    out = str(tmp_path / "out")
    for _ in range(2):  # a second run finds nothing new
        decoded = file_stream(spark, tmp_path / "in").select(
            F.struct("*").alias("event"), F.lit(None).cast("string").alias("reason"), F.lit("").alias("value"))
        sinks.store_messages(decoded, out, str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
    assert sinks.stored_events(spark, out).count() == 2
    later = sinks.stored_events(spark, out, since=T0 + timedelta(hours=24))
    assert [r.event_id for r in later.collect()] == ["2"]
    assert sinks.stored_events(spark, out, until=T0 + timedelta(hours=24)).count() == 1
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_failed_summaries_do_not_stop_the_stream(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    from tests.helpers import anomaly_table

    batch = anomaly_table(spark, [{"service": "a", "anomaly_type": "throughput_drop", "detected_at": T0,
                                   "window_start": T0, "window_end": T0}])
    sinks.summary_writer(str(blocked))(batch, 0)  # logs, does not raise, keeps the batch
    assert spark.read.parquet(f"{blocked}_failed").count() == 1


def test_whole_job(spark, tmp_path):
    rows = busy_rows()
    messages = ingest.encode(table(spark, rows)).unionByName(
        spark.createDataFrame([("a", "{bad"), ("a", '{"zz": 1}')], "key string, value string"))
    messages.coalesce(1).write.parquet(str(tmp_path / "in"))

    def alerts(batch, batch_id):  # a folder per call, as file writers cannot share one at a time
        sinks.message_writer({"path": str(tmp_path / "alerts" / uuid.uuid4().hex)}, "parquet")(batch, batch_id)

    recorder = ProgressRecorder(spark, str(tmp_path / "progress"))
    spark.streams.addListener(recorder)
    stream = spark.readStream.schema("key string, value string").parquet(str(tmp_path / "in"))
    queries = pipeline.start(stream, str(tmp_path / "out"), str(tmp_path / "ck"), alerts=alerts,
                             trigger={"availableNow": True}, spikes="exact")
    for q in queries:
        q.awaitTermination()
    out = str(tmp_path / "out")
    assert sinks.stored_events(spark, f"{out}/events").count() == len(rows)
    bad = sorted((r.reason, r.message) for r in sinks.quarantine(spark, f"{out}/events").collect())
    assert bad == [("malformed", "{bad"), ("unknown_field", '{"zz": 1}')]
    plain = table(spark, rows)
    want = detectors.anomalies(detectors.throughput_drop(plain), detectors.latency_spike(plain))
    got = spark.read.parquet(f"{out}/anomalies").where("detector in ('drops', 'spikes')")
    assert got.count() == want.count() > 0
    assert got.select("service", "window_end").exceptAll(want.select("service", "window_end")).isEmpty()
    assert spark.read.parquet(str(tmp_path / "alerts" / "*")).count() >= got.count()
    docs = spark.read.parquet(f"{out}/summaries")
    assert docs.agg(F.sum("anomaly_count")).first()[0] == spark.read.parquet(f"{out}/anomalies").count()
    assert docs.where("summary like '%throughput_drop%'").count() > 0
    for q in queries:
        recorder.wait(q)
    spark.streams.removeListener(recorder)
    read = recorder.table().where("source = 'events'").agg(F.sum("input_rows")).first()[0]
    assert read == len(rows) + 2  # every message was read once
    assert {"events", "drops", "spikes", "sessions", "reports"} <= {
        r.source for r in recorder.table().collect()}
    for folder in (tmp_path / "out").rglob("batch_id=*"):  # no folder without rows
        assert spark.read.parquet(str(folder)).count() > 0


def test_one_event_of_the_far_future_silences_nothing(spark, tmp_path):
    rows = busy_rows()
    wild = [event("f", T0.replace(year=2999)), event("p", T0.replace(year=1970))]
    for k, part in enumerate([wild, *files_of(rows, 2)]):  # the wild times come first
        ingest.encode(table(spark, part)).select("value").coalesce(1).write.text(str(tmp_path / "json" / str(k)))
    stream = spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).text(str(tmp_path / "json"))
    out = str(tmp_path / "out")
    for q in pipeline.start(stream, out, str(tmp_path / "ck"), trigger={"availableNow": True}):
        q.awaitTermination()
    assert sinks.stored_events(spark, f"{out}/events").count() == len(rows)
    assert [r.reason for r in sinks.quarantine(spark, f"{out}/events").collect()] == ["implausible_time"] * 2
    want = detectors.throughput_drop(table(spark, rows)).count()
    assert spark.read.parquet(f"{out}/anomalies").where("detector = 'drops'").count() == want > 0


def anomalies_of(spark, numbers):
    from tests.helpers import anomaly_table

    kinds = ["throughput_drop", "latency_spike", "session_anomaly"]
    return anomaly_table(spark, [{"service": "abcd"[i % 4], "anomaly_type": kinds[i % 3], "detected_at": T0 + timedelta(seconds=i),
                                  "window_start": T0, "window_end": T0, "session_key": f"s{i}"} for i in numbers])


def test_reports_fill_up_across_triggers_and_restarts(spark, tmp_path):
    """23 records of one report window in three files, a stop in between: 10, 10 and, after the wait, 3."""
    import time

    from tidewatch.settings import Settings
    from tidewatch.streaming.batching import report_stream

    cfg = Settings(report_wait_s=12)
    stream = sinks.anomaly_stream(spark, str(tmp_path / "in"))
    left, sizes = {}, []

    def started():
        return (report_stream(stream, cfg).writeStream.option("checkpointLocation", str(tmp_path / "ck"))
                .foreachBatch(lambda batch, number: left.update({number: batch.collect()})).trigger(processingTime="1 second").start())

    def stored():
        out = {}
        for r in [r for rows in list(left.values()) for r in rows]:
            out.setdefault((r.batch_window, r.batch_no), []).append(r.session_key)
        return out

    def until(batches, query):
        end = time.time() + 90
        while len(stored()) < batches and time.time() < end:
            assert query.exception() is None
            time.sleep(0.5)
        sizes.append(sorted(map(len, stored().values()), reverse=True))

    cuts = [range(0, 8), range(8, 16), range(16, 23)]
    anomalies_of(spark, cuts[0]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / "detector=drops" / "batch_id=0"))
    anomalies_of(spark, cuts[1]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / "detector=spikes" / "batch_id=0"))
    query = started()
    until(1, query)
    query.stop()
    anomalies_of(spark, cuts[2]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / "detector=sessions" / "batch_id=0"))
    query = started()
    until(3, query)
    query.stop()
    assert sizes[-1] == [10, 10, 3]
    assert sorted(k for keys in stored().values() for k in keys) == sorted(f"s{i}" for i in range(23))


def test_counts_of_a_failed_report_are_kept_and_old_folders_go(spark, tmp_path):
    (tmp_path / "blocked").write_text("not a folder")
    counts = str(tmp_path / "counts")
    sinks.summary_writer(str(tmp_path / "blocked"), counts)(anomalies_of(spark, range(6)), 0)
    assert spark.read.parquet(str(tmp_path / "blocked_failed")).count() == 6
    report = sinks.summary_writer(str(tmp_path / "summaries"), counts)
    for k in (1, 2, 2, 5):  # a batch that is repeated finds the same totals
        report(anomalies_of(spark, range(100 * k, 100 * k + 12)), k)
    assert sorted(p.name for p in (tmp_path / "counts").glob("batch_id=*")) == ["batch_id=2", "batch_id=5"]
    assert sinks.running_counts(spark, counts, 9).agg(F.sum("n")).first()[0] == 6 + 3 * 12
    texts = spark.read.parquet(str(tmp_path / "summaries")).where("batch_id = 5").collect()
    assert texts and not any(r.summary.endswith("of the kind: 0") for r in texts)


def test_joined_drops_see_total_outages(spark, tmp_path):
    rows = [r for r in busy_rows() if not (300 <= (r["timestamp"] - T0).total_seconds() < 420 and r["service"] == "a")]
    rows += [event(f"n{i}", T0 + timedelta(seconds=i), None) for i in range(0, 1500, 2) if not 720 <= i < 780]
    write_files(spark, tmp_path / "in", files_of(rows, 3))
    stream = ingest.with_watermark(file_stream(spark, tmp_path / "in"))
    got, _ = run_batches(detectors.throughput_drop_joined(stream), tmp_path / "out", tmp_path / "ck")
    plain = table(spark, rows)
    want = [r.asDict() for r in detectors.throughput_drop(plain).collect()]
    same([_rounded(r) for r in got], [_rounded(r) for r in want])
    same([_rounded(r.asDict()) for r in detectors.throughput_drop_joined(plain).collect()], [_rounded(r) for r in want])
    assert {r["service"] for r in want if r["drop_pct"] == 100} >= {"a", None}


def test_a_replay_of_the_whole_topic_adds_no_event(spark, tmp_path):
    from tidewatch.settings import Settings

    rows = [event(i, T0 + timedelta(hours=i), latency=float(i)) for i in range(60)]
    rows += [event(None, T0 + timedelta(hours=i), latency=float(i)) | {"event_id": None} for i in range(5)]
    rows.append(event("no time", T0) | {"timestamp": None})
    topic = ingest.encode(table(spark, rows)).select("value")
    topic.where("length(value) > 0").repartition(2).write.text(str(tmp_path / "first"))
    topic.unionAll(topic).unionAll(spark.createDataFrame([("{bad",)], "value string")).repartition(2).write.text(str(tmp_path / "again"))
    out = str(tmp_path / "out")
    for blocks in (Settings(), Settings(bloom_blocks=1)):  # one block: every event may be a copy, so all are looked up
        for k, folder in enumerate(("first", "again")):
            stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / folder))
            sinks.store_messages(ingest.decode(stream), f"{out}{blocks.bloom_blocks}", str(tmp_path / f"ck{k}{blocks.bloom_blocks}"),
                                 {"availableNow": True}, cfg=blocks).awaitTermination()
        stored = sinks.stored_events(spark, f"{out}{blocks.bloom_blocks}")
        assert stored.count() == len(rows) == stored.distinct().count()
        assert [r.message for r in sinks.quarantine(spark, f"{out}{blocks.bloom_blocks}").collect()] == ["{bad"]


def test_documents_go_to_a_bulk_sink(spark, tmp_path):
    options = sinks.index_options("anomalies", id_column="event_id")
    assert options["es.batch.size.entries"] == "500" and options["es.mapping.id"] == "event_id"
    sinks.document_writer({"path": str(tmp_path / "index")}, "parquet")(table(spark, [event(1, "0:00:01")]), 0)
    assert spark.read.parquet(str(tmp_path / "index")).count() == 1


def test_reports_join_detectors_and_cut_batches_of_ten(spark, tmp_path):
    from tests.helpers import anomaly_table

    rows = [{"service": "ab"[i % 2], "anomaly_type": ["throughput_drop", "latency_spike"][i % 2], "detected_at": T0 + timedelta(seconds=i),
             "window_start": T0, "window_end": T0} for i in range(23)]
    sinks.summary_writer(str(tmp_path / "s"))(anomaly_table(spark, rows), 0)
    docs = spark.read.parquet(str(tmp_path / "s")).orderBy("generated_at").collect()
    assert [d.anomaly_count for d in docs] == [10, 10, 3]
    assert all(d.anomaly_types == ["latency_spike", "throughput_drop"] and d.services == ["a", "b"] for d in docs)


def test_healthy_calls_of_a_slow_service_flag_no_session(spark, tmp_path):
    from tidewatch.operators.matching import with_baseline

    rows = [event(i, T0 + timedelta(seconds=i), "recommendation-engine", 150.0 + i % 150) for i in range(60)]
    rows.append(event(999, T0 + timedelta(hours=2)))
    found = detectors.session_anomalies(with_baseline(table(spark, rows)), slow=F.col("latency_ms") > 2 * F.col("mu"))
    assert found.count() == 0


def test_run_to_end_survives_a_second_call(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[event(1, "0:00:01")]])
    for _ in range(2):
        run_to_end(file_stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_command_line_job_over_files(spark, tmp_path):
    from tidewatch.__main__ import arguments, run

    rows = busy_rows()
    ingest.encode(table(spark, rows)).select("value").coalesce(1).write.text(str(tmp_path / "json"))
    out = str(tmp_path / "out")
    listeners = len(spark.streams._jsqm.listListeners()) if hasattr(spark.streams._jsqm, "listListeners") else None
    run(spark, arguments(["--source", "files", "--path", str(tmp_path / "json"), "--out", out, "--once"]))
    assert sinks.stored_events(spark, f"{out}/events").count() == len(rows)
    assert spark.read.parquet(f"{out}/anomalies").where("detector = 'drops'").count() > 0
    assert listeners is None or len(spark.streams._jsqm.listListeners()) == listeners


def test_early_alerts_come_before_the_window_ends(spark, tmp_path):
    from tidewatch.streaming.runner import latest_rows

    rows = [r for r in busy_rows() if (r["timestamp"] - T0).total_seconds() < 960]
    write_files(spark, tmp_path / "in", files_of(rows, 2))
    stream = ingest.with_watermark(file_stream(spark, tmp_path / "in"))
    early = latest_rows(detectors.latency_spike(stream, method="early"), ["service", "window_end"], "early").collect()
    last = max(r["timestamp"] for r in rows).replace(tzinfo=None)
    assert any(r.window_end > last for r in early)
    assert len({(r.service, r.window_end) for r in early}) == len(early)


def test_stored_anomalies_count_as_prior_incidents(spark, tmp_path):
    from tests.helpers import anomaly_table

    def batch(minute):
        t = T0 + timedelta(minutes=minute)
        return anomaly_table(spark, [{"service": "a", "anomaly_type": "throughput_drop", "detected_at": t,
                                      "window_start": t, "window_end": t}])

    store = sinks.table_writer(str(tmp_path / "anomalies"))
    report = sinks.summary_writer(str(tmp_path / "summaries"), str(tmp_path / "counts"))
    for i in range(3):
        store(batch(i), i)
        report(batch(i), i)
    texts = [r.summary.splitlines()[-1] for r in
             spark.read.parquet(str(tmp_path / "summaries")).orderBy("generated_at").collect()]
    assert [t.split("kind: ")[1] for t in texts] == ["0", "1", "2"]
