"""Open state against what a batch computes, and lag from progress events."""

import json
from datetime import timedelta

from tests.helpers import T0, event, file_stream, write_files
from tidewatch.operators import sessions, windows
from tidewatch.streaming import state
from tidewatch.streaming.runner import run_to_end


def test_open_sessions_and_windows_are_what_the_watermark_left(spark, tmp_path):
    rows = [event(i, T0 + timedelta(seconds=60 * i), session=f"s{i % 2}") for i in range(10)]
    rows += [event(100, T0 + timedelta(seconds=3000), session="s2"), event(101, T0 + timedelta(seconds=3100), session="s2"),
             event(102, T0 + timedelta(seconds=3105), service=None, session=None)]
    write_files(spark, tmp_path / "in", [rows[:6], rows[6:]])
    ev = file_stream(spark, tmp_path / "in").withWatermark("timestamp", "10 seconds")
    run_to_end(sessions.sessions(ev), str(tmp_path / "a"), str(tmp_path / "ca"))
    got = {(r.session_key, r.event_count, (r.window_end - r.window_start).seconds, (r.expires_at - r.window_end).seconds)
           for r in state.open_sessions(spark, str(tmp_path / "ca")).collect()}
    assert got == {("s2", 2, 700, 10), (None, 1, 600, 10)}
    run_to_end(windows.events_per_window(ev, 60, ["service"]), str(tmp_path / "b"), str(tmp_path / "cb"))
    got = {(r.service, r.event_count, r.window_start.minute) for r in state.open_windows(spark, str(tmp_path / "cb")).collect()}
    assert got == {("user-auth", 1, 51), (None, 1, 51)}
    assert sum(r.entries for r in state.state_sizes(spark, str(tmp_path / "cb")).collect()) == 2


def _progress(batch, read, written, name="events"):
    return json.dumps({"name": name, "id": name, "batchId": batch, "sources": [
        {"description": "Subscribe[t]", "startOffset": None, "endOffset": read, "latestOffset": written}]})


def test_lag_is_written_minus_read_of_the_latest_batch(spark):
    rows = [_progress(1, {"t": {"0": 5, "1": 7}}, {"t": {"0": 50, "1": 70}}), _progress(2, {"t": {"0": 40, "1": 70}}, {"t": {"0": 55, "1": 70, "2": 9}}),
            _progress(0, {"t": {"0": 1}}, {"t": {"0": 1}}, "other"), _progress(3, {"logOffset": 0}, None, "files"), "no json", None]
    got = state.source_lag(spark.createDataFrame([(r,) for r in rows], "progress string")).collect()
    assert sorted((r.query, r.topic, r.partition, r.written, r.read, r.lag) for r in got) == [
        ("events", "t", 0, 55, 40, 15), ("events", "t", 1, 70, 70, 0), ("events", "t", 2, 9, 0, 9), ("other", "t", 0, 1, 1, 0)]
