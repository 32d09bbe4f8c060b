"""Small event tables and file streams for tests."""

from datetime import datetime, timedelta, timezone

from tidewatch.schemas import ANOMALY, EVENT

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(text):
    """A time of day on the first day, as ``H:MM:SS``."""
    h, m, s = text.split(":")
    return T0 + timedelta(hours=int(h), minutes=int(m), seconds=float(s))


def event(i, t, service="user-auth", latency=10.0, status=200, session="sess_1", **more):
    t = at(t) if isinstance(t, str) else t
    row = {
        "event_id": str(i), "timestamp": t, "epoch_ms": int(t.timestamp() * 1000), "service": service,
        "event_type": "error" if status >= 500 else "search", "region": "us-east-1", "user_id": "user_1",
        "session_id": session, "latency_ms": latency, "status_code": status, "is_anomaly": False,
        "anomaly_type": None, "payload_bytes": 300, "metadata": {"client": "web", "version": "v1.0.0"},
    }
    row.update(more)
    return row


def table(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def anomaly_table(spark, rows):
    return spark.createDataFrame([{f.name: r.get(f.name) for f in ANOMALY} for r in rows], ANOMALY)


def write_files(spark, folder, files):
    """One parquet file per list of rows, in arrival order."""
    import time

    for rows in files:
        table(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)


def file_stream(spark, folder, per_trigger=1):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", per_trigger).parquet(str(folder))


def run_batches(stream, path, checkpoint, handler=None):
    """Run all files, one per batch, and return the stored rows."""
    from tidewatch.streaming.runner import run_to_end

    query = run_to_end(stream, str(path), str(checkpoint))
    spark = stream.sparkSession
    stored = spark.read.schema(stream.schema).parquet(str(path)).select(*stream.columns)
    rows = [r.asDict() for r in stored.collect()]
    return rows, query
