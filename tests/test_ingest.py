import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, at, event, table
from tidewatch.plans.evaluation import required_violations
from tidewatch.schemas import EVENT
from tidewatch.sources import ingest


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def good(**more):
    row = event(1, "0:00:01", **more)
    row["timestamp"] = row["timestamp"].isoformat()
    return row


def test_bad_json_is_set_aside_and_the_rest_goes_on(spark):
    decoded = ingest.decode(texts(spark, json.dumps(good()), "{bad", json.dumps(good())))
    assert ingest.accepted(decoded).count() == 2
    assert [r.reason for r in ingest.rejected(decoded).collect()] == ["malformed"]


@pytest.mark.parametrize("change, reason", [
    ({"zz": 2}, "unknown_field"),
    ({"metadata": {"client": "web", "version": "v1", "zz": 1}}, "unknown_field"),
    ({"latency_ms": "slow"}, "bad_value"),
    ({"timestamp": "yesterday"}, "bad_value"),
    ({"metadata": "none"}, "bad_value"),
    ({"metadata": {"client": {"a": 1}, "version": "v1"}}, "bad_value"),
    ({"metadata": {"client": ["a"], "version": "v1"}}, "bad_value"),
    ({"metadata": {"client": "{web", "version": 5}}, None),
    ({"timestamp": 1704067201000}, "bad_value"),
    ({"timestamp": "1704067201000"}, "bad_value"),
    ({"timestamp": "2024-01-01T02:00:00Z"}, None),
    ({"timestamp": None}, None),
    ({"metadata": None}, None),
    ({"timestamp": "2024-01-01T02:00:00+02:00"}, None),
])
def test_strict_gate(spark, change, reason):
    (r,) = ingest.decode(texts(spark, json.dumps({**good(), **change}))).collect()
    assert r.reason == reason


def test_missing_fields_are_accepted_and_counted(spark):
    row = good()
    del row["region"], row["metadata"]
    ev = ingest.accepted(ingest.decode(texts(spark, json.dumps(row))))
    missing = {r.field for r in required_violations(ev).where("missing > 0").collect()}
    assert missing == {"region", "metadata"}
    assert ev.select(ingest.missing_fields().alias("m")).first().m == ["region", "metadata"]


def test_round_trip_keeps_nulls_and_microseconds(spark):
    ev = table(spark, [event(1, T0 + timedelta(microseconds=123457))])
    sent = ingest.encode(ev)
    (r,) = sent.collect()
    assert r.key == "user-auth" and '"anomaly_type":null' in r.value
    back = ingest.accepted(ingest.decode(sent))
    assert back.schema.names == EVENT.names
    assert back.exceptAll(ev).isEmpty() and back.count() == 1


def test_each_record_is_parsed_once(spark):
    decoded = ingest.decode(spark.range(1).selectExpr("cast(id as string) as value"))
    plan = ingest.accepted(decoded)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(event_id") == 1


def test_source_and_sink_options():
    from tidewatch.settings import Settings

    assert ingest.source_options("h:1")["startingOffsets"] == "latest"
    assert ingest.source_options("h:1", position="TRIM_HORIZON")["startingOffsets"] == "earliest"
    timed = ingest.source_options("h:1", Settings(topic="t"), "AT_TIMESTAMP", 5, 500)
    assert timed["startingTimestamp"] == "5" and timed["maxOffsetsPerTrigger"] == "500" and timed["subscribe"] == "t"
    with pytest.raises(ValueError):
        ingest.source_options("h:1", position="AT_TIMESTAMP")
    sink = ingest.sink_options("h:1", "t")
    assert sink["kafka.batch.size"] == "65536" and sink["kafka.acks"] == "all"


def test_resume_after_checkpoints(spark):
    records = spark.createDataFrame(
        [(s, i, at(f"0:00:{i}")) for s in "ab" for i in range(10)],
        "shard_id string, sequence_number bigint, timestamp timestamp")
    marks = spark.createDataFrame([("a", 2), ("a", 6)], "shard_id string, sequence_number bigint")

    def counts(*args):
        todo = ingest.after_checkpoint(records, marks, *args)
        return {r.shard_id: r["count"] for r in todo.groupBy("shard_id").count().collect()}

    assert counts("TRIM_HORIZON") == {"a": 3, "b": 10}
    assert counts("LATEST") == {"a": 3}
    assert counts("AT_TIMESTAMP", F.lit(at("0:00:8"))) == {"a": 3, "b": 2}


def test_events_without_an_id_are_copies_only_if_equal(spark):
    rows = [event(i, T0 + timedelta(seconds=i), event_id=None) for i in range(5)] + [event(7, "0:00:09")] * 2
    ev = table(spark, rows + rows[:1])
    assert ingest.dedupe(ev).count() == 6
