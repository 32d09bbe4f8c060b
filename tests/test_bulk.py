"""Bulk bodies: bounded, published by commit only, and once per batch."""

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, event, file_stream, table, write_files
from tidewatch.schemas import EVENT
from tidewatch.sources import bulk
from tidewatch.streaming import sinks


@pytest.fixture()
def out(spark, tmp_path):
    bulk.register(spark)
    return str(tmp_path / "bulk")


def rows(n, start=0):
    return [event(i, T0 + timedelta(seconds=i), latency=None if i % 7 == 0 else i / 3) for i in range(start, start + n)]


def test_bodies_are_bounded_and_hold_every_document_once(spark, out):
    df = table(spark, rows(230)).repartition(3)
    df.write.format("bulk").options(path=out, index="events", size=50, id="event_id").mode("append").save()
    named = bulk.published(spark, out).collect()
    assert sum(r.documents for r in named) == 230 and max(r.documents for r in named) <= 50 and len(named) <= 3 * 2
    got = bulk.documents(spark, out, EVENT)
    assert {r["_index"] for r in got.select("_index").collect()} == {"events"} and got.where("_id <> event_id").count() == 0
    assert got.select(*df.columns).exceptAll(df).count() == 0 and got.count() == 230


def test_a_failed_task_leaves_no_document_and_empty_tables_no_body(spark, out):
    df = table(spark, rows(100)).repartition(2)
    bad = df.withColumn("latency_ms", F.expr("if(event_id = '55', raise_error('broken'), latency_ms)").cast("double"))
    with pytest.raises(Exception, match="broken"):
        bad.write.format("bulk").options(path=out, index="events", size=10).mode("append").save()
    assert bulk.published(spark, out).count() == 0
    df.limit(0).write.format("bulk").options(path=out, index="events").mode("append").save()
    assert bulk.published(spark, out).count() == 0


def test_a_batch_written_again_replaces_itself(spark, out):
    for n in (40, 60):
        table(spark, rows(n)).write.format("bulk").options(path=out, index="events", size=25, batch="b1").mode("append").save()
    assert bulk.documents(spark, out, EVENT).count() == 60


def test_handlers_of_two_queries_keep_batches_of_their_own(spark, out):
    for name, n in (("drops", 10), ("spikes", 20), ("drops", 30)):
        sinks.bulk_writer(out, "alerts", name)(table(spark, rows(n)), 4)
    found = bulk.published(spark, out).groupBy("batch").agg(F.sum("documents").alias("n")).collect()
    assert sorted((r.batch, r.n) for r in found) == [("drops-4", 30), ("spikes-4", 20)]


def test_a_stream_publishes_each_batch_once(spark, out, tmp_path):
    write_files(spark, tmp_path / "in", [rows(30), rows(45, 30)])

    def run():
        file_stream(spark, tmp_path / "in").writeStream.format("bulk").options(path=out, index="events", size=20, id="event_id").option(
            "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    run()
    assert sorted(Path(f"{out}/manifest").glob("*.json")) == [Path(f"{out}/manifest/batch-{b}.json") for b in (0, 1)]
    (tmp_path / "ck" / "commits" / "1").unlink()  # the last batch is run again
    for crc in (tmp_path / "ck" / "commits").glob(".1.crc"):
        crc.unlink()
    run()
    got = bulk.documents(spark, out, EVENT)
    assert got.count() == 75 and got.select("event_id").distinct().count() == 75
