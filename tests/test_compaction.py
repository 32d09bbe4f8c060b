"""The clustered copy of the store against the store itself, and similar sets against all pairs."""

import random
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, event, table
from tidewatch.operators import similar
from tidewatch.sources import ingest
from tidewatch.streaming import compaction, sinks

SERVICES = ["user-auth", "search-service", "payment-gateway", None]


def batch(spark, path, run, number, days, n=400):
    """A batch of the store as the job writes it; every fiftieth event has no time."""
    rows = [event(f"{run}{number}-{i}", T0 + timedelta(days=days[i % len(days)], seconds=i * 211 % 86_400), SERVICES[i % 4], float(i)) for i in range(n)]
    rows += [event(f"{run}{number}-x", T0) | {"timestamp": None}]
    df = table(spark, rows).selectExpr("*", "cast(null as string) as message", "cast(null as string) as reason", "'accepted' as status",
                                       "to_date(timestamp) as event_date")
    df.repartition(7).write.partitionBy("status", "event_date").parquet(f"{path}/run={run}/batch_id={number}")


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


@pytest.fixture()
def store(spark, tmp_path):
    path, out = str(tmp_path / "events"), str(tmp_path / "clustered")
    for number in range(3):
        batch(spark, path, "a", number, [0, 1, 2, 5])
    return path, out


def test_clustered_reads_equal_the_store(spark, store):
    path, out = store
    everything = ids(sinks.stored_events(spark, path))
    assert compaction.version(spark, out) is None and ids(compaction.clustered_events(spark, path, out)) == everything
    assert compaction.compact(spark, path, out, date(2024, 1, 3), rows_per_file=100) == 1
    assert ids(compaction.clustered_events(spark, path, out)) == everything
    files = compaction.manifest(spark, out, 1).collect()
    assert {f.event_date for f in files} == {date(2024, 1, 1), date(2024, 1, 2)} and sum(f.n for f in files) == 600
    assert len(files) <= 10  # 42 in the store
    since, until = T0 + timedelta(hours=5), T0 + timedelta(days=1, hours=3)
    for wanted in (None, ["user-auth"], ["search-service", "payment-gateway"], ["nobody"], []):
        want = sinks.stored_events(spark, path, since, until)
        want = want if wanted is None else want.where(F.col("service").isin(wanted))
        assert ids(compaction.clustered_events(spark, path, out, since, until, wanted)) == ids(want)


def test_a_filtered_read_opens_few_files(spark, store):
    path, out = store
    compaction.compact(spark, path, out, date(2024, 1, 7), rows_per_file=50)
    whole = len(compaction.clustered_events(spark, path, out).inputFiles())
    hour = T0 + timedelta(hours=6)
    df = compaction.clustered_events(spark, path, out, hour, hour + timedelta(hours=1), ["user-auth"])
    opened = [f for f in df.inputFiles() if "/clustered/" in f]
    assert 0 < len(opened) <= whole / 5


def test_late_events_rewrite_their_dates_only(spark, store):
    path, out = store
    compaction.compact(spark, path, out, date(2024, 1, 4), rows_per_file=100)
    before = {f.file for f in compaction.manifest(spark, out, 1).collect() if f.event_date != date(2024, 1, 2)}
    batch(spark, path, "a", 3, [1])
    batch(spark, path, "b", 0, [1, 9])
    everything = ids(sinks.stored_events(spark, path))
    assert ids(compaction.clustered_events(spark, path, out)) == everything  # late events come from the store
    assert compaction.compact(spark, path, out, date(2024, 1, 3), rows_per_file=100) == 2  # a date once closed stays closed
    after = compaction.manifest(spark, out, 2).collect()
    assert before == {f.file for f in after if f.event_date != date(2024, 1, 2)}
    assert sum(f.n for f in after if f.event_date == date(2024, 1, 2)) == 300 + 400 + 200
    assert ids(compaction.clustered_events(spark, path, out)) == everything
    assert compaction.compact(spark, path, out, date(2024, 1, 3)) == 2  # nothing new, nothing written


def test_readers_see_one_version_and_a_dead_rewrite_counts_for_nothing(spark, store):
    path, out = store
    compaction.compact(spark, path, out, date(2024, 1, 3), rows_per_file=100)
    reader = compaction.clustered_events(spark, path, out)
    everything = ids(sinks.stored_events(spark, path))
    compaction.manifest(spark, out, 1).write.parquet(f"{out}/data/v=2/event_date=2024-01-01")  # a rewrite that died
    assert compaction.version(spark, out) == 1
    batch(spark, path, "a", 3, [0])
    assert compaction.compact(spark, path, out, date(2024, 1, 7), rows_per_file=100) == 3
    assert ids(reader) == everything  # opened before, unchanged
    everything = ids(sinks.stored_events(spark, path))
    compaction.expire(spark, out, keep=1)
    assert compaction._versions(spark, f"{out}/manifest") == [3]
    assert not compaction.folders(spark, f"{out}/data/v=2")
    assert ids(compaction.clustered_events(spark, path, out)) == everything


def test_an_unfinished_batch_is_not_compacted(spark, store):
    path, out = store
    batch(spark, path, "a", 3, [0])
    (Path(path) / "run=a" / "batch_id=3" / "_SUCCESS").unlink()
    compaction.compact(spark, path, out, date(2024, 1, 7))
    assert sum(f.n for f in compaction.manifest(spark, out, 1).collect()) == 1200
    assert ids(compaction.clustered_events(spark, path, out)) == ids(sinks.stored_events(spark, path))


def test_small_files_of_a_date_are_written_by_one_task(spark, store):
    path, out = store
    compaction.compact(spark, path, out, date(2024, 1, 7), rows_per_file=20)
    files = [f.file.rpartition("/")[2] for f in compaction.manifest(spark, out, 1).collect()]
    assert len(files) == 60 and {name.split("-")[1] for name in files} == {"00000"}
    compaction.compact(spark, path, out, date(2024, 1, 7), rows_per_file=20)
    batch(spark, path, "a", 3, [0])
    compaction.compact(spark, path, out, date(2024, 1, 7), rows_per_file=20)  # dates are read by folder
    assert ids(compaction.clustered_events(spark, path, out)) == ids(sinks.stored_events(spark, path))


def test_a_batch_leaves_one_file_in_a_folder(spark, tmp_path):
    """Whatever the number of shuffle partitions; more files only for more rows than a task writes."""
    rows = [event(i, T0 + timedelta(days=i % 5, seconds=i)) for i in range(200)]
    ingest.encode(table(spark, rows)).write.parquet(str(tmp_path / "topic"))
    messages = spark.readStream.schema("key string, value string").parquet(str(tmp_path / "topic"))
    path = str(tmp_path / "events")
    sinks.store_messages(ingest.decode(messages), path, str(tmp_path / "checkpoint"), {"availableNow": True}).awaitTermination()
    assert len(list(Path(path).rglob("*.parquet"))) == 5
    assert ids(sinks.stored_events(spark, path)) == sorted(str(i) for i in range(200))


def test_similar_counts_equal_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, rng.sample("abcdefghijkl", rng.randint(1, 6)), datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=rng.randint(0, 200)))
            for i in range(300)]
    rows += [(1000 + i, ["a", "b", "b", None], datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=i // 2)) for i in range(100)]  # copies, ties
    rows += [(2000, [], T0), (2001, None, T0), (2002, [None], T0)]
    df = spark.createDataFrame(rows, "id long, items array<string>, t timestamp")
    sets = {i: ({x for x in items or [] if x is not None}, t) for i, items, t in rows}
    for percent in (30, 50, 67, 100):
        got = {r.id: r.similar_count for r in similar.count_similar_earlier(df, "items", "t", percent).collect()}
        want = {i: sum(u < t and bool(s) and 100 * len(s & o) >= percent * len(s | o) for o, u in sets.values()) for i, (s, t) in sets.items()}
        assert got == want
    assert similar.count_similar_earlier(df.limit(0), "items", "t").count() == 0
