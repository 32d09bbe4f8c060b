"""Closed dates of the event store in few files, clustered along a space-filling curve of time and service.

The store has a folder for each batch, so after a day of triggers a reader opens many small files. ``compact`` writes the accepted
events of dates before a given one again: range-partitioned along a Morton curve of the time of day and the service's code, so
that each file covers a short time of few services. A version is a manifest of files with their bounds (time, service
code) and a table of the batches it covers; it exists once the manifest is written in full, so readers see one version
whatever is being written, and a rewrite that dies leaves the old one. Events that come later for a closed date are read from the
store until the next call, which writes the dates they fall in anew; files of other dates are kept.

One compaction runs at a time. The store's own folders stay: streams and the replay filter read them.

Defined results: events without a time belong to no date and stay in the store; a null service has a code like any other;
an empty store has no version, and readers take what the store holds.
"""

from __future__ import annotations

import math
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schemas import EVENT
from tidewatch.session import drop_folder, folders, has_file
from tidewatch.streaming.replays import STORED

MANIFEST = "file string, event_date date, n bigint, since timestamp, until timestamp, low int, high int"
COVERED = "before date, run string, last_batch bigint"
ROWS_PER_FILE = 1_000_000
ROWS_PER_TASK = 50_000  # at least; a task writes several files where these are smaller
_EVENTS = [f.name for f in EVENT]
_CLUSTERED = T.StructType([*EVENT.fields, T.StructField("event_date", T.DateType())])
_DAY_US = 86_400_000_000
_FOLDER = "^(data/v=[0-9]+/event_date=[^/]*)/"


def service_code(service: Column) -> Column:
    """One of 256 codes; equal services have equal codes."""
    return F.pmod(F.xxhash64(service), F.lit(256)).cast("int")


def curve(time: Column, service: Column) -> Column:
    """Place on the curve: the bits of code and 1/256 of a day by turns, then 1/65,536 of a day."""
    part = F.floor(F.pmod(F.unix_micros(time), F.lit(_DAY_US)) * 65_536 / _DAY_US).cast("long")
    code = service_code(service).cast("long")
    bits = [F.shiftleft(F.shiftright(code, i).bitwiseAND(1), 2 * i + 1) + F.shiftleft(F.shiftright(part, 8 + i).bitwiseAND(1), 2 * i)
            for i in range(8)]
    return F.shiftleft(reduce(lambda a, b: a + b, bits), 8) + part.bitwiseAND(255)


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name[2:]) for name in folders(spark, path) if name.startswith("v="))


def _finished(spark: SparkSession, out: str) -> list[int]:
    return [v for v in _versions(spark, f"{out}/manifest") if has_file(spark, f"{out}/manifest/v={v}/_SUCCESS")]


def version(spark: SparkSession, out: str) -> int | None:
    """The newest version written in full."""
    return max(_finished(spark, out), default=None)


def manifest(spark: SparkSession, out: str, number: int | None) -> DataFrame:
    """Files of a version, relative to ``out``, with their rows and bounds."""
    if number is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest/v={number}")


def _covered(spark: SparkSession, out: str, number: int | None) -> list:
    """A row for each run: batches up to ``last_batch`` are in the version, for dates before ``before``."""
    return [] if number is None else spark.read.schema(COVERED).parquet(f"{out}/covered/v={number}").collect()


def _is_covered(rows: list) -> Column:
    """Whether the store's row is in the version; folder columns only, so whole folders are skipped."""
    parts = [(F.col("event_date") < F.lit(r.before)) & (F.col("run") == r.run) & (F.col("batch_id") <= r.last_batch) for r in rows]
    return F.coalesce(reduce(lambda a, b: a | b, parts, F.lit(False)), F.lit(False))


def _last_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each run that was written in full; a run writes its batches in order."""
    out = {}
    for run in folders(spark, path):
        if not run.startswith("run="):
            continue
        numbers = sorted((int(b[9:]) for b in folders(spark, f"{path}/{run}") if b.startswith("batch_id=")), reverse=True)
        last = next((b for b in numbers if has_file(spark, f"{path}/{run}/batch_id={b}/_SUCCESS")), None)
        if last is not None:
            out[run[4:]] = last
    return out


def _files(spark: SparkSession, out: str, rows: DataFrame) -> DataFrame:
    names = [f"{out}/{r.file}" for r in rows.select("file").collect()]  # the reader takes names of files
    if not names:
        return spark.createDataFrame([], EVENT)
    return spark.read.schema(EVENT).parquet(*names)


def _dates(spark: SparkSession, files: DataFrame, out: str) -> DataFrame:
    """The events of dates all of whose files are given: a date's files have one folder, so a name for each date will do."""
    found = files.select(F.regexp_extract("file", _FOLDER, 1).alias("folder")).distinct().collect()
    return spark.read.schema(EVENT).parquet(*[f"{out}/{r.folder}" for r in found]) if found else spark.createDataFrame([], EVENT)


def compact(spark: SparkSession, path: str, out: str, before: date, rows_per_file: int = ROWS_PER_FILE) -> int | None:
    """Bring the clustered copy at ``out`` of the store at ``path`` up to date for dates before ``before``; returns its version.

    Dates without new events are left as they are. A date gets about its rows / ``rows_per_file`` files, and two at its borders.
    Small files are written many by a task, one after the other along the curve, so tasks grow with rows, not with files.
    """
    old = version(spark, out)
    known = _covered(spark, out, old)
    before = max([before, *(r.before for r in known)])
    last = _last_batches(spark, path)
    now = [Row(before=before, run=run, last_batch=batch) for run, batch in sorted(last.items())]
    new = (spark.read.schema(STORED).parquet(path).where("status = 'accepted'").where(_is_covered(now) & ~_is_covered(known))
           if now else spark.createDataFrame([], STORED))
    days = [r.event_date for r in new.select("event_date").distinct().collect()]  # dates
    if not days:
        return old
    files = manifest(spark, out, old)
    again = _dates(spark, files.where(F.col("event_date").isin(days)), out)
    rows = new.select(*_EVENTS).unionByName(again).withColumn("event_date", F.to_date("timestamp"))
    parts = max(1, math.ceil(rows.count() / max(rows_per_file, ROWS_PER_TASK)))
    number = 1 + max([0, *_versions(spark, f"{out}/data"), *_versions(spark, f"{out}/manifest")])
    placed = rows.withColumn("place", curve(F.col("timestamp"), F.col("service")))
    (placed.repartitionByRange(parts, "event_date", "place", F.xxhash64("event_id")).sortWithinPartitions("event_date", "place").drop("place")
     .write.option("maxRecordsPerFile", rows_per_file if rows_per_file < ROWS_PER_TASK else 2 * rows_per_file).partitionBy("event_date").parquet(f"{out}/data/v={number}"))
    written = spark.read.schema(_CLUSTERED).parquet(f"{out}/data/v={number}").select(
        F.regexp_extract(F.col("_metadata.file_path"), "data/v=[0-9]+/event_date=[^/]*/[^/]*$", 0).alias("file"), "event_date", "timestamp",
        service_code(F.col("service")).alias("code"))
    bounds = written.groupBy("file", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("since"), F.max("timestamp").alias("until"),
        F.min("code").alias("low"), F.max("code").alias("high"))
    spark.createDataFrame(now, COVERED).coalesce(1).write.mode("overwrite").parquet(f"{out}/covered/v={number}")
    files.where(~F.col("event_date").isin(days)).unionByName(bounds).write.parquet(f"{out}/manifest/v={number}")  # from here on it counts
    return number


def clustered_events(spark: SparkSession, path: str, out: str, since: datetime | None = None, until: datetime | None = None,
                     services: list[str] | None = None) -> DataFrame:
    """The event store as a table: files of the newest version whose bounds meet the filter, and what the store holds beyond it.

    Takes events after ``since``, up to ``until``, of the ``services``. The files are settled here, so a later version changes nothing.
    """
    number = version(spark, out)
    files = manifest(spark, out, number)
    wanted, days = F.lit(True), F.lit(True)
    if since is not None:
        files = files.where(F.col("until") > F.lit(since))
        wanted, days = wanted & (F.col("timestamp") > F.lit(since)), days & (F.col("event_date") >= F.to_date(F.lit(since)))
    if until is not None:
        files = files.where(F.col("since") <= F.lit(until))
        wanted, days = wanted & (F.col("timestamp") <= F.lit(until)), days & (F.col("event_date") <= F.to_date(F.lit(until)))
    if services is not None:
        codes = [service_code(F.lit(s)) for s in services]
        files = files.where(reduce(lambda a, b: a | b, [c.between(F.col("low"), F.col("high")) for c in codes], F.lit(False)))
        wanted = wanted & F.col("service").isin(services)
    rest = spark.read.schema(STORED).parquet(path).where("status = 'accepted'").where(~_is_covered(_covered(spark, out, number)) & days)
    return _files(spark, out, files).where(wanted).unionByName(rest.where(wanted).select(*_EVENTS))


def expire(spark: SparkSession, out: str, keep: int = 2) -> None:
    """Drop all but the newest ``keep`` versions, and the files that none of these names. Readers of a dropped version fail."""
    kept = _finished(spark, out)[-keep:]
    if not kept:
        return
    folder = F.regexp_extract("file", _FOLDER, 1)
    used = {r[0] for v in kept for r in manifest(spark, out, v).select(folder).distinct().collect()}  # a row for each date
    for v in _versions(spark, f"{out}/data"):
        if v > kept[-1]:
            continue  # being written, or left by a failure until a later version exists
        for day in folders(spark, f"{out}/data/v={v}"):
            if f"data/v={v}/{day}" not in used:
                drop_folder(spark, f"{out}/data/v={v}/{day}")
    for v in _versions(spark, f"{out}/manifest"):
        if v < kept[0]:
            drop_folder(spark, f"{out}/manifest/v={v}")
            drop_folder(spark, f"{out}/covered/v={v}")
