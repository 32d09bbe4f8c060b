"""Sinks of the streaming job. A batch that is repeated after a failure replaces itself."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.plans.reports import report_docs
from tidewatch.schemas import ANOMALY, EVENT
from tidewatch.session import drop_folder, folders, has_file, make_folder
from tidewatch.settings import DEFAULTS, Settings
from tidewatch.sources import bulk
from tidewatch.sources.ingest import encode, sorted_out
from tidewatch.streaming.replays import STORED, ReplayFilter, blocks, keyed

log = logging.getLogger(__name__)

BatchHandler = Callable[[DataFrame, int], None]


@contextmanager
def _kept(batch: DataFrame) -> Iterator[DataFrame]:
    """A batch that is read more than once is computed once; one that a caller keeps is left to it."""
    if batch.is_cached:
        yield batch
        return
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def table_writer(path: str, partition_by: list[str] | None = None,
                 max_records_per_file: int = 0) -> BatchHandler:
    """Parquet, one folder per batch that has rows; writing a batch again replaces that folder only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch):
            if batch.isEmpty():  # nothing is written that a stream over the folder could find and lose again
                return
            out = batch.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
            if partition_by:
                out = out.partitionBy(*partition_by)
            out.parquet(f"{path}/batch_id={batch_id}")

    return write


_EVENTS = [f.name for f in EVENT]
STORED_ROWS = 50_000  # rows a task writes to the store


def _by_folder(rows: DataFrame) -> DataFrame:
    """Rows dealt by the folders they go to, so a batch leaves about a file for each task and folder, not for each pair of them.

    A date of many rows has several tasks.
    """
    parts = max(1, math.ceil(rows.count() / STORED_ROWS))
    spread = F.xxhash64("event_id", "message")
    return rows.repartition(1) if parts == 1 else rows.repartitionByRange(parts, "status", "event_date", spread)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a query with its checkpoint; a new checkpoint has a new one."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def store_messages(decoded: DataFrame, path: str, checkpoint: str, trigger: dict, value: str = "value",
                   name: str = "events", cfg: Settings = DEFAULTS) -> StreamingQuery:
    """Event store and quarantine in one table, so that each message is read and decoded once.

    Events that the store has, from this run or an earlier one, are left out, so what reads the store needs no duplicate
    removal. A folder for each run and batch: a batch that was written in full is not written again, so readers see every
    event once. Folders per status and event date let filters skip most of the store. Late events are stored too;
    only the detectors ignore them.
    """
    spark = decoded.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        run = query_id(spark, checkpoint)
        folder = f"run={run}/batch_id={batch_id}"
        if has_file(spark, f"{path}/{folder}/_SUCCESS"):
            return
        with _kept(batch), _kept(keyed(batch.where("status = 'accepted'"), cfg)) as marked:
            with _kept(ReplayFilter(spark, path, run, batch_id, cfg).fresh(marked)) as fresh:
                blocks(fresh).write.mode("overwrite").parquet(f"{path}_seen/{folder}")
                rows = fresh.select(*batch.columns).unionByName(batch.where("status <> 'accepted'"))
                _by_folder(rows).write.mode("overwrite").partitionBy("status", "event_date").parquet(f"{path}/{folder}")

    make_folder(spark, path)
    return (
        sorted_out(decoded, value).withColumn("event_date", F.to_date("timestamp"))
        .writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()
    )


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected messages of the store, with their reasons."""
    return spark.read.schema(STORED).parquet(path).where("status = 'rejected'").select("message", "reason")


def stored_stream(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """The event store as a stream, at most about ``max_bytes`` of files per batch."""
    make_folder(spark, path)
    reader = spark.readStream.schema(STORED)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.parquet(path).where("status = 'accepted'").select(*_EVENTS)


def anomaly_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stored anomalies of all detectors as one stream; ``path`` has a folder for each detector."""
    make_folder(spark, path)
    stored = T.StructType([*ANOMALY.fields, T.StructField("detector", T.StringType()), T.StructField("batch_id", T.LongType())])
    return spark.readStream.schema(stored).parquet(path).drop("detector", "batch_id")


def stored_events(spark: SparkSession, path: str, since: datetime | None = None,
                  until: datetime | None = None) -> DataFrame:
    """The event store as a table; time bounds apply to the folders as well as to the rows."""
    df = spark.read.schema(STORED).parquet(path).where("status = 'accepted'")
    if since is not None:
        df = df.where((F.col("event_date") >= F.to_date(F.lit(since))) & (F.col("timestamp") > F.lit(since)))
    if until is not None:
        df = df.where((F.col("event_date") <= F.to_date(F.lit(until))) & (F.col("timestamp") <= F.lit(until)))
    return df.select(*_EVENTS)


def message_writer(options: dict[str, str], fmt: str = "kafka", key: str = "service") -> BatchHandler:
    """Keyed JSON messages to a topic (or to any format that takes key and value)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        encode(batch, key).write.format(fmt).options(**options).mode("append").save()

    return write


def index_options(index: str, cfg: Settings = DEFAULTS, id_column: str | None = None) -> dict[str, str]:
    """Options of a document-index connector: bulk requests of a fixed number of documents."""
    options = {"es.resource": index, "es.batch.size.entries": str(cfg.bulk_size)}
    if id_column:
        options["es.mapping.id"] = id_column
    return options


def document_writer(options: dict[str, str], fmt: str = "es") -> BatchHandler:
    """Rows as documents of an index (or of any format that appends rows)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**options).mode("append").save()

    return write


def bulk_writer(path: str, index: str, name: str, id_column: str | None = None, cfg: Settings = DEFAULTS) -> BatchHandler:
    """Rows as published bulk bodies for a document index; a repeated batch of the query ``name`` replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bulk.register(batch.sparkSession)
        options = {"path": path, "index": index, "size": str(cfg.bulk_size), "batch": f"{name}-{batch_id}"}
        batch.write.format("bulk").options(**options | ({"id": id_column} if id_column else {})).mode("append").save()

    return write


_COUNTS = "service string, anomaly_type string, n bigint"


def running_counts(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Stored anomalies per service and type before a batch: the totals that the latest earlier batch left.

    Only that batch's folder is read; those before it are dropped, as a repeated batch needs one earlier than itself.
    """
    numbers = sorted(int(name.partition("=")[2]) for name in folders(spark, path) if name.startswith("batch_id="))
    earlier = [n for n in numbers if n < batch_id]
    for n in earlier[:-1]:
        drop_folder(spark, f"{path}/batch_id={n}")
    return spark.read.schema(_COUNTS).parquet(f"{path}/batch_id={earlier[-1]}") if earlier else None


def summary_writer(path: str, counts: str | None = None, cfg: Settings = DEFAULTS) -> BatchHandler:
    """Reports of a batch of anomalies. The batch of a failure is logged and kept in ``<path>_failed``; the stream goes on.

    ``counts`` is a table of running totals; anomalies of earlier batches count as prior incidents, those of a failed batch too,
    as totals are written first and apart.
    """
    write, keep = table_writer(path), table_writer(f"{path}_failed")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        earlier = running_counts(batch.sparkSession, counts, batch_id) if counts else None
        if counts:
            own = batch.groupBy("service", "anomaly_type").agg(F.count(F.lit(1)).alias("n"))
            totals = own if earlier is None else own.unionByName(earlier).groupBy("service", "anomaly_type").agg(F.sum("n").alias("n"))
            table_writer(counts)(totals, batch_id)
        try:
            write(report_docs(batch, cfg, earlier=earlier), batch_id)
        except Exception:
            log.exception("summaries of batch %d were not stored", batch_id)
            keep(batch, batch_id)

    return handle


def each(*handlers: BatchHandler) -> BatchHandler:
    """Several handlers on one batch, computed once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch):
            for h in handlers:
                h(batch, batch_id)

    return handle
