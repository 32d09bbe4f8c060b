"""What a streaming query still holds: open sessions and windows from its checkpoint's state, and its lag from its progress.

State is read by Spark's own state data source, partition by partition, of the last batch that was committed; the query may be
running or stopped, and nothing is changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.events import interval
from tidewatch.settings import DEFAULTS, Settings

_PROGRESS = "name string, id string, batchId bigint, sources array<struct<description string, endOffset string, latestOffset string>>"
_OFFSETS = "map<string, map<string, bigint>>"


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """``key, value, partition_id`` of a stateful operator after a batch, the last one by default."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)


def open_sessions(spark: SparkSession, checkpoint: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """Sessions of ``operators.sessions`` that the watermark has not passed: their bounds so far, events, and the event time that ends them."""
    end = F.col("value.session_window.end")
    return state_rows(spark, checkpoint).select(
        F.col("key.session_key").alias("session_key"), F.col("value.session_window.start").alias("window_start"), end.alias("window_end"),
        F.col("value.count").alias("event_count"), (end + interval(cfg.watermark_s)).alias("expires_at"))


def open_windows(spark: SparkSession, checkpoint: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """Windows of a counting stream that are not closed yet, with their keys, counts so far and the event time that closes them."""
    rows = state_rows(spark, checkpoint)
    window = next(f.name for f in rows.schema["key"].dataType if isinstance(f.dataType, T.StructType))
    keys = [f.name for f in rows.schema["key"].dataType if f.name != window]
    start, end = F.col(f"key.{window}.start"), F.col(f"key.{window}.end")
    return rows.select(*[F.col(f"key.{k}").alias(k) for k in keys], start.alias("window_start"), end.alias("window_end"),
                       F.col("value.count").alias("event_count"), (end + interval(cfg.watermark_s)).alias("expires_at"))


def state_sizes(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Entries of each partition of the state: a hot partition shows."""
    return state_rows(spark, checkpoint, operator).groupBy("partition_id").agg(F.count(F.lit(1)).alias("entries"))


def source_lag(progress: DataFrame, column: str = "progress") -> DataFrame:
    """Records written and read per partition of a topic, and the lag, from progress events as JSON text; the latest batch of a query counts.

    Partitions that nothing was read of yet count from 0; sources whose offsets are no topics have no rows.
    """
    p = progress.select(F.from_json(column, _PROGRESS).alias("p")).select("p.*")
    latest = p.groupBy("id", "name").agg(F.max_by("sources", "batchId").alias("sources"))
    each = latest.select("name", F.explode("sources").alias("s")).select(
        F.col("name").alias("query"), F.from_json("s.latestOffset", _OFFSETS).alias("written"), F.from_json("s.endOffset", _OFFSETS).alias("read"))
    topics = each.select("query", "read", F.explode("written").alias("topic", "partitions"))
    parts = topics.select("query", "topic", F.explode("partitions").alias("partition", "written"), F.col("read")[F.col("topic")].alias("read"))
    read = F.coalesce(F.col("read")[F.col("partition")], F.lit(0))
    return parts.select("query", "topic", F.col("partition").cast("int").alias("partition"), "written", read.alias("read"),
                        F.greatest(F.col("written") - read, F.lit(0)).alias("lag"))
