"""Shard bookkeeping and scaling advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators.matching import only_in
from tidewatch.settings import DEFAULTS, Settings, seconds


def active_shards(shards: DataFrame) -> DataFrame:
    """Shards still open: no ending sequence number."""
    return shards.where(F.col("ending_seq").isNull())


def shard_diff(active: DataFrame, current: DataFrame) -> DataFrame:
    """Consumers to add for new shards and to remove for closed ones."""
    add = only_in(active, current, "shard_id").select("shard_id", F.lit("add").alias("action"))
    remove = only_in(current, active, "shard_id").select("shard_id", F.lit("remove").alias("action"))
    return add.unionByName(remove)


def consumer_heartbeat(records: DataFrame, width_s: int = 60) -> DataFrame:
    """Shards with at least one record read, per interval."""
    shards = F.approx_count_distinct("shard_id") if records.isStreaming else F.count_distinct("shard_id")
    return (
        records.groupBy(F.window("timestamp", seconds(width_s)).alias("w"))
        .agg(shards.alias("active_consumers"))
        .select(F.col("w.start").alias("window_start"), "active_consumers")
    )


def utilisation(records: DataFrame, capacity: Column) -> DataFrame:
    """Records per shard and ``minute`` over the shard's capacity (which may depend on the minute).

    Minutes without a record count as zero, from a shard's first minute to the stream's last.
    """
    counts = records.groupBy("stream", "shard_id", F.window("timestamp", "1 minute").getField("start").alias("minute")).agg(
        F.count(F.lit(1)).alias("n"))
    ends = counts.groupBy("stream").agg(F.max("minute").alias("last"))
    every = counts.groupBy("stream", "shard_id").agg(F.min("minute").alias("first")).join(ends, "stream").select(
        "stream", "shard_id", F.explode(F.sequence("first", "last", F.expr("interval 1 minute"))).alias("minute"))
    counts = every.join(counts, ["stream", "shard_id", "minute"], "left").na.fill(0, ["n"])
    return counts.select(
        "stream", "shard_id", "minute", (F.col("n") / capacity).alias("utilisation"))


def scale_advice(samples: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Per shard and minute: ``up``, ``down`` after enough low minutes in a row, or ``none``.

    Streaks are islands of consecutive low minutes; a minute without a sample
    ends a streak. Each ordered pass holds one shard's minutes.
    """
    low = F.col("utilisation") < cfg.scale_down
    minute = (F.unix_seconds("minute") / 60).cast("long")
    shard = W.partitionBy("stream", "shard_id")
    lows = F.sum(low.cast("int")).over(shard.orderBy("minute").rowsBetween(W.unboundedPreceding, W.currentRow))
    island = samples.withColumn("low", low).withColumn("island", F.when(F.col("low"), minute - lows))
    streak = F.row_number().over(W.partitionBy("stream", "shard_id", "island").orderBy("minute"))
    return island.withColumn("streak", F.when(F.col("low"), streak).otherwise(0)).select(
        "stream", "shard_id", "minute", "utilisation", "streak",
        F.when(F.col("utilisation") > cfg.scale_up, "up")
        .when(F.col("streak") >= cfg.scale_down_minutes, "down")
        .otherwise("none").alias("advice"),
    )
