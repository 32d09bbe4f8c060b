"""Sessions: runs of one key's events with no pause longer than the gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.events import interval, is_server_error
from tidewatch.operators.windows import only_closed
from tidewatch.settings import DEFAULTS, Settings, seconds


def _score(errors: Column, slow: Column, n: Column) -> Column:
    """1 - (1 - error share) * (1 - slow share)."""
    return 1 - (1 - errors / n) * (1 - slow / n)


def sessions(ev: DataFrame, key: str = "session_id", slow: Column | None = None,
             cfg: Settings = DEFAULTS) -> DataFrame:
    """Finished sessions with their score.

    A table is first reduced to one row per key, service and gap-wide pane:
    events of one pane are never further apart than the gap, so they always share a session and
    the reduction is exact. A key with very many events thus sends at most one row
    per pane and service into its ordered pass.
    """
    slow = F.col("latency_ms") > cfg.slow_ms if slow is None else F.coalesce(slow, F.lit(False))
    ev = ev.select(F.col(key).alias("session_key"), "service", "timestamp",
                   is_server_error().cast("int").alias("error"), slow.cast("int").alias("slow"))
    merged = _merge_stream(ev, cfg) if ev.isStreaming else _merge_table(ev, cfg)
    out = merged.select(
        "session_key", "service", F.col("first").alias("window_start"),
        (F.col("last") + interval(cfg.session_gap_s)).alias("window_end"),
        "event_count", "error_count", "slow_count",
        _score(F.col("error_count"), F.col("slow_count"), F.col("event_count")).alias("anomaly_score"),
    )
    return only_closed(out, ev, F.col("window_end"), cfg)


def _merge_stream(ev: DataFrame, cfg: Settings) -> DataFrame:
    # Bounds are aggregated: a filter on session_window's own bounds would be
    # pushed below the merge and cut sessions short.
    return ev.groupBy("session_key", F.session_window("timestamp", seconds(cfg.session_gap_s)).alias("s")).agg(
        F.mode("service", True).alias("service"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum("error").alias("error_count"),
        F.sum("slow").alias("slow_count"),
    )


def _merge_table(ev: DataFrame, cfg: Settings) -> DataFrame:
    pane = ev.groupBy(
        "session_key", "service", F.window("timestamp", seconds(cfg.session_gap_s)).alias("pane")
    ).agg(
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.sum("error").alias("errors"),
        F.sum("slow").alias("slow"),
    )
    order = W.partitionBy("session_key").orderBy("first", "service")
    seen = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(F.col("first") <= seen + interval(cfg.session_gap_s), 0).otherwise(1)
    numbered = pane.withColumn("begins", begins).withColumn("nr", F.sum("begins").over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # both levels stay in the partitions that the ordered pass made
    per_service = numbered.groupBy("session_key", "nr", "service").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"),
        F.sum("errors").alias("errors"), F.sum("slow").alias("slow"))
    return per_service.groupBy("session_key", "nr").agg(
        F.min(F.struct(F.col("service").isNull().alias("none"), (-F.col("n")).alias("rank"), "service"))
        .getField("service").alias("service"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("n").alias("event_count"),
        F.sum("errors").alias("error_count"),
        F.sum("slow").alias("slow_count"),
    )
