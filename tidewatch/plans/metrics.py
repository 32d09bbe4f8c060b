"""Counters, histograms, gauges, lag and alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import exact, request_status
from tidewatch.schemas import LATENCY_BOUNDS
from tidewatch.settings import DEFAULTS, Settings, seconds


def events_by_status(ev: DataFrame) -> DataFrame:
    return ev.groupBy("service", request_status().alias("status")).agg(F.count(F.lit(1)).alias("event_count"))


def summaries_by_model(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy("model").agg(F.count(F.lit(1)).alias("summary_count"))


def histogram(df: DataFrame, key: str, value: str = "latency_ms", bounds: list[int] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative histogram per key: rows up to each bound, all rows, and their sum.

    One pass over the data: a counter per bound, turned into rows afterwards.
    """
    counters = [F.count_if(F.col(value) <= b).alias(f"le_{b}") for b in bounds]
    wide = df.groupBy(key).agg(
        *counters, F.count(value).alias("total"), F.sum(exact(value)).cast("double").alias("value_sum"))
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"le_{b}").alias("bucket_count")) for b in bounds]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("bucket_count")))
    return wide.select(key, F.inline(F.array(*rows)), F.col("total").alias("value_count"), "value_sum")


def last_value(samples: DataFrame, keys: list[str], value: str, time: str = "ts") -> DataFrame:
    """A gauge keeps the last value set."""
    return samples.groupBy(*keys).agg(F.max_by(value, time).alias(value), F.max(time).alias(time))


def consumer_lag(latest: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages behind the latest offset per topic and partition; never read means all of them."""
    keys = ["topic", "partition"]
    newest = latest.groupBy(*keys).agg(F.max("offset").alias("latest_offset"))
    done = committed.groupBy(*keys).agg(F.max("offset").alias("committed_offset"))
    return newest.join(done, keys, "left").select(
        *keys, "latest_offset", "committed_offset",
        (F.col("latest_offset") - F.coalesce("committed_offset", F.lit(-1))).alias("lag"))


def lag_alerts(lag: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return lag.where(F.col("lag") > cfg.lag_alert)


def shard_lag(records: DataFrame) -> DataFrame:
    """Seconds between the newest record of a shard and the newest one read (flag ``is_read``)."""
    newest = F.unix_micros(F.max("timestamp"))
    read = F.unix_micros(F.max(F.when(F.col("is_read"), F.col("timestamp"))))
    return records.groupBy("stream", "shard_id").agg(((newest - read) / F.lit(1_000_000)).alias("lag_s"))


def metric_points(namespace: str, name: str, rows: DataFrame, value: str | Column, labels: list[str],
                  unit: str = "Count") -> DataFrame:
    """One datapoint per row, labelled by some of its columns."""
    pairs = [c for label in labels for c in (F.lit(label), F.col(label))]
    value = F.col(value) if isinstance(value, str) else value
    return rows.select(
        F.lit(namespace).alias("namespace"), F.lit(name).alias("metric_name"),
        value.cast("double").alias("value"), F.lit(unit).alias("unit"), F.create_map(*pairs).alias("dimensions"))


def delivery_rate(reports: DataFrame, width_s: int = 10) -> DataFrame:
    """Delivered messages per second and failures, per interval (rows carry ``failed``)."""
    return (
        reports.groupBy(F.window("timestamp", seconds(width_s)).alias("w"))
        .agg(F.count_if(~F.col("failed")).alias("sent"), F.count_if("failed").alias("errors"))
        .select(F.col("w.start").alias("window_start"), "sent", "errors",
                (F.col("sent") / F.lit(width_s)).alias("events_per_second"))
    )


def delivery_total(reports: DataFrame) -> DataFrame:
    """Totals and mean rate of a whole run."""
    elapsed = (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(1_000_000)
    return reports.agg(
        F.count_if(~F.col("failed")).alias("sent"), F.count_if("failed").alias("errors"),
        elapsed.alias("elapsed_s"),
    ).withColumn("mean_rate", F.coalesce(F.try_divide("sent", "elapsed_s"), F.lit(0.0)))


def anomaly_rate(ev: DataFrame, width_s: int | None = None) -> DataFrame:
    """Share of events labelled anomalous, overall or per window."""
    counts = [F.count(F.lit(1)).alias("event_count"), F.count_if("is_anomaly").alias("anomaly_count")]
    rate = (F.col("anomaly_count") / F.col("event_count")).alias("anomaly_rate")
    if width_s is None:
        return ev.agg(*counts).select("event_count", "anomaly_count", rate)
    windows = ev.groupBy(F.window("timestamp", seconds(width_s)).alias("w")).agg(*counts)
    return windows.select(F.col("w.start").alias("window_start"), "event_count", "anomaly_count", rate)


def anomaly_rate_alerts(ev: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return anomaly_rate(ev, 60).where(F.col("anomaly_rate") > cfg.anomaly_rate_alert)
