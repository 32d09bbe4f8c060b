"""Dashboard panels and saved searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import interval, is_server_error, pane_index, pane_time
from tidewatch.functions.quantiles import exact_quantile
from tidewatch.operators.ordering import top_k
from tidewatch.operators.windows import events_per_window
from tidewatch.schemas import SERVICES
from tidewatch.settings import DEFAULTS, Settings, seconds


def events_per_second(ev: DataFrame) -> DataFrame:
    return events_per_window(ev, 1)


def event_rate(ev: DataFrame) -> DataFrame:
    """Total events, time span and mean events per second."""
    span = (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(1_000_000)
    return ev.agg(F.count(F.lit(1)).alias("event_count"), span.alias("span_s")).withColumn(
        "events_per_second", F.try_divide("event_count", "span_s"))


def anomaly_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("service", "anomaly_type").agg(F.count(F.lit(1)).alias("anomaly_count"))


def p99_by_service(ev: DataFrame, cfg: Settings = DEFAULTS, width_s: int = 10) -> DataFrame:
    """p99 per service in every non-empty bucket; the highest services of each, marked against the line."""
    p99 = exact_quantile(ev, ["service"], pane_index("timestamp", width_s), F.col("latency_ms"), 0.99)
    best = top_k(p99, ["win"], [F.desc("quantile"), F.col("service")], cfg.top_services)
    return best.select(
        pane_time("win", width_s).alias("bucket"), "service", F.col("quantile").alias("p99_latency_ms"), "rank",
        (F.col("quantile") > cfg.latency_line_ms).alias("breach"),
    )


def error_rate(ev: DataFrame, width_s: int = 10) -> DataFrame:
    return (
        ev.groupBy("service", F.window("timestamp", seconds(width_s)).alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"), F.count_if(is_server_error()).alias("error_count"))
        .select("service", F.col("w.start").alias("window_start"), "event_count", "error_count",
                (F.col("error_count") / F.col("event_count")).alias("error_rate"))
    )


def heatmap(ev: DataFrame, width_s: int = 60) -> DataFrame:
    return events_per_window(ev, width_s, ["service"])


def heatmap_grid(ev: DataFrame, width_s: int = 60, services: list[str] = SERVICES) -> DataFrame:
    """The heatmap with one column per known service and ``other`` for all else, so that rows add up to all events."""
    cells = heatmap(ev, width_s).withColumn(
        "service", F.when(F.col("service").isin(services), F.col("service")).otherwise("other"))
    return cells.groupBy("window_start").pivot("service", [*services, "other"]).agg(F.sum("event_count")).na.fill(0)


def active_anomalies(found: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """Anomalies of the last minutes, per service and type."""
    recent = found.where(
        (F.col("detected_at") > as_of - interval(60 * cfg.active_minutes)) & (F.col("detected_at") <= as_of))
    return recent.groupBy("service", "anomaly_type").agg(
        F.count(F.lit(1)).alias("anomaly_count"), F.max("detected_at").alias("last_detected_at"))


def summary_table(summaries: DataFrame, outer: int = 10, inner: int = 5) -> DataFrame:
    """Summary counts by generation time and service: the largest times, then their largest services."""
    times = summaries.groupBy("generated_at").agg(F.count(F.lit(1)).alias("total"))
    largest = times.orderBy(F.desc("total"), "generated_at").limit(outer)
    services = summaries.select("generated_at", F.explode("services").alias("service"))
    # ``outer`` rows at most, so this side is always small
    counts = services.join(F.broadcast(largest), "generated_at").groupBy("generated_at", "total", "service").agg(
        F.count(F.lit(1)).alias("summary_count"))
    return top_k(counts, ["generated_at"], [F.desc("summary_count"), F.col("service")], inner).drop("rank")


def latest(ev: DataFrame) -> Column:
    """The time of the last event, standing in for "now"."""
    return ev.agg(F.max("timestamp").alias("as_of")).scalar()


def last_hour(ev: DataFrame, as_of: Column) -> DataFrame:
    return ev.where((F.col("timestamp") > as_of - interval(3600)) & (F.col("timestamp") <= as_of))


def search(df: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """Rows that satisfy a free-form condition; all rows when there is none."""
    return df if condition is None else df.where(condition)


def event_search(ev: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """Saved search over events."""
    return search(ev, condition).select(
        "event_id", "timestamp", "service", "event_type", "latency_ms", "status_code", "is_anomaly")


def summary_search(summaries: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """Saved search over summaries."""
    return search(summaries, condition).select(
        "generated_at", "services", "anomaly_types", "anomaly_count", "summary")
