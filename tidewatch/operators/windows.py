"""Window statistics and the rule for windows that are complete.

Every operator reduces events to counts per pane (and latency cell) inside map
tasks, so a service with most of the traffic costs no more shuffle or memory
than a quiet one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import (
    exact, interval, is_server_error, mean_of, pane_index, pane_time, window_bounds,
)
from tidewatch.functions.quantiles import (
    exact_quantile, grid, grid_quantile, grid_value, join_same, quantile,
)
from tidewatch.session import materialise
from tidewatch.settings import DEFAULTS, Settings, seconds


def closed_at(ev: DataFrame, cfg: Settings = DEFAULTS) -> Column:
    """Latest window end that is final: the watermark after the last event."""
    return ev.agg((F.max("timestamp") - interval(cfg.watermark_s)).alias("closed_at")).scalar()


def only_closed(windows: DataFrame, ev: DataFrame, end: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """Drop unfinished windows from a table; a stream's watermark does it by itself."""
    return windows if ev.isStreaming else windows.where(end <= closed_at(ev, cfg))


def pane_table(ev: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """What the window detectors need from a table of events, read once and stored: a row per service, slide and latency cell.

    ``timestamp`` is the last event's. The table has a few hundred rows per service and slide, whatever the traffic.
    """
    cell = F.when(F.col("latency_ms").isNotNull(), grid(F.col("latency_ms")))
    return materialise(
        ev.groupBy("service", pane_index("timestamp", cfg.slide_s).alias("pane"), cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(is_server_error()).alias("errors"),
            F.sum(exact()).alias("latency"),
            F.count("latency_ms").alias("timed"),
            F.max("timestamp").alias("timestamp"),
        ), "panes")


def tumbling_stats(ev: DataFrame, width_s: int, q: float = 0.99) -> DataFrame:
    """Count, errors, mean and p99 latency per service and window."""
    return _stats_stream(ev, width_s, q) if ev.isStreaming else _stats_table(ev, width_s, q)


def _stats_table(ev: DataFrame, width_s: int, q: float) -> DataFrame:
    pane = pane_index("timestamp", width_s)
    stats = ev.groupBy("service", pane.alias("win")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(is_server_error()).alias("error_count"),
        mean_of(F.sum(exact()), F.count("latency_ms")).alias("avg_latency_ms"),
    )
    p99 = exact_quantile(ev, ["service"], pane, F.col("latency_ms"), q)
    return join_same(stats, p99, ["service", "win"], "left").select(
        "service", pane_time("win", width_s).alias("window_start"),
        pane_time(F.col("win") + 1, width_s).alias("window_end"),
        "event_count", "error_count", "avg_latency_ms", F.col("quantile").alias("p99_latency_ms"))


def _stats_stream(ev: DataFrame, width_s: int, q: float) -> DataFrame:
    """Chained windows: counts per latency value, then the window over them."""
    counts = (
        ev.groupBy("service", F.window("timestamp", seconds(width_s)).alias("w"), "latency_ms")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_server_error()).alias("errors"))
        .select("service", "latency_ms", "n", "errors", F.window_time("w").alias("t"))
    )
    timed = F.when(F.col("latency_ms").isNotNull(), F.col("n"))
    return (
        counts.groupBy("service", F.window("t", seconds(width_s)).alias("w"))
        .agg(
            F.sum("n").alias("event_count"),
            F.sum("errors").alias("error_count"),
            mean_of(F.sum((exact() * F.col("n")).cast("decimal(38,6)")), F.sum(timed)).alias("avg_latency_ms"),
            quantile(F.col("latency_ms"), q).alias("p99_latency_ms"),
        )
        .select("service", *window_bounds("w"), "event_count", "error_count", "avg_latency_ms", "p99_latency_ms")
    )


def sliding_p99(ev: DataFrame, cfg: Settings = DEFAULTS, on_grid: bool = False,
                table: DataFrame | None = None) -> DataFrame:
    """p99 latency per service and sliding window, complete or not; exact, or within 1 % on the grid.

    ``table`` is the ``pane_table`` of the same events, if there is one.
    """
    if ev.isStreaming:
        windows = value_panes(ev, cfg.slide_s, on_grid).groupBy(
            "service", F.window("pane_time", seconds(cfg.sliding_s), seconds(cfg.slide_s)).alias("w"))
        return windows.agg(F.sum("n").alias("event_count"), quantile(F.col("value"), 0.99).alias("p99_latency_ms")).select(
            "service", *window_bounds("w"), "event_count", "p99_latency_ms")
    panes = cfg.sliding_s // cfg.slide_s
    measure = grid_quantile if on_grid else exact_quantile
    found = measure(ev, ["service"], pane_index("timestamp", cfg.slide_s), F.col("latency_ms"), 0.99, panes,
                    None if table is None else table.where("cell is not null").select("service", "pane", "cell", "n"))
    return found.select(
        "service",
        pane_time("win", cfg.slide_s).alias("window_start"),
        pane_time(F.col("win") + panes, cfg.slide_s).alias("window_end"),
        F.col("total").alias("event_count"),
        F.col("quantile").alias("p99_latency_ms"),
    )


def value_panes(ev: DataFrame, width_s: int, on_grid: bool) -> DataFrame:
    """First level of chained windows: ``service, value, n, pane_time`` per pane and latency (or its cell)."""
    value = grid(F.col("latency_ms")) if on_grid else F.col("latency_ms")
    panes = (
        ev.where(F.col("latency_ms").isNotNull())
        .groupBy("service", F.window("timestamp", seconds(width_s)).alias("pane"), value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    value = grid_value(F.col("value")) if on_grid else F.col("value")
    return panes.select("service", value.alias("value"), "n", F.window_time("pane").alias("pane_time"))


def events_per_window(ev: DataFrame, width_s: int, keys: list[str] | None = None) -> DataFrame:
    """Number of events per window (and key)."""
    return (
        ev.groupBy(*(keys or []), F.window("timestamp", seconds(width_s)).alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(*(keys or []), F.col("w.start").alias("window_start"), "event_count")
    )
