"""The three anomaly detectors and their common record.

Each takes events (a table, or a stream with a watermark on ``timestamp``) and
returns anomaly records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import exact, interval, is_server_error, mean_of, pane_time
from tidewatch.functions.quantiles import grid, grid_value, quantile
from tidewatch.operators.sessions import sessions
from tidewatch.operators.windows import only_closed, pane_table, sliding_p99, value_panes
from tidewatch.schemas import ANOMALY
from tidewatch.settings import DEFAULTS, Settings, seconds


def severity(measured: Column, threshold: float) -> Column:
    ratio = measured / F.lit(threshold)
    return F.when(ratio >= 2, "critical").when(ratio >= 1.5, "high").otherwise("medium")


def drop_share(current: Column, previous: Column) -> Column:
    return (previous - current) / previous


def throughput_drop(ev: DataFrame, cfg: Settings = DEFAULTS, table: DataFrame | None = None) -> DataFrame:
    """Services whose event count fell by more than the threshold against the window before.

    Events are counted once per pane; each pane then enters two double-width
    windows, as the current half of one and the previous half of the other. A
    window without any current event is therefore seen too: a full outage.
    ``table`` is the ``pane_table`` of the same events; then these are not read again.
    """
    width = cfg.tumbling_s
    if table is None or width % cfg.slide_s:
        panes = ev.groupBy("service", F.window("timestamp", seconds(width)).alias("pane")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(is_server_error()).alias("errors"),
            F.sum(exact()).alias("latency"),
            F.count("latency_ms").alias("timed"),
        )
    else:
        ev = table
        panes = table.groupBy("service", F.window(pane_time("pane", cfg.slide_s), seconds(width)).alias("pane")).agg(
            *[F.sum(c).alias(c) for c in ("n", "errors", "latency", "timed")])
    t = F.col("pane_time")
    current = t >= F.col("w.end") - interval(width)
    pairs = (
        panes.select("service", "n", "errors", "latency", "timed", F.window_time("pane").alias("pane_time"))
        .withColumn("w", F.window("pane_time", seconds(2 * width), seconds(width)))
        .groupBy("service", "w")
        .agg(
            F.sum(F.when(current, F.col("n")).otherwise(0)).alias("event_count"),
            F.sum(F.when(current, 0).otherwise(F.col("n"))).alias("prev_event_count"),
            F.sum(F.when(current, F.col("errors")).otherwise(0)).alias("error_count"),
            F.sum(F.when(current, F.col("latency"))).alias("latency"),
            F.sum(F.when(current, F.col("timed"))).alias("timed"),
        )
    )
    share = drop_share(F.col("event_count"), F.col("prev_event_count"))
    found = pairs.where((F.col("prev_event_count") > 0) & (share > cfg.drop_threshold))
    return only_closed(found, ev, F.col("w.end"), cfg).select(
        "service",
        F.lit("throughput_drop").alias("anomaly_type"),
        (F.col("w.end") - interval(width)).alias("window_start"),
        F.col("w.end").alias("window_end"),
        (F.col("w.end") + interval(cfg.watermark_s)).alias("detected_at"),
        "event_count", "prev_event_count", "error_count",
        mean_of(F.col("latency"), F.col("timed")).alias("avg_latency_ms"),
        (100 * share).alias("drop_pct"),
        severity(share, cfg.drop_threshold).alias("severity"),
    )


def throughput_drop_joined(ev: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """``throughput_drop`` as a join of each window with the one right after it, each side an aggregate of its own.

    The window before is the outer side, so a window without any current event comes out once the watermark shows that none will
    follow. Both sides expire by the time condition: at most the windows of the watermark delay and one width are held.
    """
    width = cfg.tumbling_s
    panes = ev.groupBy("service", F.window("timestamp", seconds(width)).alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_server_error()).alias("errors"), F.sum(exact()).alias("latency"),
        F.count("latency_ms").alias("timed"))
    before = panes.select(F.col("service").alias("service"), F.col("n").alias("prev_event_count"), F.window_time("pane").alias("before"))
    now = panes.select(F.col("service").alias("now_service"), "n", "errors", "latency", "timed", F.window_time("pane").alias("now"))
    after = F.col("before") + interval(width)
    follows = F.col("service").eqNullSafe(F.col("now_service")) & (F.col("now") >= after) & (F.col("now") <= after)
    current = F.coalesce(F.col("n"), F.lit(0))
    end = F.col("before") + F.expr("INTERVAL 1 MICROSECOND") + interval(width)
    share = drop_share(current, F.col("prev_event_count"))
    found = before.join(now, follows, "left").where(share > cfg.drop_threshold)
    return only_closed(found, ev, end, cfg).select(
        "service",
        F.lit("throughput_drop").alias("anomaly_type"),
        (end - interval(width)).alias("window_start"), end.alias("window_end"),
        (end + interval(cfg.watermark_s)).alias("detected_at"),
        current.alias("event_count"), "prev_event_count", F.coalesce("errors", F.lit(0)).alias("error_count"),
        mean_of(F.col("latency"), F.col("timed")).alias("avg_latency_ms"),
        (100 * share).alias("drop_pct"),
        severity(share, cfg.drop_threshold).alias("severity"),
    )


def latency_spike(ev: DataFrame, cfg: Settings = DEFAULTS, method: str = "exact",
                  table: DataFrame | None = None) -> DataFrame:
    """Windows whose p99 exceeds a multiple of the p99 of the window right before.

    ``method="exact"`` interpolates true p99 values. ``method="grid"`` puts
    latencies on a 1 % grid first: a few hundred counters per service and pane
    whatever the traffic, which is the form for long-running streams.
    ``method="early"`` is the grid form for update mode: a stream reports a window as soon as
    it qualifies, and again when it grows; keep the last row per service and window.
    ``table`` is the ``pane_table`` of the same events, if there is one.
    """
    if method not in ("exact", "grid", "early") or (method == "early" and not ev.isStreaming):
        raise ValueError(f"unknown method: {method}")
    if method == "early":
        pairs = _spike_pairs_early(ev, cfg)
    else:
        on_grid = method == "grid"
        pairs = _spike_pairs_stream(ev, cfg, on_grid) if ev.isStreaming else _spike_pairs_table(ev, cfg, on_grid, table)
    p99, base = F.col("p99_latency_ms"), F.col("baseline_p99")
    found = pairs.where(
        (F.col("event_count") >= cfg.spike_min_events) & (F.col("base_count") >= cfg.spike_min_events)
        & (p99 > cfg.spike_multiplier * base)
    )
    return only_closed(found, ev if table is None else table, F.col("window_end"), cfg).select(
        "service",
        F.lit("latency_spike").alias("anomaly_type"),
        (F.col("window_end") - interval(cfg.sliding_s)).alias("window_start"),
        "window_end",
        (F.col("window_end") + interval(cfg.watermark_s)).alias("detected_at"),
        "event_count", "p99_latency_ms", "baseline_p99",
        severity(p99 / base, cfg.spike_multiplier).alias("severity"),
    )


def _spike_pairs_table(ev: DataFrame, cfg: Settings, on_grid: bool, table: DataFrame | None) -> DataFrame:
    """Every sliding window is measured once, then offered as current and as baseline."""
    stats = sliding_p99(ev, cfg, on_grid, table)
    width = interval(cfg.sliding_s)
    roles = F.array(
        F.struct(F.lit(True).alias("current"), F.col("window_end").alias("window_end")),
        F.struct(F.lit(False).alias("current"), (F.col("window_end") + width).alias("window_end")),
    )
    offered = stats.select("service", "event_count", "p99_latency_ms", F.inline(roles))
    now = F.col("current")
    return offered.groupBy("service", "window_end").agg(
        F.max(F.when(now, F.col("event_count"))).alias("event_count"),
        F.max(F.when(~now, F.col("event_count"))).alias("base_count"),
        F.max(F.when(now, F.col("p99_latency_ms"))).alias("p99_latency_ms"),
        F.max(F.when(~now, F.col("p99_latency_ms"))).alias("baseline_p99"),
    )


def _spike_pairs_stream(ev: DataFrame, cfg: Settings, on_grid: bool) -> DataFrame:
    """Chained windows: value counts per pane, merged into double-width windows."""
    return _halves(value_panes(ev, cfg.slide_s, on_grid), "pane_time", cfg)


def _spike_pairs_early(ev: DataFrame, cfg: Settings) -> DataFrame:
    """One aggregate straight over the events, as update mode allows no chain; values on the grid."""
    rows = ev.where(F.col("latency_ms").isNotNull()).select(
        "service", "timestamp", F.lit(1).alias("n"), grid_value(grid(F.col("latency_ms"))).alias("value"))
    return _halves(rows, "timestamp", cfg)


def _halves(counts: DataFrame, time: str, cfg: Settings) -> DataFrame:
    """Counts and p99 of both halves of double-width windows."""
    current = F.col(time) >= F.col("w.end") - interval(cfg.sliding_s)
    return (
        counts.withColumn("w", F.window(time, seconds(2 * cfg.sliding_s), seconds(cfg.slide_s)))
        .groupBy("service", "w")
        .agg(
            F.sum(F.when(current, F.col("n")).otherwise(0)).alias("event_count"),
            F.sum(F.when(current, 0).otherwise(F.col("n"))).alias("base_count"),
            quantile(F.when(current, F.col("value")), 0.99).alias("p99_latency_ms"),
            quantile(F.when(~current, F.col("value")), 0.99).alias("baseline_p99"),
        )
        .withColumn("window_end", F.col("w.end"))
    )


def session_anomalies(ev: DataFrame, key: str = "session_id", slow: Column | None = None,
                      cfg: Settings = DEFAULTS) -> DataFrame:
    """Sessions whose score exceeds the threshold."""
    score = F.col("anomaly_score")
    return (
        sessions(ev, key, slow, cfg)
        .where((F.col("event_count") >= cfg.session_min_events) & (score > cfg.session_score))
        .select(
            "service",
            F.lit("session_anomaly").alias("anomaly_type"),
            "window_start", "window_end",
            (F.col("window_end") + interval(cfg.watermark_s)).alias("detected_at"),
            "event_count", "error_count",
            severity(score, cfg.session_score).alias("severity"),
            "session_key", "anomaly_score",
        )
    )


def window_anomalies(ev: DataFrame, cfg: Settings = DEFAULTS) -> list[DataFrame]:
    """Throughput drops and latency spikes of a table, which is read once for both and once more for exact p99 values."""
    table = pane_table(ev, cfg)
    return [throughput_drop(ev, cfg, table), latency_spike(ev, cfg, table=table)]


def as_anomalies(found: DataFrame) -> DataFrame:
    """Any detector's output as full anomaly records."""
    present = set(found.columns)
    return found.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in ANOMALY
    ])


def anomalies(*found: DataFrame) -> DataFrame:
    """One table or stream of anomaly records from several detectors."""
    return reduce(DataFrame.unionByName, [as_anomalies(f) for f in found])
