"""Mergeable sketches per service and pane, stored once and merged for any window.

A pane's row holds a KLL sketch of its latencies (quantiles within a rank error that ``QUANTILE_K`` sets) and an HLL sketch of a
key (distinct counts). Both have a bounded size whatever the traffic, combine inside map tasks before the shuffle, and also
bound a stream's state. Panes without a latency or key have null sketches, which merging ignores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import pane_index, pane_time
from tidewatch.settings import DEFAULTS, Settings, seconds

QUANTILE_K = 800
#: Largest rank error of one quantile at QUANTILE_K, with 99 % confidence and room for merging.
RANK_ERROR = 0.01
DISTINCT_BITS = 12
#: Three standard errors of a distinct count at DISTINCT_BITS.
DISTINCT_ERROR = 3 * 1.04 / (1 << DISTINCT_BITS) ** 0.5


def _sketched(key: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"), F.count("latency_ms").alias("timed"),
        F.kll_sketch_agg_double("latency_ms", QUANTILE_K).alias("latencies"),
        F.hll_sketch_agg(F.col(key), F.lit(DISTINCT_BITS)).alias("keys"),
    ]


def pane_sketches(ev: DataFrame, key: str = "user_id", cfg: Settings = DEFAULTS) -> DataFrame:
    """``service, pane, n, timed, latencies, keys``: a row per service and slide, of a table or a stream of events.

    ``pane`` is the number of the slide since the epoch.
    """
    if ev.isStreaming:
        panes = ev.groupBy("service", F.window("timestamp", seconds(cfg.slide_s)).alias("w")).agg(*_sketched(key))
        return panes.select("service", pane_index("w.start", cfg.slide_s).alias("pane"), "n", "timed", "latencies", "keys")
    return ev.groupBy("service", pane_index("timestamp", cfg.slide_s).alias("pane")).agg(*_sketched(key))


def merged(panes: DataFrame, width: int, every: int = 1, by: list[str] | None = None, cfg: Settings = DEFAULTS) -> DataFrame:
    """Windows of ``width`` panes, one ``every`` so many panes, merged from stored sketches.

    ``window_start, window_end, event_count, p99_latency_ms, distinct_keys`` per ``by`` (service by default; an empty list
    merges all services). Only sketches are shuffled.
    """
    keys = ["service"] if by is None else by
    last = F.floor(F.col("pane") / every) * every
    first = F.ceil((F.col("pane") - (width - 1)) / every) * every
    spread = panes.select(*keys, "n", "latencies", "keys", F.explode(F.sequence(first, last, F.lit(every).cast("long"))).alias("win"))
    sketches = spread.groupBy(*keys, "win").agg(
        F.sum("n").alias("event_count"),
        F.kll_merge_agg_double("latencies").alias("latencies"),
        F.hll_union_agg("keys").alias("keys"))
    return sketches.select(
        *keys, pane_time("win", cfg.slide_s).alias("window_start"), pane_time(F.col("win") + width, cfg.slide_s).alias("window_end"),
        "event_count", F.kll_sketch_get_quantile_double("latencies", F.lit(0.99)).alias("p99_latency_ms"),
        F.hll_sketch_estimate("keys").alias("distinct_keys"))


def error_of(windows: DataFrame, ev: DataFrame, key: str = "user_id", cfg: Settings = DEFAULTS) -> DataFrame:
    """Adds what the sketches missed: ``rank_error`` of the p99 and ``distinct_error`` as a share, against the events themselves.

    A rank is any between those of the values below and up to the p99. Events are matched by service and
    pane, so nothing but a window's own events meet it.
    """
    width = ((F.unix_seconds("window_end") - F.unix_seconds("window_start")) / cfg.slide_s).cast("int")
    first = pane_index("window_start", cfg.slide_s)
    cells = windows.withColumn("pane", F.explode(F.sequence(first, first + width - 1)))
    own = ev.select("service", pane_index("timestamp", cfg.slide_s).alias("pane"), "latency_ms", F.col(key).alias("_key"))
    found = cells.join(own, ["service", "pane"]).groupBy(*windows.columns).agg(
        F.count_if(F.col("latency_ms") < F.col("p99_latency_ms")).alias("below"),
        F.count_if(F.col("latency_ms") <= F.col("p99_latency_ms")).alias("upto"),
        F.count("latency_ms").alias("timed"), F.count_distinct("_key").alias("exact"))
    low, high = F.col("below") / F.col("timed"), F.col("upto") / F.col("timed")
    return found.select(
        *windows.columns, F.greatest(low - 0.99, F.lit(0.99) - high, F.lit(0.0)).alias("rank_error"),
        (F.abs(F.col("distinct_keys") - F.col("exact")) / F.col("exact")).alias("distinct_error"))
