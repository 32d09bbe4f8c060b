"""Lookups, set differences and events against reported windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import pane_index
from tidewatch.schemas import DEFAULT_LATENCY, SERVICE_LATENCY


def with_baseline(ev: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """Adds each service's usual latency (``mu``, ``sigma``) and the event's z-score.

    The built-in model has eight fixed rows and is broadcast. For a
    caller's own table the planner decides by its size.
    """
    if baseline is None:
        built_in = ev.sparkSession.createDataFrame(SERVICE_LATENCY, "service string, mu double, sigma double")
        baseline = F.broadcast(built_in)
    mu, sigma = DEFAULT_LATENCY
    return (
        ev.join(baseline, "service", "left")
        .withColumn("mu", F.coalesce("mu", F.lit(mu)))
        .withColumn("sigma", F.coalesce("sigma", F.lit(sigma)))
        .withColumn("zscore", (F.col("latency_ms") - F.col("mu")) / F.col("sigma"))
    )


def only_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``."""
    return left.join(right.select(key), key, "left_anti")


def in_windows(ev: DataFrame, windows: DataFrame, inside: bool = True, cell_s: int = 30) -> DataFrame:
    """Events that lie in some window of their service (or, with ``inside=False``, in none).

    Windows are spread over time cells, so that the join key is service and cell, not
    the service alone. A busy cell that still dominates is split by the
    adaptive skew join: semi and anti joins allow it on the event side.
    """
    first = pane_index("window_start", cell_s)
    last = pane_index(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND"), cell_s)
    cells = (
        windows.select("service", "window_start", "window_end").distinct()
        .withColumn("cell", F.explode(F.sequence(first, last)))
    ).alias("w")
    e = ev.withColumn("cell", pane_index("timestamp", cell_s)).alias("e")
    within = (
        (F.col("e.service") == F.col("w.service")) & (F.col("e.cell") == F.col("w.cell"))
        & (F.col("e.timestamp") >= F.col("w.window_start")) & (F.col("e.timestamp") < F.col("w.window_end"))
    )
    return e.join(cells, within, "left_semi" if inside else "left_anti").drop("cell")
