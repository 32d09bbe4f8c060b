"""Column expressions on events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(number: Column, by: int) -> Column:
    """Integer division."""
    return F.call_function("div", number, F.lit(by))


def is_server_error(status: str | Column = "status_code") -> Column:
    return (F.col(status) if isinstance(status, str) else status) >= 500


def clean_latency(value: Column) -> Column:
    """At least one millisecond, two decimals."""
    return F.round(F.greatest(F.lit(1.0), value), 2)


def exact(value: str = "latency_ms") -> Column:
    """A number with six decimals: sums are exact, in any order."""
    return F.col(value).cast("decimal(28,6)")


def mean_of(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n)


def or_unknown(value: str) -> Column:
    return F.coalesce(F.col(value), F.lit("unknown"))


def request_status(status: str = "status_code") -> Column:
    return F.when(is_server_error(status), "error").otherwise("ok")


def clock_drift_ms(timestamp: str = "timestamp", epoch_ms: str = "epoch_ms") -> Column:
    """Event time minus the event's own epoch field."""
    return F.unix_millis(F.col(timestamp)) - F.col(epoch_ms)


def interval(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} SECONDS")


def pane_index(timestamp: str | Column, width_s: int) -> Column:
    """Number of the epoch-aligned pane of ``width_s`` seconds."""
    t = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return whole(F.unix_seconds(t), width_s)


def pane_time(index: str | Column, width_s: int) -> Column:
    i = F.col(index) if isinstance(index, str) else index
    return F.timestamp_seconds(i * F.lit(width_s))


def window_bounds(window: str = "window") -> list[Column]:
    return [F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end")]
