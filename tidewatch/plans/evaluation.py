"""Checks of labelled events: rules, rates and detections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import is_server_error
from tidewatch.schemas import REQUIRED


def required_violations(ev: DataFrame) -> DataFrame:
    """How many events lack each required field, counted in one pass."""
    wide = ev.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED])
    rows = [F.struct(F.lit(c).alias("field"), F.col(c).alias("missing")) for c in REQUIRED]
    return wide.select(F.inline(F.array(*rows)))


def label_violations(ev: DataFrame) -> DataFrame:
    """Events that contradict their label, per rule, counted in one pass."""
    kind = F.coalesce(F.col("anomaly_type"), F.lit(""))
    rules = {
        "normal_is_200": ~F.col("is_anomaly") & (F.col("status_code") != 200),
        "normal_has_no_type": ~F.col("is_anomaly") & F.col("anomaly_type").isNotNull(),
        "anomaly_has_type": F.col("is_anomaly") & F.col("anomaly_type").isNull(),
        "spike_is_slow": (kind == "latency_spike") & (F.col("latency_ms") <= 10),
        "burst_is_5xx": (kind == "error_burst") & ~is_server_error(),
        "burst_is_error_event": (kind == "error_burst") & (F.col("event_type") != "error"),
    }
    wide = ev.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    rows = [F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations")) for rule in rules]
    return wide.select(F.inline(F.array(*rows)))
