"""Thresholds and window widths. Durations are whole seconds."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # windows
    tumbling_s: int = 60
    sliding_s: int = 300
    slide_s: int = 30
    session_gap_s: int = 600
    watermark_s: int = 10
    trigger_s: int = 1
    # detectors (all thresholds are strict "greater than")
    drop_threshold: float = 0.40
    spike_multiplier: float = 2.0
    session_score: float = 0.85
    spike_min_events: int = 20
    session_min_events: int = 3
    slow_ms: float = 100.0
    slow_factor: float = 2.0
    # dashboards
    latency_line_ms: float = 500.0
    top_services: int = 8
    active_minutes: int = 10
    # alerts and scaling
    lag_alert: int = 50_000
    anomaly_rate_alert: float = 0.05
    scale_up: float = 0.70
    scale_down: float = 0.25
    scale_down_minutes: int = 5
    # reports
    report_batch: int = 10
    report_window_s: int = 30
    report_wait_s: int = 30
    report_model: str = "rules-v1"
    # transport
    topic: str = "analytics-events"
    alert_topic: str = "anomaly-alerts"
    max_ahead_s: int = 3600
    earliest: str = "2000-01-01T00:00:00Z"
    max_records_per_trigger: int = 500_000
    max_bytes_per_trigger: int = 256 << 20
    bulk_size: int = 500
    bloom_blocks: int = 1 << 17  # 4 MB for each event date, for some three million events


DEFAULTS = Settings()


def seconds(n: int) -> str:
    """Duration text for ``F.window``, ``withWatermark`` and triggers."""
    return f"{n} seconds"
