"""Row types of events and anomalies, and the fixed values of their fields."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TS, _B = T.TimestampType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Names and types of the fields of events and anomalies.
EVENT = _struct(
    event_id=_S, timestamp=_TS, epoch_ms=_L, service=_S, event_type=_S, region=_S, user_id=_S,
    session_id=_S, latency_ms=_D, status_code=_I, is_anomaly=_B, anomaly_type=_S, payload_bytes=_I,
    metadata=_struct(client=_S, version=_S),
)

#: Fields every event must carry; ``anomaly_type`` may be null.
REQUIRED = [f.name for f in EVENT if f.name != "anomaly_type"]

ANOMALY = _struct(
    service=_S, anomaly_type=_S, window_start=_TS, window_end=_TS, detected_at=_TS, event_count=_L,
    prev_event_count=_L, error_count=_L, avg_latency_ms=_D, p99_latency_ms=_D, baseline_p99=_D,
    drop_pct=_D, severity=_S, session_key=_S, anomaly_score=_D,
)

# Event domains, per-service latency model (mean, sigma in ms), histogram bounds.
SERVICES = [
    "payment-gateway",
    "user-auth",
    "product-catalog",
    "order-management",
    "inventory-sync",
    "recommendation-engine",
    "search-service",
    "notification-hub",
]
REGIONS = ["us-east-1", "us-west-2", "eu-west-1", "ap-southeast-1"]
CLIENTS = ["web", "mobile-ios", "mobile-android", "api"]
ERROR_CODES = [500, 502, 503, 504]
SERVICE_LATENCY = [
    ("payment-gateway", 120.0, 30.0),
    ("user-auth", 40.0, 10.0),
    ("product-catalog", 25.0, 8.0),
    ("order-management", 90.0, 20.0),
    ("inventory-sync", 60.0, 15.0),
    ("recommendation-engine", 200.0, 50.0),
    ("search-service", 45.0, 12.0),
    ("notification-hub", 30.0, 8.0),
]
DEFAULT_LATENCY = (50.0, 15.0)
LATENCY_BOUNDS = [1, 5, 10, 50, 100, 250, 500, 1000, 2500, 5000]
INDEX_LATENCY_BOUNDS = [1, 5, 10, 50, 100, 500, 1000]
