"""Reading the raw ``events`` table and shaping it into the event model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.events import interval
from tidewatch.schemas import CLIENTS, ERROR_CODES, REGIONS, SERVICES
from tidewatch.session import is_folder

RAW_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
BASE_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
#: Time compression: 30 days become 30 minutes (windows) or 12 hours (sessions).
WINDOWS, SESSIONS = 1440, 60


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(f"{folder}/events.parquet")


def raw_event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """New rows of ``events.parquet``, which is a file or a folder of part files."""
    table = f"{folder}/events.parquet"
    reader = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    if is_folder(spark, table):
        return reader.parquet(table)
    return reader.option("pathGlobFilter", "events.parquet").parquet(folder)


def _pick(values: list, index: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast({index} as int) + 1)"


def conform(raw: DataFrame, factor: int) -> DataFrame:
    """Raw rows as events, with two planted outages and one planted latency fault.

    Works on tables and streams alike; only column expressions, so unused
    fields (the JSON ``props`` among them) are never computed.
    """
    since = f"(unix_micros(cast(ts as timestamp)) - {BASE_US})"
    event_us = f"({BASE_US} + {since} div {factor})"
    minute = f"({since} div {WINDOWS * 60_000_000})"
    k = "cast(get_json_object(props, '$.k') as int)"
    index = "(user_id % 8)"
    slow = f"({index} = 3 and {minute} between 14 and 16)"
    return raw.where(f"not ({index} = 5 and {minute} in (9, 20) and event_id % 10 < 8)").selectExpr(
        "cast(event_id as string) as event_id",
        f"timestamp_micros({event_us}) as timestamp",
        f"{event_us} div 1000 as epoch_ms",
        f"{_pick(SERVICES, index)} as service",
        "event_type",
        f"{_pick(REGIONS, f'({k} % 4)')} as region",
        "concat('user_', user_id) as user_id",
        "concat('sess_', user_id) as session_id",
        f"if({slow}, value * 8, value) as latency_ms",
        f"if(event_type = 'error', {_pick(ERROR_CODES, f'({k} % 4)')}, 200) as status_code",
        f"{slow} or event_type = 'error' as is_anomaly",
        f"case when {slow} then 'latency_spike' when event_type = 'error' then 'error_burst' end as anomaly_type",
        "cast(200 + event_id * 7919 % 7993 as int) as payload_bytes",
        f"named_struct('client', {_pick(CLIENTS, '(event_id % 4)')}, 'version', "
        f"concat('v', 1 + {k} % 5, '.', {k} % 10, '.', event_id % 10)) as metadata",
    )


def events(spark: SparkSession, folder: str, factor: int = WINDOWS, last_s: int | None = None) -> DataFrame:
    """All events; with ``last_s`` only row groups that reach into the last seconds are read (a bound on the raw time)."""
    raw = raw_events(spark, folder)
    if last_s is not None:
        raw = raw.where(F.col("ts") >= raw.agg(F.max("ts") - interval(factor * (last_s + 1))).scalar())
    return conform(raw, factor)


def event_stream(spark: SparkSession, folder: str, factor: int = WINDOWS, watermark: str = "10 seconds") -> DataFrame:
    return conform(raw_event_stream(spark, folder), factor).withWatermark("timestamp", watermark)
