"""Message transport: reading, strict decoding, encoding, duplicates and start positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.events import interval
from tidewatch.schemas import EVENT, REQUIRED
from tidewatch.settings import DEFAULTS, Settings, seconds

_CORRUPT = "_corrupt"
_METADATA = EVENT["metadata"].dataType
#: An event as sent: the time as text and metadata as a map, so that both can be checked.
_AS_SENT = {"metadata": T.MapType(T.StringType(), T.VariantType()), "timestamp": T.StringType()}
_WIRE = T.StructType([
    *[T.StructField(f.name, _AS_SENT.get(f.name, f.dataType)) for f in EVENT],
    T.StructField(_CORRUPT, T.StringType()),
])
_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:?\d{2})?$"
#: ISO-8601 with microseconds and offset, so that times survive a round trip.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
POSITIONS = {"LATEST": "latest", "TRIM_HORIZON": "earliest"}


def source_options(servers: str, cfg: Settings = DEFAULTS, position: str = "LATEST",
                   at_ms: int | None = None, max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a Kafka source. A query's checkpoint always wins over the position."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": cfg.topic}
    if position == "AT_TIMESTAMP":
        if at_ms is None:
            raise ValueError("AT_TIMESTAMP needs a time")
        options["startingTimestamp"] = str(at_ms)
    else:
        options["startingOffsets"] = POSITIONS[position]
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options of a Kafka sink: 64 KB batches, 5 ms linger, snappy, idempotent sends.

    Idempotence needs acknowledgement by all replicas.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.batch.size": "65536",
        "kafka.linger.ms": "5",
        "kafka.compression.type": "snappy",
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.max.in.flight.requests.per.connection": "5",
        "kafka.enable.idempotence": "true",
    }


def read_stream(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    return spark.readStream.format(fmt).options(**options).load()


def _unknown(keys: Column, known: list[str]) -> Column:
    return F.size(F.array_except(keys, F.array(*[F.lit(k) for k in known]))) > 0


def _implausible(time: Column, arrival: str | None, cfg: Settings) -> Column:
    """A time well after the record's arrival (or the present, whichever is first), or before all records.

    One such event would drive the watermark past everything that follows.
    """
    now = F.current_timestamp()
    known = now if arrival is None else F.least(F.col(arrival).cast("timestamp"), now)
    return (time > known + interval(cfg.max_ahead_s)) | (time < F.lit(cfg.earliest).cast("timestamp"))


def decode(records: DataFrame, value: str = "value", arrival: str | None = None, cfg: Settings = DEFAULTS) -> DataFrame:
    """Adds ``event`` and ``reason``; a null reason means the record was accepted.

    Reasons: ``malformed`` (no JSON object), ``unknown_field`` (also inside
    ``metadata``), ``bad_value`` (a known field of the wrong type, a time that is no ISO text, metadata that
    is no plain value), ``implausible_time`` (more than ``max_ahead_s`` after the column ``arrival`` or the present, or
    before ``earliest``). Missing fields are accepted.
    """
    parsed = F.from_json("_text", _WIRE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # A one-element generator parses each record once: filters on the outcome
    # stay above it, where a plain column would be copied into every filter.
    out = records.withColumn("_text", F.col(value).cast("string")).select(
        "*", F.inline(F.array(F.struct(parsed.alias("_wire"), F.json_object_keys("_text").alias("_keys")))))
    extra = F.coalesce(_unknown(F.map_keys("_wire.metadata"), _METADATA.names), F.lit(False))
    sent = F.col("_wire.timestamp")
    time = F.when(sent.rlike(_ISO), F.try_to_timestamp(sent))
    nested = F.coalesce(F.exists(F.map_values("_wire.metadata"), lambda v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")), F.lit(False))
    reason = (
        F.when(F.col("_keys").isNull(), "malformed")
        .when(_unknown(F.col("_keys"), EVENT.names) | extra, "unknown_field")
        .when(F.col(f"_wire.{_CORRUPT}").isNotNull() | nested | (sent.isNotNull() & time.isNull()), "bad_value")
        .when(_implausible(time, arrival, cfg), "implausible_time")
    )
    metadata = F.struct(*[F.try_variant_get(F.col("_wire.metadata").getItem(c), "$", "string").alias(c) for c in _METADATA.names])
    checked = {"metadata": F.when(F.col("_wire.metadata").isNotNull(), metadata), "timestamp": time}
    fields = [checked.get(c, F.col(f"_wire.{c}")).alias(c) for c in EVENT.names]
    return out.withColumns({"event": F.struct(*fields), "reason": reason}).drop("_text", "_wire", "_keys")


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).select(*[F.col(f"event.{c}").alias(c) for c in EVENT.names])


def sorted_out(decoded: DataFrame, value: str = "value") -> DataFrame:
    """All records as rows of one store: accepted events, and rejected texts with their reason and no event fields."""
    taken = F.col("reason").isNull()
    return decoded.select(
        *[F.when(taken, F.col(f"event.{c}")).alias(c) for c in EVENT.names],
        F.when(~taken, F.col(value).cast("string")).alias("message"), "reason",
        F.when(taken, "accepted").otherwise("rejected").alias("status"))


def rejected(decoded: DataFrame) -> DataFrame:
    """Quarantine: everything but the parsed event, with the reason."""
    return decoded.where(F.col("reason").isNotNull()).drop("event")


def missing_fields() -> Column:
    """Required fields an event lacks, as an array."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))


def to_wire(row: Column) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false", "timestampFormat": TIME_FORMAT})


def encode(rows: DataFrame, key: str = "service") -> DataFrame:
    """Keyed JSON messages; null fields are kept."""
    return rows.select(F.col(key).alias("key"), to_wire(F.struct(*rows.columns)).alias("value"))


def dedupe(ev: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Each ``event_id`` once; events without an id are copies only if all their fields are equal.

    Streams remember ids for the watermark delay, so their state stays bounded.
    """
    key = ["event_id", "_whole"]
    whole = ev.withColumn("_whole", F.when(F.col("event_id").isNull(), F.to_json(F.struct(*ev.columns))))
    return (whole.dropDuplicatesWithinWatermark(key) if ev.isStreaming else whole.dropDuplicates(key)).drop("_whole")


def with_watermark(ev: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return ev.withWatermark("timestamp", seconds(cfg.watermark_s)) if ev.isStreaming else ev


def after_checkpoint(records: DataFrame, checkpoints: DataFrame, position: str = "TRIM_HORIZON",
                     at: Column | None = None) -> DataFrame:
    """Records still to be read per shard: after its checkpoint, else from the start position.

    ``LATEST`` without a checkpoint reads nothing that exists already.
    """
    without = {
        "TRIM_HORIZON": F.lit(True),
        "LATEST": F.lit(False),
        "AT_TIMESTAMP": None if at is None else F.col("timestamp") >= at,
    }[position]
    if without is None:
        raise ValueError("AT_TIMESTAMP needs a time")
    marks = checkpoints.groupBy("shard_id").agg(F.max("sequence_number").alias("read_up_to"))
    todo = F.coalesce(F.col("sequence_number") > F.col("read_up_to"), without)
    return records.join(marks, "shard_id", "left").where(todo).drop("read_up_to")
