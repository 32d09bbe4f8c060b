"""Transport, lag and shard tables derived from the events, with known faults planted by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.dashboards import latest
from tidewatch.sources.ingest import to_wire

NUMBER = "cast(event_id as bigint)"


def messages(ev: DataFrame) -> DataFrame:
    """Keyed JSON messages; seven in a hundred are cut off, extended, mistyped, nested or incomplete."""
    wire = ev.select(F.col("service").alias("key"), to_wire(F.struct(*ev.columns)).alias("value"),
                     F.expr(f"{NUMBER} % 100").alias("nr"))
    return wire.select("key", F.expr("""
        case nr when 13 then substr(value, 1, length(value) - 5)
                when 27 then concat('{"zz":2,', substr(value, 2))
                when 41 then replace(value, '"metadata":{', '"metadata":{"zz":1,')
                when 59 then regexp_replace(value, '"latency_ms":[^,]*', '"latency_ms":"slow"')
                when 83 then regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":1704067201000')
                when 91 then regexp_replace(value, '"client":"[^"]*"', '"client":{"a":1}')
                when 73 then regexp_replace(value, '"region":"[^"]*",', '')
                else value end""").alias("value"))


def with_bad_times(wire: DataFrame) -> DataFrame:
    """Messages of which two in a hundred have times of the years 2999 and 1970."""
    nr = "cast(get_json_object(value, '$.event_id') as bigint) % 100"
    return wire.select("key", F.expr(f"""
        case {nr} when 17 then regexp_replace(value, '"timestamp":"....', '"timestamp":"2999')
                  when 31 then regexp_replace(value, '"timestamp":"....', '"timestamp":"1970')
                  else value end""").alias("value"))


def with_copies(ev: DataFrame) -> DataFrame:
    """Every twentieth event twice."""
    return ev.unionAll(ev.where(f"{NUMBER} % 20 = 3"))


def with_arrival(ev: DataFrame) -> DataFrame:
    """Every fortieth event arrives 90 seconds late."""
    return ev.withColumn("arrival", F.expr(
        f"timestamp + if({NUMBER} % 40 = 7, interval 90 seconds, interval 0 seconds)"))


def without_service(ev: DataFrame, name: str | None = None) -> DataFrame:
    """Every tenth event has no service, or one that is not known."""
    other = "null" if name is None else f"'{name}'"
    return ev.withColumn("service", F.expr(f"if({NUMBER} % 10 = 4, {other}, service)"))


def without_id(ev: DataFrame) -> DataFrame:
    """Every fiftieth event has no id."""
    return ev.withColumn("event_id", F.expr(f"if({NUMBER} % 50 = 3, null, event_id)"))


def offsets(ev: DataFrame) -> DataFrame:
    return ev.selectExpr("'analytics-events' as topic", f"cast({NUMBER} % 6 as int) as partition",
                         f"{NUMBER} div 6 as offset", "timestamp")


def commits(ev: DataFrame) -> DataFrame:
    """Partition p was read and committed up to p + 1 minutes before the end."""
    stop = latest(ev) - F.expr("make_dt_interval(0, 0, partition + 1, 0)")
    return offsets(ev).where(F.col("timestamp") <= stop)


def shard_records(ev: DataFrame, shards: int = 6) -> DataFrame:
    return ev.selectExpr("'analytics-events' as stream", f"concat('shard-', {NUMBER} % {shards}) as shard_id",
                         f"{NUMBER} div {shards} as sequence_number", f"cast({NUMBER} % {shards} as int) as nr",
                         "timestamp")


def with_idle_shard(records: DataFrame) -> DataFrame:
    """Shard two gets nothing from minute three to minute twenty."""
    return records.where("not (nr = 2 and minute(timestamp) between 3 and 20)")


def shard_list(ev: DataFrame) -> DataFrame:
    """Eight shards, the last two closed."""
    return shard_records(ev, 8).groupBy("shard_id", "nr").agg(
        F.min("sequence_number").alias("starting_seq"),
        F.when(F.col("nr") >= 6, F.max("sequence_number")).alias("ending_seq"),
    ).drop("nr")


def consumers(ev: DataFrame) -> DataFrame:
    """Shards two to seven have a consumer."""
    return shard_records(ev, 8).where("nr >= 2").select("shard_id").distinct()


def capacity(records: DataFrame) -> Column:
    """Records a shard can take per minute: its busiest minute, five times that in the second half of each quarter hour."""
    per_minute = records.groupBy("shard_id", F.window("timestamp", "1 minute")).count()
    peak = per_minute.agg(F.max("count").alias("peak")).scalar()
    return peak * F.when(F.minute("minute") % 15 < 8, 1).otherwise(5)


def checkpoints(ev: DataFrame) -> DataFrame:
    """Shards zero to three were read until minute twelve."""
    return shard_records(ev).where("nr < 4 and minute(timestamp) < 12").groupBy("shard_id").agg(
        F.max("sequence_number").alias("sequence_number"))


def reads(ev: DataFrame) -> DataFrame:
    """Shard n was read up to half a minute times n before the end."""
    upto = latest(ev) - F.expr("make_dt_interval(0, 0, 0, 30 * nr)")
    return shard_records(ev).withColumn("is_read", F.col("timestamp") <= upto)


def delivery_reports(ev: DataFrame) -> DataFrame:
    return ev.selectExpr("timestamp", f"{NUMBER} % 211 = 0 as failed")
