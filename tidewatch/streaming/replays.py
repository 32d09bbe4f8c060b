"""Each event once in the store, however late a copy of it comes.

Beside the events lies a Bloom filter for each event date: blocks of eight 32-bit words, an event setting one bit of each word
of one block (``bloom_blocks`` blocks a date, 32 bytes each). A batch adds a row for each block it touches, so nothing is
rewritten. Only events whose bits are all set, copies and about one in a thousand others, are looked up in the store itself, by key
and within their dates; so a filter that is too small costs lookups, never events.

A copy has the id (without an id: all the fields) and the time of its event. A batch never counts its own earlier attempt; one that
was written in full is not written again. Runs with checkpoints of their own keep folders of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schemas import EVENT
from tidewatch.session import has_file
from tidewatch.settings import DEFAULTS, Settings

WORDS = [f"w{j}" for j in range(8)]
FILTER = f"day date, block bigint, {', '.join(f'{w} int' for w in WORDS)}, run string, batch_id bigint"
LOOKUPS = 500  # keys that are pushed into the scan of the store; more are joined
_EVENTS = [f.name for f in EVENT]
#: Rows of the store: accepted events or rejected messages, then the folders they lie in.
STORED = T.StructType([
    *EVENT.fields, T.StructField("message", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("event_date", T.DateType())])


def event_key() -> Column:
    """What copies of an event share."""
    return F.coalesce(F.concat(F.lit("i"), "event_id"), F.concat(F.lit("w"), F.to_json(F.struct(*_EVENTS))))


def event_day() -> Column:
    """The event's date; events without a time have a day of their own."""
    return F.coalesce(F.to_date("timestamp"), F.lit("1970-01-01").cast("date"))


def keyed(events: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Adds ``key, day, block`` and the bit of each word."""
    marked = events.withColumn("key", event_key()).withColumn("day", event_day())
    bits = F.xxhash64("key", F.lit(1))
    return marked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(cfg.bloom_blocks))).withColumns({
        w: F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * j).bitwiseAND(31).cast("int")) for j, w in enumerate(WORDS)})


def blocks(marked: DataFrame) -> DataFrame:
    """The filter rows of some events."""
    return marked.groupBy("day", "block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


class ReplayFilter:
    """The filters and the store at ``path`` as one batch of one run sees them."""

    def __init__(self, spark: SparkSession, path: str, run: str, batch_id: int, cfg: Settings = DEFAULTS):
        self.spark, self.path, self.cfg = spark, path, cfg
        self.earlier = (F.col("run") != run) | (F.col("batch_id") < batch_id)

    def _days(self, marked: DataFrame) -> list:
        return [r.day for r in marked.select("day").distinct().collect()]  # one for each date of the batch

    def maybe_seen(self, marked: DataFrame, days: list) -> DataFrame:
        """Keys of a batch whose bits earlier batches have all set."""
        if not has_file(self.spark, f"{self.path}_seen"):
            return marked.select("day", "key").limit(0)
        known = self.spark.read.schema(FILTER).parquet(f"{self.path}_seen").where(F.col("day").isin(days) & self.earlier)
        known = blocks(known).withColumnsRenamed({w: f"_{w}" for w in WORDS})
        are_set = reduce(lambda a, b: a & b, [F.col(w).bitwiseAND(F.col(f"_{w}")) != 0 for w in WORDS])
        return marked.join(known, ["day", "block"]).where(are_set).select("day", "key").distinct()

    def fresh(self, marked: DataFrame) -> DataFrame:
        """The events of a batch that are not in the store, each once; ``marked`` is read several times."""
        once = marked.dropDuplicates(["day", "key"])
        days = self._days(marked)
        maybe = self.maybe_seen(marked, days).persist()
        try:
            some = [r.key for r in maybe.select("key").limit(LOOKUPS + 1).collect()]
            if not some:
                return once
            stored = self.spark.read.schema(STORED).parquet(self.path).where("status = 'accepted'").where(self.earlier)
            dated = [d for d in days if d.year > 1970]
            stored = stored.where(F.col("event_date").isin(dated) | F.col("event_date").isNull())
            ids = [k[1:] for k in some if k[0] == "i"]
            if len(ids) == len(some) <= LOOKUPS:
                stored = stored.where(F.col("event_id").isin(ids))  # reaches the scan
            seen = stored.select(event_day().alias("day"), event_key().alias("key")).join(maybe, ["day", "key"], "left_semi").distinct()
            return once.join(seen, ["day", "key"], "left_anti")
        finally:
            maybe.unpersist()
