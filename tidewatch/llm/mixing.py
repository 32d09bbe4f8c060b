"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Sources, in code point order with null last, weigh ``weights`` in turn and share ``percent`` of all sizes; a target stops at
``most`` times its source's size, and the excess goes to the other sources by weight until none is above.
A document's expected copies are its source's target over its size. Within a source the documents are put in order,
their expected copies are added up from one random offset on, and a document is emitted once for each whole number
that the sum crosses: never more than ``most`` times, and a source's emitted copies differ from the expected ones by
less than one, wherever the order is cut. Documents are ordered by size (in steps of 1/16), then by hash, so the words taken
differ from the target by at most about one of the largest documents.

No ordered pass sees a whole source. A piece is one source, size step and hash byte. Documents are counted within their
piece; the pieces before it come from counts of pieces within a size step (256 at most) and of size steps within a source
(a thousand at most). Expected copies are whole multiples of 2**-26, so all sums are exact in any order and
reruns agree; the offset is a hash of seed and source. Sources are numbered by a distributed sort, targets found by a few
aggregates over one row for each source; nothing is collected but totals.

Defined results: a null text has size 0; a null source is a source of its own, the last; a null id hashes as an empty one; rows
with equal ids are documents of their own, and rows equal in id and text are interchangeable. Sources of size 0 take
nothing; an empty table gives an empty table. Rows keep their columns in the struct ``row``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.session import materialise

from .rows import carried

ONE = 1 << 26  # a whole copy
WORD = r"[^\x20\x09-\x0D]+"
PIECE = ["key", "step", "cell"]


def _before(order: W) -> Column:
    return F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def source_key(source: Column) -> Column:
    """A source as text that is never null and sorts like the source, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(">"))


def size_step(size: Column) -> Column:
    """The leading five bits of a size and how many follow, as text in the order of sizes."""
    return F.concat(F.lpad(F.length(F.bin(size)), 2, "0"), F.rpad(F.substring(F.bin(size), 1, 5), 5, "0"))


def positions(sources: DataFrame) -> DataFrame:
    """Adds ``nr``, the number of each source from 0 on: a distributed sort, numbered by partition and place in it."""
    placed = materialise(sources.orderBy("key").withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = parts.select("part", _before(W.orderBy("part")).alias("start"))  # a row for each partition
    local = F.col("place").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("part", part).join(starts, "part").withColumn("nr", F.col("start") + local).drop("place", "part", "start")


def targets(sources: DataFrame, weights: list[int], percent: int, most: int) -> DataFrame:
    """``key, source_size, target, expected`` (copies in units of 1/ONE) from ``key, source_size``.

    Shares are exact fractions: ``level`` = (percent * all - 100 * what capped sources take) / (100 * free weight).
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("nr") % len(weights) + 1).cast("int"))
    weighed = materialise(positions(sources).withColumn("w", w.cast("long")).drop("nr"), "weights")
    cap = F.col("source_size").cast("decimal(38,0)") * most
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    over, under = percent * total, 100 * (weighed.agg(F.sum("w")).first()[0] or 1)  # level = over / under
    while True:
        above = cap * under < F.col("w").cast("decimal(38,0)") * over
        taken, weight = weighed.where(above).agg(F.sum(cap), F.sum("w")).first()
        free = weighed.where(~above).agg(F.sum("w")).first()[0]
        level = (percent * total - 100 * int(taken or 0), 100 * (free or 0))
        if level == (over, under) or not free:
            break
        over, under = level
    share = F.lit(over).cast("double") * F.col("w") / F.lit(under).cast("double")
    target = F.when(above, (F.col("source_size") * most).cast("double")).otherwise(share)
    copies = F.when(F.col("source_size") == 0, 0.0).otherwise(F.col("target") / F.col("source_size"))
    return weighed.withColumn("target", target).select(
        "key", "source_size", "target", F.floor(F.least(copies, F.lit(float(most))) * ONE).alias("expected"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (3, 1, 2),
        percent: int = 150, most: int = 2, seed: str = "mix", columns: list[str] | None = None) -> DataFrame:
    """Each row as struct ``row`` with ``size, source_size, target, copies``; ``copies`` is how often the mix takes it."""
    row, _ = carried(docs, columns)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = materialise(docs.select(
        row, source_key(F.col(source)).alias("key"), F.regexp_count(content, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"), F.md5(content))).alias("hash")), "sized")
    wanted = materialise(targets(rows.groupBy("key").agg(F.sum("size").alias("source_size")), list(weights), percent, most), "targets")
    placed = rows.withColumn("step", size_step(F.col("size"))).withColumn("cell", F.substring("hash", 1, 2))
    pieces = materialise(placed.groupBy(*PIECE).agg(F.count("*").alias("n")), "pieces")
    in_step = pieces.withColumn("in_step", _before(W.partitionBy("key", "step").orderBy("cell"))).drop("n")
    steps = pieces.groupBy("key", "step").agg(F.sum("n").alias("n"))
    steps = steps.withColumn("in_source", _before(W.partitionBy("key").orderBy("step"))).drop("n")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "key")), 1, 6), 16, 10).cast("long") * (ONE >> 24)
    known = in_step.join(steps, ["key", "step"]).join(wanted, "key").select(
        *PIECE, "source_size", "target", "expected", (F.col("in_step") + F.col("in_source")).alias("earlier"), offset.alias("offset"))
    local = F.row_number().over(W.partitionBy(*PIECE).orderBy("hash", "size"))
    counted = placed.withColumn("local", local).join(known, PIECE)
    # a prefix sum of equal terms is their number times the term
    upto = (F.col("earlier") + F.col("local")) * F.col("expected") + F.col("offset")
    crossed = F.expr(f"(upto div {ONE}) - ((upto - expected) div {ONE})")
    return counted.withColumn("upto", upto).select("row", "size", "source_size", "target", crossed.alias("copies"))


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken, with its ``copy`` from 1 on."""
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
