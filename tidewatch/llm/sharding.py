"""Shards of bounded size by extendible hashing, with DataFrame functions only.

A directory is indexed by the leading bits of a hash. It starts with one bucket of depth 0; a bucket above the byte
limit splits on its next bit, the others stay. The sizes of all prefixes come from one aggregation over fine cells, each round
goes ``step`` bits deeper, and only rows of cells that still are too large go into the next round.

The first 60 bits are those of the key's hash, the next 60 those of the whole row's: one key may hold any share of the
rows and still splits. A bucket of one row is never split, so only a row above the limit makes a shard above it; rows
that are equal in every column (maps aside) stay together.

Defined results: a null text has 0 bytes; null keys are one key; an empty table gives an empty table; rows keep
all their columns in the struct ``row``, whatever their names.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialise

BITS = 60


def _hash(value: Column) -> Column:
    """60 bits of the MD5 of a string."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def _bits(hash: Column) -> Column:
    return F.lpad(F.bin(hash), BITS, "0")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """``cell, cell_bits, shard, depth, shard_bytes, shard_rows`` from ``rows(bits, n_bytes)``.

    A cell is a prefix of ``cell_bits`` bits; each row's prefix is in one cell, each cell belongs to one shard.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    at, step = 0, max(8, ceil(log2(max(1, total / limit))) + 4)
    done = None
    while True:
        deep = min(2 * BITS, at + step)
        cells = rows.groupBy(F.substring("bits", 1, deep).alias("cell")).agg(
            F.sum("n_bytes").alias("b"), F.count("*").alias("n"),
            (F.min(F.substring("bits", 1, BITS)) == F.max(F.substring("bits", 1, BITS))).alias("one_key"))
        cells = materialise(cells, "cells")
        levels = cells.select("cell", "b", "n", F.explode(F.sequence(F.lit(at), F.lit(deep))).alias("depth")).select(
            "cell", "depth", "b", "n", F.col("cell").substr(F.lit(1), F.col("depth")).alias("shard"))
        fits = levels.groupBy("shard", "depth").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows")).where(
            (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") == 2 * BITS))
        found = levels.select("cell", "shard", "depth").join(fits, ["shard", "depth"]).groupBy("cell").agg(
            F.min(F.struct("depth", "shard", "shard_bytes", "shard_rows")).alias("s")
        ).select("cell", F.lit(deep).alias("cell_bits"), "s.*")
        found = materialise(found, "directory")
        done = found if done is None else done.unionAll(found)
        left = cells.join(found, "cell", "left_anti").select("cell", "one_key")
        if deep == 2 * BITS or left.isEmpty():
            return done
        # keep only what must split further; its sizes at the depths already judged are above the limit
        rows = materialise(rows.withColumn("cell", F.substring("bits", 1, deep)).join(left, "cell", "left_semi").drop("cell"), "rows")
        if left.where("not one_key").isEmpty():  # bits of the key part nothing any more
            deep = max(deep, BITS)
        at, step = deep + 1, 8


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 128 << 20) -> DataFrame:
    """Each row as struct ``row`` with ``n_bytes, shard, depth, shard_bytes, shard_rows``; ``shard`` is the hash prefix."""
    content = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    whole = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        F.concat(_bits(_hash(F.coalesce(F.col(key).cast("string"), F.lit("")))),
                 _bits(F.shiftrightunsigned(F.xxhash64(*content), 4))).alias("bits"))
    rows = materialise(whole.select("bits", "n_bytes"), "rows")
    entries = directory(rows, limit)
    depths = [r[0] for r in entries.select("cell_bits").distinct().collect()]  # one for each round
    cells = F.array(*(F.concat_ws(":", F.lit(d), F.substring("bits", 1, d)) for d in depths)) if depths else F.array()
    named = entries.withColumn("name", F.concat_ws(":", "cell_bits", "cell")).drop("cell", "cell_bits")
    if len(depths) == 1:
        out = whole.withColumn("name", F.element_at(cells, 1)).join(named, "name", "left")
    else:
        one = rows.distinct().select("bits", F.explode(cells).alias("name")).join(named, "name").drop("name")
        out = whole.join(one.dropDuplicates(["bits"]), "bits", "left")
    return out.select("row", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows")
