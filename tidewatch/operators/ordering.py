"""Positions and running counts inside groups of any size, and top-k.

A plain ranking window sorts a whole group in one task. Here a group is cut along a
coarse prefix of its order: counts per piece give each piece its offset,
and only pieces are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def number_within(df: DataFrame, group: list[str], coarse: list[str], order: list[str]) -> DataFrame:
    """Adds ``position`` (from 1) in each group, ordered by ``coarse`` and then ``order``.

    ``coarse`` columns must not be null.
    """
    piece = [*group, *coarse]
    before = W.partitionBy(*group).orderBy(*coarse).rowsBetween(W.unboundedPreceding, -1)
    offsets = df.groupBy(*piece).agg(F.count(F.lit(1)).alias("size")).select(
        *piece, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(W.partitionBy(*piece).orderBy(*order))
    return (
        df.withColumn("local", local).join(offsets, piece)
        .withColumn("position", F.col("offset") + F.col("local")).drop("local", "offset")
    )


def count_earlier(df: DataFrame, group: list[str], time: str, name: str,
                  history: DataFrame | None = None) -> DataFrame:
    """Adds how many rows of the same group, here and in ``history``, have a strictly earlier time.

    Rows are first counted per instant, then per minute; the ordered passes see
    minutes of a group and instants of a minute, never all rows of a group.
    """
    known = df.select(*group, time)
    if history is not None:
        known = known.unionByName(history.select(*group, time))
    instants = known.groupBy(*group, time).agg(F.count(F.lit(1)).alias("n"))
    return df.join(earlier_sums(instants, group, time, name), [*group, time])


def earlier_sums(instants: DataFrame, group: list[str], time: str, name: str) -> DataFrame:
    """``name``: the sum of ``n`` over strictly earlier instants of the group, for one row per group and instant."""
    instants = instants.withColumn("minute", F.date_trunc("minute", time))
    minutes = instants.groupBy(*group, "minute").agg(F.sum("n").alias("n"))
    past = W.partitionBy(*group).orderBy("minute").rowsBetween(W.unboundedPreceding, -1)
    offsets = minutes.select(*group, "minute", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("offset"))
    inner = W.partitionBy(*group, "minute").orderBy(time).rowsBetween(W.unboundedPreceding, -1)
    return (
        instants.withColumn("local", F.coalesce(F.sum("n").over(inner), F.lit(0)))
        .join(offsets, [*group, "minute"])
        .select(*group, time, (F.col("offset") + F.col("local")).alias(name))
    )


def top_k(df: DataFrame, group: list, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark limits groups before the shuffle too."""
    return (
        df.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
        .where(F.col("rank") <= k)
    )


def page(df: DataFrame, order: list[Column], number: int = 1, size: int = 10) -> DataFrame:
    """One page of a totally ordered result."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)
