"""Connected components of a link table by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialise, release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or smaller) neighbours of each node, and for the small star the node, to its least neighbour."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of ``links(a, b)``; loops and repeats are ignored.

    A star's hub may hold any share of the links: minima are combined before the shuffle, and the join that
    carries them back is an equi-join that the adaptive skew rule splits.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        old, edges = edges, materialise(_star(_star(edges, True), False), "stars")
        release(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
