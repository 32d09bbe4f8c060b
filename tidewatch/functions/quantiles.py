"""Quantiles that never hold or shuffle one group's raw values.

Values fall on a logarithmic grid of cells 2 % wide: a few hundred cells per group,
whatever the traffic. Counts per cell combine inside map tasks, so only small tables are shuffled.

* ``grid_quantile`` answers from the cells alone, within 1 %.
* ``exact_quantile`` uses the cells to find the one or two that hold the wanted rank and
  reads the data once more for just their values.
* ``quantile`` is the exact aggregate over value counts, for streams, which
  allow neither ranking nor a second reading.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.session import materialise

CELLS = 50  # per factor of e
CHUNK = 240  # panes whose windows one task merges


def grid(value: Column) -> Column:
    """Cell of a value; never decreases with the value. Values up to one share the first cell."""
    return F.floor(F.ln(F.greatest(value, F.lit(1.0))) * F.lit(CELLS)).cast("long")


def grid_value(cell: Column) -> Column:
    """Middle of a cell (geometric)."""
    return F.exp((cell + F.lit(0.5)) / F.lit(float(CELLS)))


def quantile(value: Column, q: float, n: str = "n") -> Column:
    """Exact interpolated quantile over value counts; state is one entry per distinct value."""
    return F.percentile(value, F.lit(q), F.col(n))


def with_rank(counts: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds ``upto`` (rows of the group up to this value) and ``total`` to counts ``n``."""
    part = W.partitionBy(*group)
    upto = F.sum("n").over(part.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return counts.withColumn("upto", upto).withColumn("total", F.sum("n").over(part))


def quantile_at(q: float, value: Column) -> Column:
    """Aggregate over ranked counts: the interpolated quantile of a group."""
    last = F.col("total") - 1
    low = F.min(F.when(F.col("upto") > F.floor(F.lit(q) * last), value))
    high = F.min(F.when(F.col("upto") > F.ceil(F.lit(q) * last), value))
    rank = F.lit(q) * (F.max("total") - 1)
    return low + (high - low) * (rank - F.floor(rank))


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the keys appear once."""
    there = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(there[f"_{k}"]) for k in keys])
    return left.join(there, same, how).drop(*[f"_{k}" for k in keys])


def _rows(df: DataFrame, keys: list[str], pane: Column, value: Column) -> DataFrame:
    rows = df.where(value.isNotNull()).select(*keys, pane.alias("pane"), value.alias("value"))
    return rows.withColumn("cell", grid(F.col("value")))


def _cell_ranks(rows: DataFrame, keys: list[str], panes: int, cells: DataFrame | None = None) -> DataFrame:
    """Ranked cell counts of every window of ``panes`` consecutive panes, numbered by its first pane."""
    group = [*keys, "win"]
    if cells is None:
        cells = rows.groupBy(*keys, "pane", "cell").agg(F.count(F.lit(1)).alias("n"))
    if panes == 1:
        return with_rank(cells.withColumnRenamed("pane", "win"), group, "cell")
    # counts travel once (those near a chunk's start twice), whatever the windows' width; each task spreads
    # the panes of its chunks over their windows, adds up and ranks without another shuffle
    size = max(CHUNK, 8 * panes)
    first, last = F.col("pane") - (panes - 1), F.col("pane")
    chunks = F.array_distinct(F.array(F.floor(first / size), F.floor(last / size)))
    near = cells.select(*keys, "pane", "cell", "n", F.explode(chunks).alias("chunk")).repartition(*keys, "chunk")
    windows = F.sequence(F.greatest(first, F.col("chunk") * size), F.least(last, F.col("chunk") * size + (size - 1)))
    merged = near.select(*keys, "chunk", "cell", "n", F.explode(windows).alias("win")).groupBy(
        *keys, "chunk", "win", "cell").agg(F.sum("n").alias("n"))
    return with_rank(merged, [*keys, "chunk", "win"], "cell").drop("chunk")


def grid_quantile(df: DataFrame, keys: list[str], pane: Column, value: Column, q: float, panes: int = 1,
                  cells: DataFrame | None = None) -> DataFrame:
    """``keys, win, total, quantile`` of every window that holds a value, from cell counts."""
    ranked = _cell_ranks(_rows(df, keys, pane, value), keys, panes, cells)
    return ranked.groupBy(*keys, "win").agg(
        F.max("total").alias("total"), quantile_at(q, grid_value(F.col("cell"))).alias("quantile"))


def exact_quantile(df: DataFrame, keys: list[str], pane: Column, value: Column, q: float, panes: int = 1,
                   cells: DataFrame | None = None) -> DataFrame:
    """``keys, win, total, quantile`` of every window that holds a value, exactly.

    ``cells`` are counts ``n`` by ``keys, pane, cell`` that exist already; without them the data is read once for them.

    The wanted cells are stored first, so that the planner knows their size:
    below the session's broadcast threshold the second reading filters the data without any shuffle,
    above it the join is an ordinary shuffled one.
    """
    group, cell_key = [*keys, "win"], [*keys, "pane", "cell"]
    rows = _rows(df, keys, pane, value)
    rank = F.lit(q) * (F.col("total") - 1)
    wanted = (
        _cell_ranks(rows, keys, panes, cells)
        .where((F.col("upto") > F.floor(rank)) & (F.col("upto") - F.col("n") <= F.ceil(rank)))
        .select(*group, "cell", "total", (F.col("upto") - F.col("n")).alias("before"))
        .withColumn("pane", F.explode(F.sequence("win", F.col("win") + (panes - 1))))
    )
    wanted = materialise(wanted, "cells")
    near = (
        join_same(rows, wanted.select(*cell_key).distinct(), cell_key, "left_semi")
        .groupBy(*cell_key, "value").agg(F.count(F.lit(1)).alias("n"))
    )
    # between the wanted cells of a window there are no other values, so ranks go on from the first one's start
    ranked = with_rank(join_same(near, wanted, cell_key).drop("pane", "cell").withColumnRenamed("total", "all"), group, "value")
    first = F.min("before").over(W.partitionBy(*group))
    return (
        ranked.select(*group, "value", (first + F.col("upto")).alias("upto"), F.col("all").alias("total"))
        .groupBy(*group).agg(F.max("total").alias("total"), quantile_at(q, F.col("value")).alias("quantile"))
    )
