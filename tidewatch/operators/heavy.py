"""The most frequent keys among any number of keys, from mergeable summaries of bounded size.

Each pane keeps a summary of at most ``tracked`` keys. Summaries are stored, merged for any span, and name the candidates; one more
reading counts these exactly. A summary of n rows misses no key of more than ``3.5 n / tracked`` rows, so if the last of the
top exceeds that, the result is exact; if not, no key is heavy, and all keys are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.events import pane_index
from tidewatch.session import materialise

TRACKED = 1024


def _name(key: Column) -> Column:
    """A key as text that is never null; null is a key of its own."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def pane_summaries(rows: DataFrame, key: str, width_s: int = 60, tracked: int = TRACKED) -> DataFrame:
    """``pane, n, summary`` from rows with a ``timestamp``."""
    named = rows.select(pane_index("timestamp", width_s).alias("pane"), _name(F.col(key)).alias("name"))
    return named.groupBy("pane").agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(name, {tracked})").alias("summary"))


def merged(panes: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``n, summary`` of all panes together: one row, or none without rows."""
    return panes.groupBy(F.lit(1).alias("all")).agg(
        F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary")).drop("all")


def top_keys(rows: DataFrame, key: str, k: int = 8, panes: DataFrame | None = None, tracked: int = TRACKED) -> DataFrame:
    """``key, n, rank`` of the ``k`` most frequent keys, exactly; ties go to the smaller key, null first.

    ``panes`` are the stored ``pane_summaries`` of the same rows, if there are any.
    """
    whole = materialise(merged(pane_summaries(rows, key, tracked=tracked) if panes is None else panes, tracked), "summary")
    names = whole.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {tracked})")).alias("item")).select(F.col("item.item").alias("name"))
    named = rows.select(_name(F.col(key)).alias("name"), F.col(key).alias("key"))

    def largest(of: DataFrame) -> DataFrame:
        return of.groupBy("name").agg(F.first("key").alias("key"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(k)

    found = materialise(largest(named.join(F.broadcast(names), "name")), "top")  # tracked names at most
    error = 3.5 * (whole.agg(F.sum("n")).first()[0] or 0) / tracked  # no key that is not named has more rows
    seen = [r.n for r in found.collect()]  # k rows
    if len(seen) < k or min(seen) <= error:
        found = materialise(largest(named), "top")
    return found.select("key", "n", F.row_number().over(Window.orderBy(F.desc("n"), "name")).alias("rank"))
