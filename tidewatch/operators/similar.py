"""Set-similarity join: which sets share most of their items, found by prefix filters.

Rows with equal sets are one class, whose members are counted, never paired. A class's items are ordered by how many classes hold
them, rarest first; two sets with ``100 * shared >= percent * union`` share an item among the first ``size - ceil(percent * size / 100) + 1``
of each, so only these items are joined, and only where sizes and positions still allow the overlap. Pairs found are checked on the
full sets.

Defined results: an empty or null set is similar to nothing, null items are left out, repeated items count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordering import earlier_sums
from tidewatch.session import materialise


def with_class(sets: DataFrame, items: str) -> DataFrame:
    """Adds ``class``, the digest of the set; null for an empty one."""
    own = F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull())))
    return sets.withColumn(items, F.coalesce(own, F.array().cast("array<string>"))).withColumn(
        "class", F.when(F.size(items) > 0, F.md5(F.to_json(F.col(items)))))


def similar_classes(classed: DataFrame, items: str, percent: int) -> DataFrame:
    """``class, other`` of all similar classes, both ways, each with itself too."""
    classes = materialise(classed.where("class is not null").groupBy("class").agg(F.first(items).alias("items")), "classes")
    held = classes.select("class", F.explode("items").alias("item"))
    known = held.groupBy("item").agg(F.count(F.lit(1)).alias("holders"))
    ranked = held.join(known, "item").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("holders", "item"))).alias("ranked"))
    size = F.size("ranked")
    ahead = ranked.select("class", size.alias("size"), F.posexplode(
        F.slice("ranked", 1, (size - F.ceil(F.lit(percent) * size / 100) + 1).cast("int"))).alias("at", "entry"))
    ahead = ahead.select("class", "size", "at", F.col("entry.item").alias("item"))
    other = ahead.select(*[F.col(c).alias(f"{c}_b") for c in ("class", "size", "at")], "item")
    # shared >= percent * union / 100 means shared * (100 + percent) >= percent * (size + size_b); items before these are not shared
    most = F.least(F.col("size") - F.col("at"), F.col("size_b") - F.col("at_b"))
    fits = most * (100 + percent) >= percent * (F.col("size") + F.col("size_b"))
    found = ahead.join(other, "item").where((F.col("class") < F.col("class_b")) & fits).select("class", "class_b").distinct()
    a, b = classes.select("class", F.col("items").alias("a")), classes.select(F.col("class").alias("class_b"), F.col("items").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    linked = found.join(a, "class").join(b, "class_b").where(
        100 * shared >= percent * (F.size("a") + F.size("b") - shared)).select("class", F.col("class_b").alias("other"))
    linked = materialise(linked, "links")
    return linked.unionByName(linked.select(F.col("other").alias("class"), F.col("class").alias("other"))).unionByName(
        classes.select("class", F.col("class").alias("other")))


def count_similar_earlier(sets: DataFrame, items: str, time: str, percent: int = 50, name: str = "similar_count") -> DataFrame:
    """Adds how many rows with a strictly earlier time have a similar set.

    Rows are counted per class and instant before these go to the similar classes, and the running sums see minutes of a class
    and instants of a minute.
    """
    classed = materialise(with_class(sets, items), "sets")
    instants = classed.where("class is not null").groupBy("class", time).agg(F.count(F.lit(1)).alias("n"))
    seen = instants.join(similar_classes(classed, items, percent), "class").groupBy(F.col("other").alias("class"), time).agg(F.sum("n").alias("n"))
    earlier = earlier_sums(seen, ["class"], time, name)
    return classed.join(earlier, ["class", time], "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("class")
