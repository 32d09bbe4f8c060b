"""Centroid clustering in exact integers, with an incremental distance matrix.

Each component ``x`` becomes the integer ``floor(scale * x)``. A written state table holds, for every vector, its squared
length and its exact dot product with each centroid. When centroids move, a round adds ``change * component`` for
the nonzero components of each centroid's change only, recomputes the distances ``|v|^2 - 2 v.c + |c|^2`` and their
argmin, and writes the next state. The first round takes the first centroids as changes from zero. Sums of clusters follow
the vectors that moved: they are added to the new cluster and taken from the old one.

What passes through the driver has a fixed size: ``k`` centroids and the ``k`` sums. Vectors never leave their partition,
so equal vectors, or a cluster with most of the rows, cost no more than others.

Defined results: vectors that are null, of another length, or with a null or non-finite component are left out; a null id
hashes as an empty one. Rows with equal ids are vectors of their own, with equal hashes ordered by their components.
With fewer than ``k`` vectors each is a centroid; an empty table gives an empty table. Distance ties go to the
smaller number; an empty cluster keeps its centroid. Only the id and the vector are read, so other columns cannot clash.
A component beyond ``LIMIT`` in size fails with a message, as its squared distances would not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialise, release

LIMIT = 1 << 27  # 64 * (2 * LIMIT)^2 is a long
ROWS = 4096  # vectors taken at a time


def vectors(table: DataFrame, id: str, column: str, size: int, scale: int) -> DataFrame:
    """``vec_id, v, norm`` of the vectors that count."""
    raw = F.col(column)
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = table.where((F.size(raw) == size) & finite).select(
        F.col(id).alias("vec_id"), F.transform(raw, lambda x: F.floor(scale * x.cast("double"))).alias("v"))
    small = F.when(F.forall("v", lambda x: x.between(-LIMIT, LIMIT)), F.col("v")).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is beyond {LIMIT}")))
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    return kept.select("vec_id", small.cast("array<int>").alias("v")).withColumn("norm", norm)


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors of the smallest hashes of seed and id, in the order of the hashes."""
    hashed = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"), "v")
    return np.array([r.v for r in hashed.orderBy("h", "v").limit(k).collect()], np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def assign(state: DataFrame, change: np.ndarray, centroids: np.ndarray, last: bool) -> DataFrame:
    """The next state: dot products updated by ``change``, the nearest centroid, and the cluster ``before``."""
    k, size = centroids.shape
    squares = (centroids * centroids).sum(1)
    moved = [(j, np.flatnonzero(change[j])) for j in range(k)]
    moved = [(j, at, change[j, at]) for j, at in moved if len(at)]
    fresh = "dots" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                b = batch.slice(start, ROWS)
                v, norm = _matrix(b["v"], size), b["norm"].to_numpy(zero_copy_only=False)
                dots = np.zeros((len(v), k), np.int64) if fresh else _matrix(b["dots"], k)
                for j, at, by in moved:
                    dots[:, j] += v[:, at] @ by
                distance = norm[:, None] - 2 * dots + squares
                cluster = distance.argmin(1)
                out = {"vec_id": b["vec_id"], "cluster": pa.array(cluster, pa.int32()),
                       "distance": pa.array(distance[np.arange(len(v)), cluster])}
                if not last:
                    del out["distance"]
                    ends = pa.array(np.arange(0, k * len(v) + 1, k), pa.int32())
                    out |= {"before": pa.nulls(len(v), pa.int32()) if fresh else b["cluster"], "v": b["v"], "norm": b["norm"],
                            "dots": pa.ListArray.from_arrays(ends, pa.array(dots.ravel()))}
                yield pa.RecordBatch.from_pydict(out)

    id_type = state.schema["vec_id"].dataType.simpleString()
    rest = "distance long" if last else "before int, v array<int>, norm long, dots array<long>"
    return state.mapInArrow(run, f"vec_id {id_type}, cluster int, {rest}")


def cluster_sums(state: DataFrame, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that moved add to each cluster's components and count; tasks add up first, 8 bytes a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, size + 1), np.int64)
        for batch in batches:
            v = _matrix(batch["v"], size)
            v = np.concatenate([v, np.ones((len(v), 1), np.int64)], 1)
            now, before = (batch[c].fill_null(-1).to_numpy(zero_copy_only=False) for c in ("cluster", "before"))
            for j in range(k):
                sums[j] += v[now == j].sum(0) - v[before == j].sum(0)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "n": pa.array(sums.ravel()[at])})

    moved = state.where("before is null or before <> cluster").select("v", "cluster", "before")
    total = np.zeros(k * (size + 1), np.int64)
    for r in moved.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[r["at"]] = r["n"]
    total = total.reshape(k, size + 1)
    return total[:, :-1], total[:, -1]


def cluster(table: DataFrame, id: str = "vec_id", column: str = "embedding", size: int = 64, k: int = 8, rounds: int = 10,
            scale: int = 1024, seed: str = "3") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector that counts.

    A round that moves no centroid ends the loop, as all later rounds would repeat it.
    """
    state = materialise(vectors(table, id, column, size, scale), "vectors")
    centroids = first_centroids(state, k, seed).reshape(-1, size)
    k, change = len(centroids), centroids
    sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
    for _ in range(rounds if k else 0):
        state, old = materialise(assign(state, change, centroids, False), "distances"), state
        release(old)
        by = cluster_sums(state, k, size)
        sums, counts = sums + by[0], counts + by[1]
        after = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
        change, centroids = after - centroids, after
        if not change.any():
            break
    found = materialise(assign(state, change, centroids, True) if k else state.selectExpr(
        "vec_id", "0 as cluster", "0L as distance"), "clusters")
    release(state)
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    known = [(j, s, sum(inertia.values()), centroids[j].tolist()) for j, s in inertia.items()]
    of_cluster = found.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(of_cluster), "cluster")  # k rows


def digest(centroid: str = "centroid") -> Column:
    """SHA-256 of a centroid's components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
