"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact confirmation, components.

1. A document's set holds the 64-bit hashes of its distinct word shingles. Equal sets are one class, named by its least
   id, so copies cost nothing later on.
2. Signatures of ``bands * rows`` MinHash values; each band is a bucket key. In a bucket every class is paired with
   the least and the greatest class only.
3. Pairs are compared one batch of signature values after another. A pair goes as soon as the posterior probability
   that its similarity reaches the threshold, given the agreements so far and a uniform prior, is below ``miss``.
4. Survivors are confirmed on their full sets, from their texts. Links give components.
5. What step 2 did not pair: in buckets of four classes and more, classes of different components are compared with
   each other in blocks of bounded size (signatures first, full sets for survivors), and only links leave a block. Classes of one
   component need no further link. So every pair that shares a bucket is linked, or rejected, or already connected.

There are as many bands as it takes for a pair at the threshold t to share no bucket with a probability of
(1 - t ** rows) ** bands <= ``miss``.

Defined results: a null or empty text has an empty set and is linked with nothing; a row with a null id is linked
with nothing, has no component and is kept; rows with equal ids are one document, linked if any of their texts is; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialise, release

from . import words as W
from .components import components

BLOCK = 1024  # classes of a bucket that are compared with each other at a time
GROUP = 2_000  # classes in one task of step 5
BROADCAST = 1_000_000  # ids that may be broadcast (8 MB); more are joined by a shuffle

_rng = np.random.default_rng(7)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = W.words(column, fold=True)
    h, whole = W.windows(w, width)
    first = w.first()
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            s = h[a:b - width + 1].copy()
            s.sort()
            s = s[np.r_[True, s[1:] != s[:-1]]]
        elif b > a:  # the whole sequence is the only shingle
            s = np.frombuffer(hashlib.blake2b(w.hash[a:b].tobytes(), digest_size=8).digest(), np.uint64)
        else:
            s = np.empty(0, np.uint64)
        out.append(s)
    return out


def _describe(width: int, k: int):
    scale = (_rng.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
    shift = _rng.integers(0, 2**32, k, dtype=np.uint32)[:, None]

    def signature(s: np.ndarray) -> bytes:
        least = np.full(k, 0xFFFFFFFF, np.uint32)
        x = (s >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(x), 1024):
            values = x[a:a + 1024] * scale
            values += shift
            np.minimum(least, values.min(axis=1), out=least)
        return least.tobytes()

    def run(batches):
        for batch in batches:
            for a, b in W.parts(batch.column(1)):
                part = batch.slice(a, b - a)
                sets = shingle_sets(part.column(1), width)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                known: dict[bytes, bytes] = {}
                for d, s in zip(digests, sets, strict=True):
                    if d not in known:
                        known[d] = signature(s)
                yield pa.record_batch({
                    "doc_id": part.column(0), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array(digests, pa.binary()), "sig": pa.array([known[d] for d in digests], pa.binary()),
                })
    return W.tidied(run)


def _signatures(column: pa.Array, k: int) -> np.ndarray:
    return W.buffers(column)[0].view(np.uint32).reshape(-1, k)


def _bands(bands: int, rows: int):
    salt = W.mix(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            sig = _signatures(batch.column(1), bands * rows).reshape(-1, bands, rows).astype(np.uint64)
            key = np.broadcast_to(salt, sig.shape[:2]).copy()
            for r in range(rows):
                key = W.mix(key + sig[:, :, r])
            yield pa.record_batch({
                "node": pa.array(np.repeat(batch.column(0).to_numpy(), bands), pa.int64()),
                "key": pa.array(key.ravel().view(np.int64), pa.int64()),
                "band": pa.array(np.tile(np.arange(bands, dtype=np.int32), len(sig))),
            })
    return W.tidied(run)


def least_agreements(batches: list[int], threshold: float, miss: float) -> list[int]:
    """For m compared values, the least number of agreements with P(similarity >= threshold) >= miss.

    With a uniform prior the similarity is Beta(a + 1, m - a + 1), and P(Beta >= t) = P(Binomial(m + 1, t) <= a).
    """
    out = []
    for m in batches:
        total, a = 0.0, -1
        while total < miss:
            a += 1
            total += comb(m + 1, a) * threshold**a * (1 - threshold) ** (m + 1 - a)
        out.append(a)
    return out


def _plausible(one: np.ndarray, two: np.ndarray, step: int, need: list[int]) -> np.ndarray:
    """Rows whose signatures survive every batch of ``step`` values."""
    left = np.arange(len(one))
    agreed = np.zeros(len(one), np.int64)
    for k, a in enumerate(need):
        s = slice(k * step, (k + 1) * step)
        agreed = agreed + (one[left, s] == two[left, s]).sum(axis=1)
        stay = agreed >= a
        left, agreed = left[stay], agreed[stay]
    return left


def _prune(k: int, step: int, need: list[int]):
    def run(batches):
        for batch in batches:
            left = _plausible(_signatures(batch.column(2), k), _signatures(batch.column(3), k), step, need)
            yield pa.record_batch({"a": batch.column(0).take(pa.array(left)), "b": batch.column(1).take(pa.array(left))})
    return W.tidied(run)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share enough."""
    if not len(x) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _link_blocks(k: int, rows_each: int, step: int, need: list[int], width: int, percent: int):
    """Links between classes of different components, from blocks of one bucket; ``side`` says which block a row is of.

    A pair that shares several buckets is looked at in the first one only. Plausible pairs are confirmed on the full sets
    here, so that only links leave the task, and no link inside what earlier links have joined.
    """
    def pairs(left, right, same, comp, n, sig, band):
        """Plausible pairs of rows, those of one row at a time."""
        for c in range(len(left)):
            two = left[c + 1:] if same else right
            one = left[c]
            near = (comp[two] != comp[one]) & (100 * np.minimum(n[two], n[one]) >= percent * np.maximum(n[two], n[one]))
            two = two[near]
            if not len(two):
                continue
            one = np.full(len(two), one)
            keep = _plausible(sig[one], sig[two], step, need)
            one, two = one[keep], two[keep]
            shared = (sig[one] == sig[two]).reshape(len(one), k // rows_each, rows_each).all(axis=2)
            own = shared.argmax(axis=1) == band[one]
            yield from zip(one[own].tolist(), two[own].tolist(), strict=True)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key, i, j, side, node, comp, n, band = (
            table[c].to_numpy() for c in ("key", "i", "j", "side", "node", "component", "n", "band"))
        sig, text = _signatures(table["sig"], k), table["text"].combine_chunks()
        sets: dict[int, np.ndarray] = {}
        above: dict[int, int] = {}

        def set_of(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingle_sets(text.slice(row, 1), width)[0]
            return sets[row]

        def top(c: int) -> int:
            while c in above:
                c = above[c]
            return c

        order = np.lexsort((side, j, i, key))
        cell = np.stack([key, i, j])[:, order]
        head = np.flatnonzero(np.r_[True, (cell[:, 1:] != cell[:, :-1]).any(axis=0)])
        found = []
        for a, b in zip(head, np.r_[head[1:], len(order)], strict=True):
            rows = order[a:b]
            sets.clear()
            same = i[rows[0]] == j[rows[0]]
            for x, y in pairs(rows[side[rows] == 0], rows[side[rows] == 1], same, comp, n, sig, band):
                one, two = top(int(comp[x])), top(int(comp[y]))
                if one != two and _similar(set_of(x), set_of(y), percent):
                    above[max(one, two)] = min(one, two)
                    found.append((int(node[x]), int(node[y])))
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(ends.min(axis=1), pa.int64()), "b": pa.array(ends.max(axis=1), pa.int64())})
    return W.tidied(run)


def _confirm(width: int, percent: int):
    def run(batches):
        for batch in batches:
            one, two = (pc.dictionary_encode(batch.column(c).fill_null("")) for c in (2, 3))
            texts = pa.concat_arrays([one.dictionary, two.dictionary])
            sets: list[np.ndarray] = []
            for a, b in W.parts(texts):
                sets += shingle_sets(texts.slice(a, b - a), width)
            linked = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(one.indices.to_pylist(), two.indices.to_pylist(), strict=True)):
                linked[k] = _similar(sets[x], sets[len(one.dictionary) + y], percent)
            yield batch.select([0, 1]).filter(pa.array(linked))
    return W.tidied(run)


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts of some ids; the ids are broadcast only if they are few."""
    return texts.join(F.broadcast(ids) if ids.count() <= BROADCAST else ids, "doc_id", "left_semi")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    texts = _texts_of(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct(), texts)
    return (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_confirm(width, percent), "a long, b long").distinct()
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                    rows: int = 5, miss: float = 1e-6) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row; ``percent`` is the least similarity in per cent."""
    step = 5 * rows
    bands = 5 * ceil(log(miss) / log(1 - (percent / 100) ** rows) / 5)
    k = bands * rows
    need = least_agreements(list(range(step, k + 1, step)), percent / 100, miss)
    own = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = materialise(
        own.mapInArrow(_describe(width, k), "doc_id long, n_shingles long, digest binary, sig binary"), "described")
    classes = materialise(
        described.where("doc_id is not null and n_shingles > 0")
        .groupBy("digest").agg(F.min("doc_id").alias("node"), F.any_value("sig").alias("sig"),
                               F.any_value("n_shingles").alias("n")), "classes")
    in_bands = classes.select("node", "sig").mapInArrow(_bands(bands, rows), "node long, key long, band int")
    buckets = materialise(
        in_bands.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("size"))
        .where("lo <> hi"), "buckets")

    side = classes.select("node", "n", "sig")
    close = (
        in_bands.join(buckets, "key")
        .select("node", F.explode(F.array("lo", "hi")).alias("other")).where("node <> other")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        .join(side.toDF("a", "n_a", "sig_a"), "a").join(side.toDF("b", "n_b", "sig_b"), "b")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .select("a", "b", "sig_a", "sig_b").mapInArrow(_prune(k, step, need), "a long, b long")
    )
    pairs = materialise(close, "pairs")
    links = materialise(_confirmed(pairs, own, width, percent), "links")
    joined = materialise(components(links), "components")
    release(pairs, links)

    # what the stars of the buckets left open
    rest = (
        in_bands.join(buckets.where("size > 3"), "key").where("node <> lo and node <> hi").select("key", "band", "node")
        .join(joined, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))
    )
    mixed = rest.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                    F.count("*").alias("size")).where("x <> y").select("key", "size")
    rest = materialise(rest.join(mixed, "key").distinct(), "rest")
    release(buckets)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    cells = rest.withColumn("blocks", blocks).withColumn("block", block).select(
        "key", "band", "node", "component",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
            F.least("block", o).alias("i"), F.greatest("block", o).alias("j"),
            F.when(F.col("block") <= o, 0).otherwise(1).alias("side")))).alias("c"),
    ).select("key", "band", "node", "component", "c.*")
    groups = 1 + cells.count() // GROUP
    texts = _texts_of(rest.select(F.col("node").alias("doc_id")).distinct(), own)
    more = materialise(
        cells.join(side, "node").join(texts.withColumnRenamed("doc_id", "node"), "node")
        .groupBy(F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)).alias("g"))
        .applyInArrow(_link_blocks(k, rows, step, need, width, percent), "a long, b long").distinct(), "links")
    if not more.isEmpty():
        joined = materialise(components(joined.toDF("a", "b").unionAll(more)), "components")
    release(rest, more)

    found = classes.select("digest", "node").join(joined, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id"))
    return (
        described.drop("sig").join(found, "digest", "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
                .otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", **how) -> DataFrame:
    """All columns of the rows that ``near_duplicates`` keeps."""
    gone = materialise(near_duplicates(docs, id, **how).where(~F.col("kept")).select(F.col("doc_id").alias(id)).distinct(), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST else gone, id, "left_anti").select(docs.columns)
