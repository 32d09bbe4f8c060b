"""A log-bilinear language model over word units, trained by noise-contrastive estimation.

Units. The most frequent words are units of their own, and so is the end of a text; all other words, known or not, fall into
bins by their last two bytes. p(word | context) = p(unit | the two units before) * p(word | unit), where a bin gives a word its
smoothed share of the bin's counts, and 0.5 is left for all unknown words of a bin.

Training. Spark counts all words of all training texts, then all (unit, unit, unit) runs in them, of which there are at most
``UNITS`` cubed. The runs are dealt by hash to ``TASKS`` tasks, which train in numpy from a common start, each on all its runs in
the order of their numbers; their parameters are averaged, weighted by tokens, and the next round starts from the average. So the
model depends on the texts only, not on files or partitions, and training takes bounded time, whatever the corpus.

Scoring. One batched matrix product gives the scores of all units after all pairs of units, normalised by a softmax; a
text's score adds up table entries. Counts of the ``head`` most frequent words are sent to all tasks (at most 16 bytes
each); tokens of rarer words are joined with their counts by a shuffle. Words that occur in most texts are head words, so
no key of that join is hot beyond its count in the corpus's tail.

Defined results: a null or empty text is one end token; a row with a null id is a training row; without a training row all
counts are 0 and every unit is equally likely; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialise, release

from . import words as W

FREQUENT, BINS = 191, 64
UNITS = FREQUENT + 1 + BINS  # frequent words, the end of a text, bins
END = FREQUENT
DIM = 32
HEAD = 500_000
BATCH, NOISE = 8192, 64
CHUNK = 4 << 20
TASKS = 16  # training tasks of a round, at every size
HELD = 1 << 20  # different runs that a counting task holds
STEPS = 96  # batches of a task in a round, at least


def _bins(w: W.Words) -> np.ndarray:
    """Bin of each word, from its last two bytes."""
    data = W._FOLD[w.data] if len(w.data) else w.data
    last = data[w.end - 1].astype(np.uint64) if len(w.end) else np.empty(0, np.uint64)
    before = np.where(w.end - w.start > 1, data[np.maximum(w.end - 2, 0)] if len(data) else 0, 0).astype(np.uint64)
    return (W.mix(last * np.uint64(257) + before) % np.uint64(BINS)).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in W.parts(batch.column(at), CHUNK):
            yield batch.slice(a, b - a)


def _count(batches):
    """Words of a task's texts with their bins and counts; several rows for a word are added up later."""
    for part in _batches(batches, 0):
        w = W.words(part.column(0), fold=True)
        word, first, n = np.unique(w.hash, return_index=True, return_counts=True)
        yield pa.record_batch({
            "word": pa.array(word.view(np.int64)), "bin": pa.array(_bins(w)[first].astype(np.int32)), "n": pa.array(n.astype(np.int64))})


@dataclass
class Model:
    """Parameters; the units' noise distribution; the frequent words by hash."""

    frequent: np.ndarray  # sorted hashes
    noise: np.ndarray
    context: np.ndarray
    target: np.ndarray
    mixing: np.ndarray
    bias: np.ndarray
    seed: int = 0
    extra: dict = field(default_factory=dict)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.target, self.mixing, self.bias)]).astype(np.float64)

    def filled(self, flat: np.ndarray) -> Model:
        parts, at = [], 0
        for x in (self.context, self.target, self.mixing, self.bias):
            parts.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Model(self.frequent, self.noise, *parts, seed=self.seed + 1, extra=self.extra)

    def units(self, w: W.Words) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.frequent, w.hash), max(0, len(self.frequent) - 1))
        known = self.frequent[at] == w.hash if len(self.frequent) else np.zeros(len(w.hash), bool)
        return np.where(known, at, END + 1 + _bins(w))

    def codes(self, w: W.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(unit before last, last unit, unit) of each token as one number, ends included; and the first token of each text."""
        first = w.first() + np.arange(n + 1)
        units = np.full(len(w.hash) + n + 2, END, np.int64)  # two ends stand before everything
        units[2 + np.arange(len(w.hash)) + w.doc] = self.units(w)
        two, one = units[:-2].copy(), units[1:-1].copy()
        two[first[:-1]] = END
        after = first[:-1] + 1
        two[after[after < len(two)]] = END  # the second token of a text, or a first token, which has it anyhow
        return (two * UNITS + one) * UNITS + units[2:], first

    def table(self) -> np.ndarray:
        """log10 p(unit | two units before), for all pairs."""
        before = self.context @ self.mixing[0], self.context @ self.mixing[1]
        out = np.empty((UNITS, UNITS, UNITS), np.float32)
        for u in range(UNITS):
            s = (before[0][u] + before[1]) @ self.target.T + self.bias
            s -= s.max(axis=1, keepdims=True)
            s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
            out[u] = s / np.log(10)
        return out.ravel()


def _scatter(to: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """Add rows to the rows of ``to`` given by ``index``."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    head = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    to[index[head]] += np.add.reduceat(rows[order], head, axis=0)


def fit(m: Model, code: np.ndarray, count: np.ndarray, squares: list[np.ndarray], rng: np.random.Generator, rate: float = 0.1) -> None:
    """One pass of noise-contrastive estimation over weighted (context, unit) numbers, with Adagrad."""
    order = rng.permutation(len(code))
    ln_noise = np.log(NOISE * m.noise).astype(np.float32)
    for a in range(0, len(order), BATCH):
        some = order[a:a + BATCH]
        weight = count[some].astype(np.float32)
        weight /= weight.sum()
        two, one, unit = code[some] // (UNITS * UNITS), code[some] // UNITS % UNITS, code[some] % UNITS
        r2, r1 = m.context[two], m.context[one]
        q = r2 @ m.mixing[0] + r1 @ m.mixing[1]
        drawn = rng.choice(UNITS, NOISE, p=m.noise)
        true = np.einsum("ij,ij->i", q, m.target[unit]) + m.bias[unit] - ln_noise[unit]
        false = q @ m.target[drawn].T + m.bias[drawn] - ln_noise[drawn]
        up = weight / (1 + np.exp(np.clip(true, -30, 30)))  # pull the true unit up
        down = weight[:, None] / (1 + np.exp(np.clip(-false, -30, 30)))  # push the noise down
        to_q = up[:, None] * m.target[unit] - down @ m.target[drawn]
        grads = [np.zeros_like(x) for x in (m.context, m.target, m.mixing, m.bias)]
        _scatter(grads[1], unit, up[:, None] * q)
        np.add.at(grads[1], drawn, -(down.T @ q))
        grads[3] += np.bincount(unit, up, UNITS).astype(np.float32)
        np.add.at(grads[3], drawn, -down.sum(axis=0))
        grads[2][0], grads[2][1] = r2.T @ to_q, r1.T @ to_q
        _scatter(grads[0], two, to_q @ m.mixing[0].T)
        _scatter(grads[0], one, to_q @ m.mixing[1].T)
        for x, g, s in zip((m.context, m.target, m.mixing, m.bias), grads, squares, strict=True):
            s += g * g
            x += rate * g / np.sqrt(s + 1e-10)


def _runs(shared):
    """Runs of a task's texts with their counts, added up over as many texts as have ``HELD`` different runs."""
    def row(code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(code), 1 << 16):
            yield pa.record_batch({"code": pa.array(code[a:a + (1 << 16)]), "n": pa.array(n[a:a + (1 << 16)])})

    def run(batches):
        m = shared.value
        code, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for part in _batches(batches, 0):
            own, times = np.unique(m.codes(W.words(part.column(0), fold=True), part.num_rows)[0], return_counts=True)
            both, where = np.unique(np.r_[code, own], return_inverse=True)
            code, n = both, np.bincount(where, np.r_[n, times]).astype(np.int64)
            if len(code) > HELD:
                yield from row(code, n)
                code, n = code[:0], n[:0]
        yield from row(code, n)
    return W.tidied(run)


def _train(shared):
    def run(table: pa.Table) -> pa.Table:
        start = shared.value
        m = start.filled(start.flat())
        squares = [np.full(x.shape, 1e-6, np.float32) for x in (m.context, m.target, m.mixing, m.bias)]
        table = table.sort_by("code")
        code, count, task = table["code"].to_numpy(), table["n"].to_numpy(), table["task"][0].as_py()
        # a frequent run is met several times, so that no batch is about one run, and a task has its steps
        times = np.ceil(count * (STEPS * BATCH / count.sum())).astype(np.int64)
        fit(m, np.repeat(code, times), np.repeat(count / times, times), squares, np.random.default_rng([start.seed, task]))
        return pa.table({"task": pa.array([task], pa.int32()), "seen": pa.array([int(count.sum())], pa.int64()),
                         "parameters": pa.array([m.flat().tobytes()], pa.binary())})
    return W.tidied(run)


def _score(shared):
    def run(batches):
        m = shared.value
        table, known, counts = m.table(), m.extra["words"], m.extra["counts"]
        share = m.extra["share"]  # log10 of what a bin's counts are divided by; none for a word that is a unit
        end = np.log10(m.extra["end"] + 0.5)
        for part in _batches(batches, 1):
            n = part.num_rows
            w = W.words(part.column(1), fold=True)
            code, first = m.codes(w, n)
            unit = m.units(w)
            word, back = np.unique(w.hash, return_inverse=True)
            at = np.minimum(np.searchsorted(known, word), max(0, len(known) - 1))
            head = (known[at] == word if len(known) else np.zeros(len(word), bool))[back]
            c = np.where(head, counts[at][back] if len(known) else 0, 0)
            binned = unit > END
            base = np.where(head, np.log10(c + 0.5), 0.0)
            inside = np.where(binned, base - share[np.maximum(unit - END - 1, 0)], 0.0)
            sums = np.r_[0.0, np.cumsum(table[code], dtype=np.float64)]
            add = lambda v, w=w, n=n: np.bincount(w.doc, v, minlength=n)
            rare = np.flatnonzero(~head)  # never frequent words, so all of them are in bins
            bounds = np.searchsorted(w.doc[rare], np.arange(n + 1))
            yield pa.record_batch({
                "row": part.column(0), "n_tokens": pa.array(np.diff(first).astype(np.int64)),
                "n_known": pa.array(add(head).astype(np.int64) + int(m.extra["end"] > 0)),
                "logs": pa.array(add(base) + end),
                "score": pa.array(sums[first[1:]] - sums[first[:-1]] + add(inside)),
                "rare": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(w.hash[rare].view(np.int64))),
            })
    return W.tidied(run)


def language_model(docs: DataFrame, id: str = "doc_id", text: str = "text", rounds: int = 2, head: int = HEAD) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row; see the module's text."""
    spark = docs.sparkSession
    own = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(
        F.crc32(F.col(id).cast("string")) % 5 == 1, F.lit(False)).alias("held_out"))
    train = own.where(~F.col("held_out")).select("text")
    counts = materialise(train.mapInArrow(W.tidied(_count), "word long, bin int, n long").groupBy("word").agg(
        F.sum("n").alias("n"), F.first("bin").alias("bin")), "words")
    ends = train.count()
    n, different = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    train_tokens, different = n + ends, different + (ends > 0)

    # the most frequent words; then all counts from the least count that keeps the head within its bound
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    frequent = np.sort(top["word"].to_numpy().view(np.uint64))
    spectrum = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toArrow()
    upto = np.cumsum(spectrum["words"].to_numpy())
    fits = np.flatnonzero(upto <= head)
    least = int(spectrum["n"][int(fits[-1])].as_py()) if len(fits) else (1 << 62)
    known = counts.where(F.col("n") >= least).select("word", "n").unionByName(
        counts.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word", "n")).distinct().toArrow()
    words = known["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    names = [int(x) for x in frequent.view(np.int64)]
    bins = counts.where(~F.col("word").isin(names)) if names else counts
    bins = bins.groupBy("bin").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toArrow()
    in_bin, size = np.zeros(BINS), np.zeros(BINS)
    in_bin[bins["bin"].to_numpy()] = bins["n"].to_numpy()
    size[bins["bin"].to_numpy()] = bins["words"].to_numpy()

    mass = np.full(UNITS, 0.5)
    mass[:len(frequent)] += top["n"].to_numpy()[np.argsort(top["word"].to_numpy().view(np.uint64))]
    mass[END] += ends
    mass[END + 1:] += in_bin
    noise = mass / mass.sum()
    rng = np.random.default_rng(1)
    draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    model = Model(frequent, noise, draw(UNITS, DIM), draw(UNITS, DIM),
                  np.stack([np.eye(DIM, dtype=np.float32) * 0.5] * 2), np.log(noise).astype(np.float32))
    runs = materialise(  # tasks have added up their runs, so the exchange comes before any further sum
        train.mapInArrow(_runs(spark.sparkContext.broadcast(model)), "code long, n long").repartition("code").groupBy("code").agg(F.sum("n").alias("n"))
        .withColumn("task", F.pmod(F.xxhash64("code"), F.lit(TASKS)).cast("int")), "runs")
    for _ in range(rounds):
        trained = runs.repartition(4 * TASKS, "task").groupBy("task").applyInArrow(
            _train(spark.sparkContext.broadcast(model)), "task int, seen long, parameters binary").collect()  # TASKS rows of fixed size
        if trained:
            trained.sort(key=lambda r: r["task"])
            model = model.filled(sum(np.frombuffer(r["parameters"]) * r["seen"] for r in trained) / sum(r["seen"] for r in trained))
    release(runs)

    share = np.log10(in_bin + 0.5 * (size + 1))
    model.extra = {"words": words[order], "counts": known["n"].to_numpy()[order], "share": share, "end": ends}
    scored = materialise(
        own.withColumn("row", F.struct(F.monotonically_increasing_id().alias("key"), "doc_id", "held_out")).select("row", "text")
        .mapInArrow(_score(spark.sparkContext.broadcast(model)),
                    "row struct<key:long,doc_id:long,held_out:boolean>, n_tokens long, n_known long, logs double, "
                    "score double, rare array<long>"), "scored")
    tail = counts.where(F.col("n") < least).select("word", "n")
    rare = (
        scored.select("row.key", F.explode("rare").alias("word")).groupBy("key", "word").agg(F.count("*").alias("times"))
        .join(tail, "word", "left")
        .groupBy("key").agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more_logs"))
    )
    each = float(np.log10(train_tokens + 0.5 * (different + 1)))
    more = F.coalesce("more_logs", F.lit(0.0))
    return scored.withColumn("key", F.col("row.key")).join(rare, "key", "left").select(
        "row.doc_id", "row.held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * each).alias("base_score"), (F.col("score") + more).alias("score"))
