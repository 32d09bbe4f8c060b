"""Quality rules: line and word repetition, symbols, and bands of character n-gram perplexity for each language.

The language model is a modified Kneser-Ney model of order 5 over characters: code points of any script, with A-Z folded,
white space as blanks and digits as zeros, as numbers and line breaks say little of a text's language.
Spark counts the 5-grams of all documents and derives from them, by grouping and joins, the continuation counts, the discounts of each
order and the interpolated probabilities; no count passes through the driver. For scoring the 5-grams are 64-bit hashes:
up to ``GRAMS`` of them are sent to every task as a sorted array with their probabilities; a larger model stays a
table, and the 5-grams of the documents are joined with it.

A language's band reaches from its median log-perplexity ``spread`` times the median deviation (or ``floor``) down and up,
over the documents that pass the base rules. The deviations of the values below and above the median are taken apart, as the
losses of a language are not even. Medians come from counts of values rounded to ``GRID``, so they
are exact on that grid, need no ordered pass over documents, and do not depend on the partitioning.

Defined results: white space stands before and behind a text; a null or empty text has no words and fails; a null language is
a language of its own; a 5-gram that the model has not seen has the probability that its lower orders give, a character never
seen that of one more character; a language without
a document that passes the base rules has no band, and needs none; an empty table gives an empty table; rows keep all their
columns in the struct ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import materialise

from . import words as W
from .rows import carried

ORDER = 5
CLASSES = 32  # columns of ``Model.table``
GRID = 0.001
LANGUAGES = 100_000  # bands that may be broadcast (3 MB)
GRAMS = 4_000_000  # 5-grams that may be sent to every task (48 MB)

SYMBOLS = [f"s{k}" for k in range(ORDER)]
_MULTIPLIERS = np.random.default_rng(20240301).integers(1, 2**63, ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLAIN = np.arange(128, dtype=np.uint32)  # A-Z folded, white space as blank, digits as 0
_PLAIN[65:91] += 32
_PLAIN[48:58] = 48
_PLAIN[W.SPACE[:128]] = 32
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _grams(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters of the texts with blanks around; hash of the 5-gram at each place that starts one, these places, their texts."""
    texts = [(t or b"").decode("utf-8", "replace") for t in part.column("text").cast(pa.binary()).to_pylist()]
    chars = np.frombuffer("".join(f"    {t} " for t in texts).encode("utf-32-le"), np.uint32)
    chars = np.where(chars < 128, _PLAIN[np.minimum(chars, 127)], chars)
    length = np.fromiter(map(len, texts), np.int64, len(texts)) + 1  # the blank behind a text counts
    doc = np.repeat(np.arange(len(texts)), length)
    at = np.arange(len(doc)) + (ORDER - 1) * doc
    wide = chars.astype(np.uint64) + np.uint64(1)
    n = max(0, len(chars) - ORDER + 1)
    every = np.zeros(n, np.uint64)  # also at the few places where a text's blanks follow
    for k, m in enumerate(_MULTIPLIERS):
        every += wide[k:k + n] * m
    return chars, W.mix(every[at] + np.repeat(part.column("key").to_numpy().view(np.uint64), length)), at, doc


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, unordered, and which of them each value is; by hashing, as the values are too many to sort."""
    found = pa.array(values).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def _places(group: np.ndarray, n: int) -> np.ndarray:
    """A place of each of ``n`` distinct values."""
    at = np.empty(n, np.int64)
    at[group] = np.arange(len(group))
    return at


def _parts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in W.parts(batch.column(at), 1 << 20):
            yield batch.slice(a, b - a)


def _count(batches):
    """Counts of the 5-grams of a task's texts, each about once."""
    held, size = [], 0

    def merged():
        whole = [np.concatenate(c) for c in zip(*held, strict=True)]
        code, group = _distinct(whole[0])
        place = _places(group, len(code))
        return code, *(c[place] for c in whole[1:-1]), np.bincount(group, whole[-1]).astype(np.int64)

    def rows(columns):
        for a in range(0, len(columns[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 100_000]) for c in columns], ["id", "key", *SYMBOLS, "n"])

    for part in _parts(batches, 1):
        chars, code, at, doc = _grams(part)
        code, group = _distinct(code)
        place = _places(group, len(code))
        key = part.column("key").to_numpy()[doc[place]]
        symbols = (chars[at[place] + k].astype(np.int32) for k in range(ORDER))
        held.append((code.view(np.int64), key, *symbols, np.bincount(group, minlength=len(code))))
        size += len(code)
        if size > 1_000_000 and len(held) > 1:
            held = [merged()]
            size = len(held[0][0])
            if size > 1_000_000:
                yield from rows(held[0])
                held, size = [], 0
    if held:
        yield from rows(merged())


def _discount() -> Column:
    """Discount of the count ``c``, from the counts of counts ``n1`` to ``n4``."""
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    out = None
    for k in (3, 2, 1):
        own = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        own = F.when((F.least("n1", "n2", "n3", "n4") > 0) & (own > 0) & (own <= k), own).otherwise(F.lit(k / 2))
        out = own if out is None else F.when(F.col("c") == k, own).otherwise(out)
    return out


class Model:
    """For each order a table of discounted probabilities and a table of its contexts' weights of the lower order."""

    def __init__(self, counts: DataFrame):
        """``counts``: ``id, key, s0 ... s4, n``, each 5-gram of a model (``key``) once."""
        self.grams = counts.select("id", "key", *SYMBOLS)
        self.values, self.weights = {}, {}
        level = counts.select("key", *SYMBOLS, F.col("n").alias("c"))
        for n in range(ORDER, 0, -1):
            gram, context = ["key", *SYMBOLS[ORDER - n:]], ["key", *SYMBOLS[ORDER - n:-1]]
            of_counts = level.groupBy("key").agg(*(F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)))
            level = level.join(F.broadcast(of_counts), "key").select(*gram, "c", _discount().alias("off"))
            total = level.groupBy(*context).agg(F.sum("c").alias("total"), (F.sum("off") / F.sum("c")).alias("weight"))
            found = level.join(total, context).select(*gram, ((F.col("c") - F.col("off")) / F.col("total")).alias("value"))
            self.values[n], self.weights[n] = materialise(found, f"grams{n}"), materialise(total.drop("total"), f"contexts{n}")
            level = self.values[n].groupBy("key", *SYMBOLS[ORDER - n + 1:]).agg(F.count(F.lit(1)).alias("c"))  # how many stand before
        self.alphabet = self.values[1].groupBy("key").agg(F.count(F.lit(1)).alias("size"))

    def of(self, grams: DataFrame) -> DataFrame:
        """Adds the probability ``p`` of the last character of each 5-gram ``key, s0 ... s4`` after the others."""
        out = grams.join(F.broadcast(self.alphabet), "key", "left").withColumn(
            "p", 1 / (F.coalesce("size", F.lit(0)) + 1)).drop("size")
        for n in range(1, ORDER + 1):
            out = out.join(self.weights[n], ["key", *SYMBOLS[ORDER - n:-1]], "left").join(
                self.values[n], ["key", *SYMBOLS[ORDER - n:]], "left").withColumn(
                "p", F.coalesce("value", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("p")).drop("value", "weight")
        return out

    @cached_property
    def scores(self) -> DataFrame:
        """``id, score``: log10 of the probability of each 5-gram of the training texts."""
        return materialise(self.of(self.grams).select("id", F.log10("p").cast("float").alias("score")), "scores")

    def table(self) -> np.ndarray:
        """log10 of the probabilities after each context of four characters, a row of ``CLASSES`` columns for each.

        The last column is what no other has: characters beyond the first ``CLASSES - 1`` of a model, and those never seen.
        """
        rank = F.row_number().over(Window.partitionBy("key").orderBy(SYMBOLS[-1])) - 1
        symbols = self.values[1].select("key", SYMBOLS[-1], rank.alias("rank")).unionByName(
            self.alphabet.select("key", F.lit(-1).alias(SYMBOLS[-1]), F.lit(CLASSES - 1).alias("rank")))
        every = self.of(self.weights[ORDER].drop("weight").join(symbols, "key"))
        context = ["key", *SYMBOLS[:-1]]
        found = every.groupBy(*context, F.least("rank", F.lit(CLASSES - 1)).alias("rank")).agg(F.sum("p").alias("p")).groupBy(
            *context).agg(F.map_from_entries(F.collect_list(F.struct("rank", "p"))).alias("row"))
        rows = found.select(*(F.coalesce(F.col("row")[k], F.lit(0.0)).alias(f"p{k}") for k in range(CLASSES))).toPandas()
        with np.errstate(divide="ignore"):
            return np.log10(rows.to_numpy())


def _keyed(by: str | None) -> Column:
    return (F.xxhash64(F.col(f"`{by}`")) if by else F.lit(0).cast("long")).alias("key")


def train(docs: DataFrame, text: str = "text", by: str | None = None) -> Model:
    """The model of all texts; ``by`` names a column whose values have models of their own."""
    schema = f"id long, key long, {', '.join(f'{s} int' for s in SYMBOLS)}, n long"
    counts = docs.select(_keyed(by), F.col(f"`{text}`").alias("text")).mapInArrow(W.tidied(_count), schema).groupBy(
        "id").agg(*(F.any_value(c).alias(c) for c in ("key", *SYMBOLS)), F.sum("n").alias("n"))
    return Model(materialise(counts, "grams"))


MEASURES = {
    "n_words": T.LongType(), "word_chars": T.LongType(), "n_symbols": T.LongType(), "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(), "loss": T.DoubleType(),
}
_WANTED = {"n_symbols_scored": T.LongType(), "ids": T.ArrayType(T.LongType()), "times": T.ArrayType(T.LongType())}


def _repeated(w: W.Words, width: int = 3) -> np.ndarray:
    """Which words lie in a window of ``width`` words that its text has twice or more."""
    h, whole = W.windows(w, width)
    at = np.flatnonzero(whole)
    key = W.mix(h[at] + w.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, group = _distinct(key)
    return W.cover(at[np.bincount(group)[group] > 1], width, len(w.hash))


def _lists(values: np.ndarray, doc: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), pa.array(values))


def _loss(part: pa.RecordBatch, ids: np.ndarray, scores: np.ndarray) -> dict:
    """The mean loss of each text, from sorted hashes that hold all its 5-grams."""
    _, code, _, doc = _grams(part)
    code, group = _distinct(code)
    order = np.argsort(code)  # neighbours are looked up one after the other
    found = np.empty(len(code))
    found[order] = scores[np.searchsorted(ids, code[order])]
    score = found[group]
    length = np.bincount(doc, minlength=part.num_rows)
    return {"loss": pa.array(-np.bincount(doc, score, part.num_rows) / length)}


def _wanted(part: pa.RecordBatch) -> dict:
    """The hashes of the 5-grams of each text with their counts."""
    _, code, _, doc = _grams(part)
    code, group = _distinct(code)
    pair, times = np.unique(doc * len(code) + group, return_counts=True)
    of, group = np.divmod(pair, len(code))
    return {"n_symbols_scored": pa.array(np.bincount(doc, minlength=part.num_rows)),
            "ids": _lists(code[group].view(np.int64), of, part.num_rows), "times": _lists(times, of, part.num_rows)}


def _measure(shared):
    def run(batches):
        ids, scores = shared.value if shared else (None, None)
        for part in _parts(batches, 1):
            n = part.num_rows
            w = W.words(part.column(1))
            per_text = lambda v, w=w, n=n: np.bincount(w.doc, v, minlength=n).astype(np.int64)
            points = np.r_[0, np.cumsum((w.data & 0xC0) != 0x80)]
            symbols = np.r_[0, np.cumsum(_SYMBOLS[w.data])][w.offsets]
            lines = W.words(part.column(1), _NEWLINE)
            filled = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
            line, of = lines.hash[filled], lines.doc[filled].astype(np.int64)
            key = np.unique(np.stack([of.astype(np.uint64), line]), axis=1)[0].astype(np.int64) if len(of) else of
            yield pa.RecordBatch.from_pydict({
                "row": part.column(0), "n_words": pa.array(w.counts().astype(np.int64)),
                "word_chars": pa.array(per_text(points[w.end] - points[w.start])),
                "n_symbols": pa.array(np.diff(symbols).astype(np.int64)),
                "n_dup_lines": pa.array(np.bincount(of, minlength=n) - np.bincount(key, minlength=n)),
                "n_repeat_words": pa.array(per_text(_repeated(w))),
            } | (_loss(part, ids, scores) if shared else _wanted(part)))
    return W.tidied(run)


def _sent(scores: DataFrame):
    """The model as sorted hashes with their scores."""
    found = scores.toArrow()
    ids = found["id"].to_numpy().view(np.uint64)
    order = np.argsort(ids)
    return scores.sparkSession.sparkContext.broadcast((ids[order], found["score"].to_numpy()[order]))


def measures(docs: DataFrame, scores: DataFrame, text: str = "text", columns: list[str] | None = None, by: str | None = None) -> DataFrame:
    """Each row (or its ``columns``) as struct ``row`` with the base measures and ``loss``, the log10 perplexity for each character.

    ``scores`` has the 5-grams of all ``docs``: those of their own model, or what ``Model.of`` gives for them.
    """
    return _measured(docs, scores, _sent(scores) if scores.count() <= GRAMS else None, text, columns, by)


def _measured(docs: DataFrame, scores: DataFrame, shared, text: str, columns: list[str] | None, by: str | None = None) -> DataFrame:
    row, field = carried(docs, columns)
    own = MEASURES if shared else {k: t for k, t in MEASURES.items() if k != "loss"} | _WANTED
    schema = T.StructType([field, *(T.StructField(k, t) for k, t in own.items())])
    found = docs.select(row, F.col(f"`{text}`").alias("text"), _keyed(by)).mapInArrow(_measure(shared), schema)
    if not shared:
        found = materialise(found.withColumn("at", F.monotonically_increasing_id()), "wanted")
        sums = found.select("at", F.explode(F.arrays_zip("ids", "times")).alias("x")).select("at", "x.*").join(
            scores.withColumnRenamed("id", "ids"), "ids").groupBy("at").agg(F.sum(F.col("times") * F.col("score")).alias("total"))
        sums = materialise(sums, "sums")  # ``judge`` reads the losses twice
        found = found.drop("ids", "times").join(sums, "at").withColumn("loss", -F.col("total") / F.col("n_symbols_scored")).select("row", *MEASURES)
    return found.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _median(values: DataFrame, name: str) -> DataFrame:
    """Lower median of ``bin`` by language, from counts ``n`` of each bin."""
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    return values.select("lang", "bin", upto.alias("upto"), total.alias("total")).where("2 * upto >= total").groupBy(
        "lang").agg(F.min("bin").alias(name))


def bands(measured: DataFrame, lang: str = "lang", spread: float = 5.0, floor: float = 0.002) -> DataFrame:
    """``lang, lower, upper``: bounds of the loss, a row for each language."""
    counts = measured.where(~F.col("base_failed")).groupBy(
        F.col(f"row.{lang}").alias("lang"), F.round(F.col("loss") / GRID).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    counts = materialise(counts, "losses")  # read four times; the documents once
    limits = middle = _median(counts, "middle")
    away = counts.alias("c").join(middle.alias("m"), F.col("c.lang").eqNullSafe(F.col("m.lang"))).select(
        F.col("c.lang").alias("lang"), (F.col("bin") - F.col("middle")).alias("bin"), "n")
    for side, sign in (("lower", -1), ("upper", 1)):  # the median itself is on both sides, so each has a row
        found = _median(away.where(F.col("bin") * sign >= 0).withColumn("bin", F.abs("bin")), "away").alias("a")
        width = F.greatest(F.col("away") * GRID, F.lit(floor)) * spread
        limits = limits.alias("l").join(found, F.col("l.lang").eqNullSafe(F.col("a.lang"))).select(
            "l.*", (F.col("middle") * GRID + sign * width).alias(side))
    return limits.drop("middle")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", columns: list[str] | None = None, **band) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``; ``columns``, if given, hold the language's.

    The measures are written once, with the rows; bands and verdicts are read from what was written.
    """
    scores = train(docs, text).scores
    shared = _sent(scores) if scores.count() <= GRAMS else None
    measured = _measured(docs, scores, shared, text, columns)
    if shared:  # else their parts are written
        measured = materialise(measured, "measured")
    limits = materialise(bands(measured, lang, **band), "bands")
    limits = F.broadcast(limits) if limits.count() <= LANGUAGES else limits  # else the rows are dealt by language
    return measured.join(limits, F.col(f"row.`{lang}`").eqNullSafe(limits["lang"]), "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("loss").between(F.col("lower"), F.col("upper")), F.lit(True))
    ).drop("lang", "lower", "upper")
