"""Benchmark decontamination with suffix arrays over shards of the training texts.

Each task turns its texts into shards of a megabyte. A shard's suffix array lists its word positions in the order
of the words that follow, sorted as deep as a window is long; texts are parted by a sentinel, so no match crosses them. Every
suffix of every benchmark item is looked up by binary search, all of them at once; the range found holds
all places of the match in the shard. From each place found, the longest verbatim match is read off the items' own suffixes in full
order: the place's rank among them is found by binary search, and its neighbours there share the most words with it.

The benchmark is the query set: it is taken in blocks of at most ``block_words`` words, one after the other over all
documents, so what is sent to the tasks has a fixed bound. No document leaves its task; nothing is shuffled.

Defined results: null and empty texts have no words, so no hits; an item without words matches nothing; items with
equal ids count once, items with a null id count under the empty id; an empty benchmark hits nothing; an
empty table gives an empty table. Rows keep all their columns in the struct ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .rows import carried

SHARD_BYTES = 1 << 20
BLOCK_WORDS = 500_000  # of the benchmark, sent to every task at a time (at most some 150 MB)

FOUND = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("longest", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
]


_POWER = 0x9E3779B97F4A7C15
_INVERSE = pow(_POWER, -1, 1 << 64)
EXTENDED = 1 << 16  # places extended at a time


class Hashed:
    """Words with the hash of any run of them: equal runs have equal hashes, wherever they lie. ``rest`` is the text's words from there on."""

    def __init__(self, hash: np.ndarray, rest: np.ndarray):
        n = len(hash)
        self.word, self.rest = hash, rest
        self.sum = np.r_[np.uint64(0), np.cumsum(hash * np.cumprod(np.r_[np.uint64(1), np.full(n, _POWER, np.uint64)])[:n], dtype=np.uint64)]
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(n, _INVERSE, np.uint64)])

    def run(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sum[at + length] - self.sum[at]) * self.back[at]


def shared_words(a: Hashed, p: np.ndarray, b: Hashed, q: np.ndarray) -> np.ndarray:
    """How many words from ``p`` on equal those from ``q`` on."""
    low, high = np.zeros(len(p), np.int64), np.minimum(a.rest[p], b.rest[q])
    while (low < high).any():
        middle = (low + high + 1) >> 1
        same = a.run(p, middle) == b.run(q, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


class Suffixes(Hashed):
    """The suffixes of some texts in full order, by the hashes of their words; a text's end is below every word."""

    def __init__(self, hash: np.ndarray, rest: np.ndarray):
        super().__init__(hash, rest)
        n, step, deepest = len(hash), 1, int(rest.max(initial=0))
        rank = np.unique(hash, return_inverse=True)[1].ravel().astype(np.uint64) + np.uint64(1)
        while step < deepest:  # ranks of twice as many words
            after = np.where(rest > step, rank[np.minimum(np.arange(n) + step, n - 1)], np.uint64(0))
            distinct, rank = np.unique((rank << np.uint64(32)) | after, return_inverse=True)
            rank = rank.ravel().astype(np.uint64) + np.uint64(1)
            if len(distinct) == n:
                break
            step *= 2
        self.order = np.argsort(rank, kind="stable")

    def longest(self, text: Hashed, places: np.ndarray) -> np.ndarray:
        """The most words from each place on that one of the texts holds in a row."""
        best = np.zeros(len(places), np.int64)
        for a in range(0, len(places), EXTENDED):
            p = places[a:a + EXTENDED]
            low, high = np.zeros(len(p), np.int64), np.full(len(p), len(self.order), np.int64)
            while (open_ := np.flatnonzero(low < high)).size:
                middle, at = (low[open_] + high[open_]) >> 1, p[open_]
                q = self.order[middle]
                same = shared_words(text, at, self, q)
                best[a + open_] = np.maximum(best[a + open_], same)
                ends, stops = same == self.rest[q], same == text.rest[at]
                i, j = np.where(ends, q, q + same), np.where(stops, at, at + same)
                below = ends | (~stops & (self.word[i] < text.word[j]))
                low[open_[below]] = middle[below] + 1
                high[open_[~below]] = middle[~below]
        return best


class Queries:
    """All suffixes of a block of items, cut to ``width`` words, one for each item and different window; and uncut, in order."""

    def __init__(self, ids: list[str], texts: list[str], width: int):
        w = W.words(pa.array(texts, pa.string()), W.NOT_ALNUM, fold=True)
        first, count = w.first(), w.counts()
        start = np.concatenate([np.arange(a, a + max(1, n - width + 1)) for a, n in zip(first, count, strict=False) if n]
                               or [np.empty(0, np.int64)]).astype(np.int64)
        item = w.doc[start] if len(start) else np.empty(0, np.int32)
        self.length = np.minimum(width, count[item]).astype(np.int64)
        padded = np.r_[w.hash, np.zeros(width, np.uint64)]
        self.words = padded[start[:, None] + np.arange(width)]
        self.words[np.arange(width) >= self.length[:, None]] = 0
        self.item = item
        self.suffixes = Suffixes(w.hash, first[1:][w.doc] - np.arange(len(w.hash)))
        _, keep = np.unique(np.column_stack([self.words, item.astype(np.uint64)]), axis=0, return_index=True)
        for name in ("length", "words", "item"):
            setattr(self, name, getattr(self, name)[keep])
        # equal windows of several items are searched once
        self.distinct, self.of = np.unique(self.words, axis=0, return_inverse=True)
        self.of = self.of.ravel()
        order = np.argsort(self.of, kind="stable")
        self.by_window, self.window_first = order, np.searchsorted(self.of[order], np.arange(len(self.distinct) + 1))
        self.window_length = (self.distinct != 0).sum(axis=1)
        self.symbols = _symbols(self.distinct)
        self.ids = ids


def _symbols(hashes: np.ndarray) -> np.ndarray:
    """32-bit symbols of word hashes; 0 is the sentinel."""
    return np.where(hashes == 0, 0, (hashes >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)


def suffix_array(symbols: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the symbols from there on, ``depth`` of them at least, up to a sentinel (0).

    Two symbols are sorted at a time, and only suffixes that are still equal are looked at again. ``symbols`` ends with
    ``depth + 1`` sentinels.
    """
    def pair(at):
        return (symbols[at].astype(np.uint64) << np.uint64(32)) | symbols[at + 1]

    key = pair(places)
    order = np.argsort(key)
    key, out = key[order], places[order]
    slots = None  # slots of ``out`` whose suffixes are still tied, and the group of each
    for k in range(2, depth, 2):
        tied = np.r_[False, key[1:] == key[:-1]]
        if slots is not None:
            tied &= np.r_[False, group[1:] == group[:-1]]  # noqa: F821
        member = tied | np.r_[tied[1:], False]
        member &= ((key & np.uint64(0xFFFFFFFF)) != 0) & ((key >> np.uint64(32)) != 0)  # the text goes on
        if not member.any():
            break
        group = np.cumsum(~tied)[member]  # noqa: F841
        slots = np.flatnonzero(member) if slots is None else slots[member]
        at = out[slots]
        key = pair(at + k)
        order = np.lexsort((key, group))
        key, out[slots] = key[order], at[order]
    return out


def _bound(symbols: np.ndarray, order: np.ndarray, q: Queries, upper: bool) -> np.ndarray:
    """First rank whose suffix is not below (``upper``: is above) each window."""
    lo = np.zeros(len(q.symbols), np.int64)
    hi = np.full(len(q.symbols), len(order), np.int64)
    inside = np.arange(q.symbols.shape[1]) < q.window_length[:, None]
    steps = np.arange(q.symbols.shape[1])
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        have = symbols[order[mid][:, None] + steps]
        differ = (have != q.symbols[open_]) & inside[open_]
        at = differ.argmax(axis=1)
        rows = np.arange(len(open_))
        some = differ[rows, at]
        below = np.where(some, have[rows, at] < q.symbols[open_][rows, at], upper)
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
    return lo


def find(w: W.Words, q: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Window number and word number of every place where a window occurs."""
    if not len(w.hash) or not len(q.distinct):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    width = q.symbols.shape[1]
    places = np.arange(len(w.hash)) + w.doc  # one sentinel after each text
    symbols = np.zeros(places[-1] + width + 4, np.uint32)
    symbols[places] = _symbols(w.hash)
    order = suffix_array(symbols, places, width)
    lo, hi = _bound(symbols, order, q, False), _bound(symbols, order, q, True)
    count = hi - lo
    window = np.repeat(np.arange(len(lo)), count)
    rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    number = np.full(len(symbols), -1, np.int64)
    number[places] = np.arange(len(places))
    word = number[order[rank]]
    # symbols have 32 bits; the whole hashes decide
    padded = np.r_[w.hash, np.zeros(width, np.uint64)]
    same = np.ones(len(word), bool)
    for j in range(width):
        wanted = q.distinct[window, j]
        same &= (wanted == 0) | (padded[word + j] == wanted)
    return window[same], word[same]


def _search(shared, width: int, has_text: bool, previous: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            for a, b in W.parts(batch.column(1), SHARD_BYTES):
                yield one(q, batch.slice(a, b - a))

    def one(q: Queries, part: pa.RecordBatch) -> pa.RecordBatch:
        w = W.words(part.column(1), W.NOT_ALNUM, fold=True)
        window, word = find(w, q)
        n, first = part.num_rows, w.first()
        edge = np.zeros(len(w.hash) + 1, np.int64)
        np.add.at(edge, word, 1)
        np.add.at(edge, word + q.window_length[window], -1)
        hit = np.cumsum(edge[:-1]) > 0
        # longest matches: short items match whole, windows are extended
        longest = np.zeros(n, np.int64)
        short = q.window_length[window] < width
        np.maximum.at(longest, w.doc[word[short]], q.window_length[window[short]])
        if not short.all():
            places = np.unique(word[~short])
            text = Hashed(w.hash, first[1:][w.doc] - np.arange(len(w.hash)))
            np.maximum.at(longest, w.doc[places], q.suffixes.longest(text, places))
        # (text, item) pairs
        doc, window = np.divmod(np.unique(w.doc[word].astype(np.int64) * max(1, len(q.distinct)) + window), max(1, len(q.distinct)))
        count = (q.window_first[1:] - q.window_first[:-1])[window]
        entry = q.by_window[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                            + np.repeat(q.window_first[window], count)]
        doc, item = np.repeat(doc, count), q.item[entry]
        items: list[set[str]] = [set() for _ in range(n)]
        pairs = np.unique(doc.astype(np.int64) * len(q.ids) + item) if len(q.ids) else np.empty(0, np.int64)
        for d, i in zip(pairs // max(1, len(q.ids)), pairs % max(1, len(q.ids)), strict=True):
            items[d].add(q.ids[i])
        if previous:
            longest = np.maximum(longest, part.column("longest").to_numpy())
            for k, (runs, old) in enumerate(zip(part.column("runs").to_pylist(), part.column("items").to_pylist(), strict=True)):
                items[k].update(old)
                for r in runs:
                    hit[first[k] + r["start"]:first[k] + r["end"]] = True
        runs: list[list[dict]] = [[] for _ in range(n)]
        before = np.r_[False, hit[:-1] & (w.doc[1:] == w.doc[:-1])] if len(hit) else hit
        after = np.r_[hit[1:] & (w.doc[1:] == w.doc[:-1]), False] if len(hit) else hit
        for x, y in zip(np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1, strict=True):
            d = w.doc[x]
            runs[d].append({"start": int(x - first[d]), "end": int(y - first[d])})
        columns = {"row": part.column(0)} | ({"text": part.column(1)} if has_text else {})
        return pa.RecordBatch.from_pydict(columns | {
            "n_words": pa.array(w.counts().astype(np.int64)),
            "n_hit": pa.array(np.bincount(w.doc, hit, minlength=n).astype(np.int64)), "longest": pa.array(longest),
            "runs": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        })
    return W.tidied(run)


def _blocks(benchmark: DataFrame, id: str, text: str, width: int, block_words: int) -> Iterator[Queries]:
    ids: list[str] = []
    texts: list[str] = []
    held, found = 0, False
    rows = benchmark.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("i"),
                            F.coalesce(F.col(text), F.lit("")).alias("t"))
    for row in rows.toLocalIterator():
        if texts and held + len(row.t) // 2 > block_words:
            yield Queries(ids, texts, width)
            ids, texts, held, found = [], [], 0, True
        ids.append(row.i)
        texts.append(row.t)
        held += len(row.t) // 2 + 1
    if texts or not found:
        yield Queries(ids, texts, width)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str | Column = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = 13, block_words: int = BLOCK_WORDS,
                  columns: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` (or its ``columns``) as struct ``row``, with ``n_words, n_hit, longest, runs, items``.

    ``runs`` are the hit words (end exclusive), ``longest`` is the longest verbatim match with one item (0 without a window).
    """
    sc = docs.sparkSession.sparkContext
    struct, row = carried(docs, columns)
    out = docs.select(struct, F.col(text).alias("text") if isinstance(text, str) else text.alias("text"))
    blocks = _blocks(benchmark, item_id, item_text, width, block_words)  # two of them at a time are in the driver
    q, previous = next(blocks), False
    while q is not None:
        after = next(blocks, None)
        schema = T.StructType([row, *([] if after is None else [T.StructField("text", T.StringType())]), *FOUND])
        out = out.mapInArrow(_search(sc.broadcast(q), width, after is not None, previous), schema)
        q, previous = after, True
    return out


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
