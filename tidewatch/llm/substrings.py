"""Exact substring dedup by fixed-block anchors.

Every document is cut into non-overlapping blocks of ``anchor`` words, with 2 * anchor - 1 <= width: a repeat of
``width`` words always holds a whole block of either document.

1. Index and probe. Block hashes are the index, every rolling window of ``anchor`` words probes it. Both are sent,
   once per chunk of texts, as sorted fingerprints to the partition that owns their part of the hash space. A block that another
   document probes is an anchor hit.
2. The hits become a bitmap (at most ``max_bits`` bits, whatever the corpus; see ``layout``), which goes back to all
   tasks. A full bitmap only costs time: it lets through windows that step 3 rejects.
3. Extend. Windows of ``width`` words around a hit are compared over all documents by their 64-bit hash. A chunk first
   settles its own repeats; only its smallest document of each window takes part in the exchange, so a passage that a
   third of all documents share costs one entry per chunk. Neighbouring windows merge into maximal repeats.
4. Words inside a repeat whose window also starts in a document with a smaller id are removed.

Defined results: a null or empty text has no words; documents with a null id are returned whole and are no
reference; rows with equal ids are one document, so they remove nothing from each other; texts shorter than
``width`` words stay; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

PART_BYTES = 16 << 20  # of text to each partition of the hash space
CHUNK_BYTES = 5 << 20  # of text that a task looks at together
MAX_BITS = 1 << 28
_LOW = np.uint64(0xFFFFFFFF)


def _owner(h: np.ndarray, parts: int) -> np.ndarray:
    """Partition of a hash, from its high 32 bits."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.Table]:
    """Batches put together or cut to about CHUNK_BYTES of text."""
    held, size = [], 0
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        offsets = W.buffers(column)[1]
        for a, b in W.parts(column, CHUNK_BYTES):
            held.append(batch.slice(a, b - a))
            size += int(offsets[b] - offsets[a])
            if size >= CHUNK_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _aligned(w: W.Words, n: int, anchor: int) -> np.ndarray:
    """Whether a window begins a block of its document."""
    place = np.arange(len(w.hash)) - np.repeat(w.first()[:-1], w.counts())
    return place[:n] % anchor == 0


def _send_anchors(parts: int, anchor: int):
    def run(batches):
        for chunk in _chunks(batches, "text"):
            w = W.words(chunk["text"])
            h, whole = W.windows(w, anchor)
            block = _aligned(w, len(h), anchor)[whole]
            doc = w.doc[:len(h)][whole].astype(np.uint64)
            h = h[whole]
            if not len(h):
                continue
            owner = _owner(h, parts)
            key = (owner.astype(np.uint64) << np.uint64(32)) | (h & _LOW & ~np.uint64(3))
            order = np.argsort(key)
            key, doc, block = key[order], doc[order], block[order]
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            several = np.maximum.reduceat(doc, head) != np.minimum.reduceat(doc, head)
            anchored = np.logical_or.reduceat(block, head)
            key = key[head] | (several.astype(np.uint64) << np.uint64(1)) | anchored.astype(np.uint64)
            cut = np.searchsorted(key, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
            low = (key & _LOW).astype(np.uint32)
            full = np.flatnonzero(np.diff(cut))
            yield pa.record_batch({
                "part": pa.array(full, pa.int64()),
                "prints": pa.array([low[cut[p]:cut[p + 1]].tobytes() for p in full], pa.binary()),
            })
    return W.tidied(run)


def _bits(low: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a bitmap part of ``size`` bits (a power of two)."""
    h = W.mix(low.astype(np.uint64) & ~np.uint64(3) & _LOW)
    mask = np.uint64(size - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _find_hits(size: int):
    def run(table: pa.Table) -> pa.Table:
        low = np.sort(np.concatenate([np.frombuffer(b.as_py(), np.uint32) for b in table["prints"]]))
        key = low >> np.uint32(2)
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        flags = np.bitwise_or.reduceat(low, head) & np.uint32(3)
        times = np.diff(head, append=len(low))
        hit = low[head][((flags & 1) == 1) & ((times > 1) | (flags >= 2))]
        bits = np.zeros(size, bool)
        for place in _bits(hit, size):
            bits[place] = True
        return pa.table({"part": table["part"][:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})
    return W.tidied(run)


def _send_windows(bitmap, parts: int, size: int, owners: int, anchor: int, width: int):
    """Candidate windows of each chunk: repeats inside it are settled, its smallest documents sent on."""
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)
        for chunk in _chunks(batches, "text"):
            w = W.words(chunk["text"])
            h, whole = W.windows(w, width)
            if not len(h):
                continue
            short, inside = W.windows(w, anchor)
            hit = inside.copy()
            low = (short & _LOW).astype(np.uint32)
            base = _owner(short, parts) * size
            for place in _bits(low, size):
                place += base
                hit &= (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
            near = np.r_[0, np.cumsum(hit)]
            span = width - anchor + 1
            pos = np.flatnonzero(whole & (near[span:span + len(h)] > near[:len(h)]))
            if not len(pos):
                continue
            ids = chunk["doc_id"].to_numpy()
            keys = chunk["text_key"].to_numpy()
            first = w.first()
            h, doc = h[pos], w.doc[pos]
            order = np.lexsort((ids[doc], h))
            h, pos, doc = h[order], pos[order], doc[order]
            head = np.r_[True, h[1:] != h[:-1]]
            smallest = ids[doc][np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))]
            settled = ids[doc] > smallest
            rows = {"part": [], "docs": [], "h": [], "at": [], "done": []}

            def put(part, h, pos, doc, done, ids=ids, keys=keys, first=first, rows=rows):
                own, doc = np.unique(doc, return_inverse=True)
                rows["part"].append(part)
                rows["docs"].append(np.stack([ids[own], keys[own]]).astype(np.int64).tobytes())
                rows["h"].append(h.tobytes())
                rows["at"].append(np.stack([doc, pos - first[own][doc]]).astype(np.int32).tobytes())
                rows["done"].append(done)

            # settled windows go by document, so every partition gets its share
            to = (W.mix((ids ^ keys).astype(np.uint64)) % np.uint64(owners)).astype(np.int64)[doc]
            done = np.flatnonzero(settled)
            done = done[np.argsort(to[done], kind="stable")]
            cut = np.searchsorted(to[done], np.arange(owners + 1))
            for q in np.flatnonzero(np.diff(cut)):
                some = done[cut[q]:cut[q + 1]]
                put(int(q), h[:0], pos[some], doc[some], True)
            h, pos, doc = h[~settled], pos[~settled], doc[~settled]
            owner = _owner(h, owners)
            cut = np.searchsorted(owner, np.arange(owners + 1))  # h is sorted, so are the owners
            for q in np.flatnonzero(np.diff(cut)):
                s = slice(cut[q], cut[q + 1])
                put(int(q), h[s], pos[s], doc[s], False)
            yield pa.record_batch({
                "part": pa.array(rows["part"], pa.int64()), "docs": pa.array(rows["docs"], pa.binary()),
                "h": pa.array(rows["h"], pa.binary()), "at": pa.array(rows["at"], pa.binary()),
                "done": pa.array(rows["done"], pa.bool_()),
            })
    return W.tidied(run)


def _runs(one: np.ndarray, key: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Sorted by document: ids, text keys and number of runs of each, and the joined runs."""
    order = np.lexsort((end, begin, key, one))
    one, key, begin, end = one[order], key[order], begin[order], end[order]
    fresh = np.r_[True, (one[1:] != one[:-1]) | (key[1:] != key[:-1])][:len(one)]
    head = np.flatnonzero(fresh | np.r_[True, begin[1:] > end[:-1]][:len(one)])
    if not len(head):
        return one, key, np.empty(0, np.int64), np.empty((0, 2), np.int32)
    runs = np.stack([begin[head], np.maximum.reduceat(end, head)], axis=1).astype(np.int32)
    docs = np.flatnonzero(fresh[head])
    return one[head[docs]], key[head[docs]], np.diff(docs, append=len(head)), runs


def _judge(groups: int):
    """Window starts to remove, as runs, in one row for each group of documents."""
    def run(table: pa.Table) -> pa.Table:
        live, gone = ([], [], [], []), ([], [], [])
        for docs, prints, places, done in zip(*(table[c].to_pylist() for c in ("docs", "h", "at", "done")), strict=True):
            docs = np.frombuffer(docs, np.int64).reshape(2, -1)
            places = np.frombuffer(places, np.int32).reshape(2, -1)
            row = (docs[0][places[0]], docs[1][places[0]], places[1], np.frombuffer(prints, np.uint64))
            for where, what in zip(gone if done else live, row, strict=False):
                where.append(what)
        if live[0]:
            one, key, place, h = (np.concatenate(x) for x in live)
            order = np.lexsort((one, h))
            one, key, place, h = one[order], key[order], place[order], h[order]
            head = np.r_[True, h[1:] != h[:-1]]
            later = one > one[np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))]
            for where, what in zip(gone, (one, key, place), strict=True):
                where.append(what[later])
        one, key, place = (np.concatenate(x) for x in gone)
        one, key, count, runs = _runs(one, key, place, place + 1)
        group = (W.mix(one.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
        first = np.cumsum(count) - count
        rows = {"group": [], "docs": [], "runs": []}
        order = np.argsort(group, kind="stable")
        cut = np.searchsorted(group[order], np.arange(groups + 1))
        for g in np.flatnonzero(np.diff(cut)):
            d = order[cut[g]:cut[g + 1]]
            n = count[d]
            at = np.repeat(first[d] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows["group"].append(int(g))
            rows["docs"].append(np.stack([one[d], key[d], n]).tobytes())
            rows["runs"].append(runs[at].tobytes())
        return pa.table({"group": pa.array(rows["group"], pa.int64()), "docs": pa.array(rows["docs"], pa.binary()),
                         "runs": pa.array(rows["runs"], pa.binary())})
    return W.tidied(run)


def _gather(table: pa.Table) -> pa.Table:
    """All runs of each document of a group."""
    docs = np.concatenate([np.frombuffer(x, np.int64).reshape(3, -1) for x in table["docs"].to_pylist()], axis=1)
    runs = np.concatenate([np.frombuffer(x, np.int32).reshape(-1, 2) for x in table["runs"].to_pylist()])
    one, key, count, runs = _runs(np.repeat(docs[0], docs[2]), np.repeat(docs[1], docs[2]), runs[:, 0], runs[:, 1])
    end = np.cumsum(count)
    return pa.table({
        "doc_id": pa.array(one, pa.int64()), "text_key": pa.array(key, pa.int64()),
        "runs": pa.array([runs[b - n:b].tobytes() for b, n in zip(end, count, strict=True)], pa.binary()),
    })


def _cut_out(width: int):
    def run(batches):
        for batch in batches:
            for a, b in W.parts(batch.column(1)):
                part = batch.slice(a, b - a)
                w = W.words(part.column(1))
                first = w.first()
                gone = np.zeros(len(w.hash), bool)
                for k, pieces in enumerate(part.column(2).to_pylist()):
                    if pieces:
                        for x, y in np.frombuffer(pieces, np.int32).reshape(-1, 2):
                            gone[first[k] + x:first[k] + y + width - 1] = True
                # kept words with one blank between them, copied as bytes
                kept = np.flatnonzero(~gone)
                length = (w.end - w.start)[kept]
                doc = w.doc[kept]
                lead = np.r_[False, doc[1:] == doc[:-1]][:len(kept)]
                size = length + lead
                out = np.full(int(size.sum()), 32, np.uint8)
                put = np.cumsum(size) - length
                at = np.repeat(w.start[kept] - np.r_[0, np.cumsum(length)[:-1]][:len(kept)], length)
                source = at + np.arange(len(at))
                target = np.repeat(put - np.r_[0, np.cumsum(length)[:-1]][:len(kept)], length) + np.arange(len(at))
                out[target] = w.data[source]
                bounds = np.r_[0, np.cumsum(np.bincount(doc, size, minlength=b - a))].astype(np.int64)
                kept_text = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(bounds.tobytes()), pa.py_buffer(out.tobytes()))
                yield pa.record_batch({
                    "doc_id": part.column(0), "n_words": pa.array(w.counts().astype(np.int64)),
                    "n_removed": pa.array(np.bincount(w.doc, gone, minlength=b - a).astype(np.int64)),
                    "kept_text": kept_text.cast(pa.string()),
                })
    return W.tidied(run)


def layout(total: int, part_bytes: int = PART_BYTES, max_bits: int = MAX_BITS) -> tuple[int, int]:
    """Partitions of the hash space for ``total`` bytes of text, and bits of the bitmap for each.

    Their product never exceeds ``max_bits``: a partition has 8 bits at least, and there are ``max_bits / 8`` partitions
    at most (33 million, so 16 MB of text each up to 500 TB; beyond that partitions grow). A chunk sends a row to each partition that
    one of its words belongs to, so no more rows than words.
    """
    parts = min(max(8, -(-total // part_bytes)), max_bits // 8)
    size = 8
    while size * 2 * parts <= max_bits and (size < 1 << 10 or size * parts < total):
        size *= 2
    return parts, size


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 13, anchor: int = 7,
            part_bytes: int = PART_BYTES, max_bits: int = MAX_BITS) -> DataFrame:
    """Runs of window starts (int32 pairs, end exclusive) to remove, for documents that have any."""
    if 2 * anchor - 1 > width:
        raise ValueError("a window must hold a whole block: 2 * anchor - 1 <= width")
    spark = docs.sparkSession
    own = docs.where(F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, size = layout(total, part_bytes, max_bits)
    hits = (
        own.select("text").mapInArrow(_send_anchors(parts, anchor), "part long, prints binary")
        .groupBy("part").applyInArrow(_find_hits(size), "part long, bits binary")
    )
    bitmap = bytearray(parts * size // 8)
    for row in hits.toLocalIterator():
        bitmap[row.part * size // 8:(row.part + 1) * size // 8] = row.bits
    shared = spark.sparkContext.broadcast(bytes(bitmap))
    return (
        own.mapInArrow(_send_windows(shared, parts, size, parts, anchor, width),
                       "part long, docs binary, h binary, at binary, done boolean")
        .groupBy("part").applyInArrow(_judge(parts), "group long, docs binary, runs binary")
        .groupBy("group").applyInArrow(_gather, "doc_id long, text_key long, runs binary")
    )


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 13, anchor: int = 7,
                   **limits) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for each row: the words that are left, joined by one blank."""
    found = repeats(docs, id, text, width, anchor, **limits)
    own = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                      F.xxhash64(text).alias("text_key"))
    return (
        own.join(found, ["doc_id", "text_key"], "left").select("doc_id", "text", "runs")
        .mapInArrow(_cut_out(width), "doc_id long, n_words long, n_removed long, kept_text string")
    )
