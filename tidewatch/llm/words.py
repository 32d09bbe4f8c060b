"""Words of whole Arrow columns of texts, found and hashed with numpy.

A text column is one byte buffer with offsets. Words are runs of bytes that are no separator; all separators are
ASCII, so no UTF-8 sequence is cut. A null text has no words. Word hashes have 64 bits.
"""

from __future__ import annotations

import ctypes
import hashlib
import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LONGEST = 4096  # bytes of a word that the vectorised hash takes; longer words are hashed one by one
STEP = 1 << 20  # bytes hashed at a time

_rng = np.random.default_rng(20240229)
_MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(LONGEST, _BASE, dtype=np.uint64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

#: Separators of the contracts: white space; or ASCII other than digits and lower-case letters.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[0x30:0x3A] = False
NOT_ALNUM[0x61:0x7B] = False


def _give_back() -> None:
    """Return freed memory to the system; idle Python workers would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(run: Callable) -> Callable:
    """A task's function that gives its memory back when it ends."""
    if inspect.isgeneratorfunction(run):
        def tidy(batches):
            try:
                yield from run(batches)
            finally:
                _give_back()
    else:
        def tidy(table):
            out = run(table)
            _give_back()
            return out
    return tidy


@dataclass
class Words:
    """Words of ``n`` texts: byte range, text number and hash of each word, in order."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first())

    def first(self) -> np.ndarray:
        """Number of the first word of each text, and the number of all words."""
        return np.searchsorted(self.doc, np.arange(len(self.offsets)))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # of no chunk
        column = pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes; a bijection."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray, fold: bool) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    cuts = np.searchsorted(start, np.arange(0, len(data) + STEP, STEP))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a == b:
            continue
        first = start[a:b] - start[a]
        piece = data[start[a]:end[b - 1]]
        place = np.arange(len(piece), dtype=np.int32)
        place -= np.repeat(first.astype(np.int32), np.diff(first, append=len(piece)))
        values = table[piece]
        values *= _POWERS[place & (LONGEST - 1)]
        out[a:b] = np.add.reduceat(values, first)
    for k in np.flatnonzero(end - start > LONGEST):
        word = data[start[k]:end[k]]
        word = (_FOLD[word] if fold else word).tobytes()
        out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return mix(out)


def words(column: pa.Array | pa.ChunkedArray, separators: np.ndarray = SPACE, fold: bool = False) -> Words:
    """All words of a column; ``fold`` lower-cases A-Z first."""
    data, offsets = buffers(column)
    table = _MIX[_FOLD] if fold else _MIX.copy()
    is_separator = separators[_FOLD] if fold else separators
    table[is_separator] = 0
    inside = ~is_separator[data]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[begins] = False
        after[begins[begins > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = (np.searchsorted(offsets, start, side="right") - 1).astype(np.int32)
    return Words(data, offsets, start, end, doc, _hashes(data, start, end, table, fold))


def windows(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``width`` words from each word on, and whether they lie in one text."""
    n = len(w.hash) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    h = w.hash[:n].copy()
    for k in range(1, width):
        h *= _BASE
        h += w.hash[k:k + n]
    return mix(h), w.doc[:n] == w.doc[width - 1:]


def parts(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets = buffers(column)
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``width`` words that starts at one of ``starts``."""
    edge = np.zeros(n + width + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0
