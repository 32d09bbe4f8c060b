"""A subword vocabulary with unigram scores, and the different pre-tokens of texts.

Blanks become U+2581 and one is put before a text. A pre-token is a run of blanks with the run of other characters behind
it; as no piece has a blank behind another character, pieces never cross pre-tokens. A character without a piece
(and U+2581 itself, so that decoding is exact) is written as the byte pieces of its UTF-8 form.

Scores are whole numbers of 1 / UNIT nats, so that sums are exact and ties well defined. ``scores="rank"`` gives a piece the
Zipf weight of its rank, for vocabularies whose file holds merge ranks; ``"model"`` takes the file's scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from . import words as W

BLANK = 0x2581
LITERAL = 0x110000  # stands for a U+2581 of the text
ZERO = 0x110001  # stands for a U+0000 of the text, as 0 fills up rows
UNIT = 100_000
NEVER = np.int64(-(1 << 50))
PARTS = 2 << 20
LONG = 256  # characters; longer pre-tokens are segmented one by one
_SPACE_ONLY = np.zeros(256, bool)
_SPACE_ONLY[32] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by number, their scores, and tables that look up substrings by hash."""

    def __init__(self, path: str, scores: str = "rank"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = np.zeros(256, np.int32)
        plain = []
        for i in ids:
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append(i)
        self.pieces = [model.id_to_piece(i) for i in plain]
        if any(chr(BLANK) in p.lstrip(chr(BLANK)) for p in self.pieces):
            raise ValueError("a piece has a blank behind another character")
        weight = np.array([model.get_score(i) for i in plain])
        if scores == "rank":
            rank = np.empty(len(plain))
            rank[np.argsort(-weight, kind="stable")] = np.arange(len(plain))
            weight = -np.log(rank + 2.7)
            weight -= np.log(np.exp(weight).sum())
        self.score = np.round(weight * UNIT).astype(np.int64)
        self.id = np.array(plain, np.int32)
        self.byte_score = np.int64(self.score.min() - UNIT)
        self.longest = max(map(len, self.pieces))
        self.number = {p: k for k, p in enumerate(self.pieces)}
        self.text = {int(i): p.replace(chr(BLANK), " ").encode() for i, p in zip(self.id, self.pieces, strict=True)}
        self.text |= {int(i): bytes([b]) for b, i in enumerate(self.bytes)}
        h = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.hash, self.tables = h, []
        left = np.arange(len(h))
        while len(left):  # pieces whose slot is taken go to the next table; a byte of the hash turns most others away
            slot = (h[left] >> np.uint64(45)).astype(np.int64)
            table = np.full(1 << 19, -1, np.int32)
            table[slot] = left
            left, here = left[table[slot] != left], left[table[slot] == left]
            marks = np.zeros(1 << 19, np.uint8)
            marks[(h[here] >> np.uint64(45)).astype(np.int64)] = (h[here] & np.uint64(255)).astype(np.uint8) | 1
            self.tables.append((marks, table))

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = step(h, np.array([ord(c)], np.uint64))
        return h[0]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of the piece with this hash, or -1."""
        slot = (h >> np.uint64(45)).astype(np.int64)
        mark = (h & np.uint64(255)).astype(np.uint8) | np.uint8(1)
        out = np.full(len(h), -1, np.int32)
        for marks, table in self.tables:
            some = np.flatnonzero(marks[slot] == mark)
            k = table[slot[some]]
            same = self.hash[k] == h[some]
            out[some[same]] = k[same]
        return out

    def char_bytes(self, c: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of each character."""
        size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        return np.where(c == LITERAL, 3, np.where(c == ZERO, 1, size)).astype(np.int64)

    def char_ids(self, c: int) -> list[int]:
        """Byte pieces of a character."""
        return [int(self.bytes[b]) for b in chr({LITERAL: BLANK, ZERO: 0}.get(c, c)).encode()]


def step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of a string with one more character."""
    h = (h + c + np.uint64(1)) * _STEP
    return h ^ (h >> np.uint64(29))


@dataclass
class Tokens:
    """Different pre-tokens of some texts (characters of all, one after the other), and each text's pre-tokens by number."""

    chars: np.ndarray
    first: np.ndarray
    number: np.ndarray
    doc_first: np.ndarray


def tokens(column: pa.Array) -> Tokens:
    w = W.words(column, _SPACE_ONLY)
    n = len(w.offsets) - 1
    # blanks before each word, with the one put before the text; a blank end is a pre-token without a word
    before = np.r_[0, w.end[:-1]][:len(w.start)]
    head = np.r_[True, w.doc[1:] != w.doc[:-1]][:len(w.start)]
    before = np.where(head, w.offsets[w.doc], before)
    blanks = w.start - before + head
    last_end = w.offsets[:-1].copy()
    last_end[w.doc] = w.end  # the last word wins
    tail = w.offsets[1:] - last_end
    empty = np.diff(w.offsets) > 0
    has_word = np.zeros(n, bool)
    has_word[w.doc] = True
    tail = np.where(has_word, tail, np.where(empty, tail + 1, 0))
    ends = np.flatnonzero(tail)
    doc = np.r_[w.doc, ends.astype(np.int32)]
    blanks = np.r_[blanks, tail[ends]]
    start, end = np.r_[w.start, np.zeros(len(ends), np.int64)], np.r_[w.end, np.zeros(len(ends), np.int64)]
    key = W.mix(np.r_[w.hash, np.zeros(len(ends), np.uint64)] + blanks.astype(np.uint64))
    order = np.argsort(np.r_[w.start, w.offsets[1:][ends] + 0], kind="stable") if len(ends) else np.arange(len(doc))
    if len(ends):  # by text, then place; a blank end stands behind the words of its text
        order = np.lexsort((np.r_[w.start, w.offsets[1:][ends]], doc))
    doc, blanks, start, end, key = (x[order] for x in (doc, blanks, start, end, key))
    _, one, number = np.unique(key, return_index=True, return_inverse=True)
    start, end, blanks = start[one], end[one], blanks[one]
    length = end - start
    # the words' bytes, one blank behind each, decoded at once
    size = length + 1
    raw = np.full(int(size.sum()), 32, np.uint8)
    put = np.cumsum(size) - size
    k = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    raw[np.repeat(put, length) + k] = w.data[np.repeat(start, length) + k]
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    stop = np.flatnonzero(points == 32)
    begin = np.r_[0, stop[:-1] + 1][:len(stop)]
    count = stop - begin
    size = count + blanks
    first = np.r_[0, np.cumsum(size)]
    chars = np.full(int(first[-1]), BLANK, np.uint32)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    taken = points[np.repeat(begin, count) + k]
    chars[np.repeat(first[:-1] + blanks, count) + k] = np.where(taken == BLANK, LITERAL, np.where(taken == 0, ZERO, taken))
    return Tokens(chars, first, number.ravel(), np.searchsorted(doc, np.arange(n + 1)))


def by_length(t: Tokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pre-tokens of like length: their numbers, and their characters as a matrix filled up with 0."""
    length = np.diff(t.first)
    out = []
    low, width = 0, 8
    while low < (length.max(initial=0)):
        rows = np.flatnonzero((length > low) & (length <= width))
        rows_each = max(1, 60_000 // width)
        for a in range(0, len(rows), rows_each):
            some = rows[a:a + rows_each]
            place = np.arange(width)
            inside = place < length[some][:, None]
            at = np.minimum(t.first[some][:, None] + place, len(t.chars) - 1)
            out.append((some, np.where(inside, t.chars[at], 0).astype(np.uint32)))
        low, width = width, width * 2
    return out


def long_best(v: Vocabulary, chars: np.ndarray) -> tuple[int, int, list[int]]:
    """Best score, gap to the second best, and ids of one long pre-token: time and memory grow with its length.

    Its arcs are found for all places at once, size by size; the recurrences run over the arcs that exist.
    """
    n = len(chars)
    wide, h = chars.astype(np.uint64), np.zeros(n, np.uint64)
    begins, ends, kinds = [], [], []
    for size in range(1, min(v.longest, n) + 1):
        m = n - size + 1
        h = step(h[:m], wide[size - 1:])
        k = v.find(h)
        at = np.flatnonzero(k >= 0) if size > 1 else np.arange(n)
        begins.append(at)
        ends.append(at + size)
        kinds.append(k[at])
    begin, end, kind = (np.concatenate(x) for x in (begins, ends, kinds))
    gain = np.where(kind >= 0, v.score[kind], v.char_bytes(chars[begin]) * v.byte_score)
    order = np.lexsort((begin, end))  # the longest piece first, which keeps ties
    begin, end, kind, gain = begin[order], end[order], kind[order], gain[order]
    forward, last = [int(NEVER)] * (n + 1), [0] * (n + 1)
    forward[0] = 0
    for a, (i, j, g) in enumerate(zip(begin.tolist(), end.tolist(), gain.tolist(), strict=True)):
        if forward[i] + g > forward[j]:
            forward[j], last[j] = forward[i] + g, a
    order = np.lexsort((end, begin))[::-1]
    backward = [int(NEVER)] * (n + 1)
    backward[n] = 0
    for i, j, g in zip(begin[order].tolist(), end[order].tolist(), gain[order].tolist(), strict=True):
        if backward[j] + g > backward[i]:
            backward[i] = backward[j] + g
    path, at = [], n
    while at:
        path.append(last[at])
        at = int(begin[last[at]])
    ids: list[int] = []
    for a in reversed(path):
        ids += [int(v.id[kind[a]])] if kind[a] >= 0 else v.char_ids(int(chars[begin[a]]))
    total = np.array(forward)[begin] + gain + np.array(backward)[end]
    total[path] = NEVER  # arcs of the best path do not count for the second best
    second = int(total.max())
    return forward[n], forward[n] - second if second > NEVER // 2 else int(-NEVER), ids
