"""Subword encoding with the n best segmentations, and decoding.

The lattice of a text has a node between any two characters and an arc for each piece. Forward Viterbi scores of all nodes are
exact heuristics for an A-star search from the text's end backwards, so complete segmentations leave the queue in order of score.

As pieces never cross pre-tokens, forward scores are computed once for each different pre-token, many at a time. So are
backward scores, which give the gap to the second best segmentation. At most n - 1 pre-tokens of a text, those of the
smallest gaps, can differ from their best segmentation within the text's n best; only these are searched, and
their lists are merged by another best-first search. The result is exact: the n best of the whole text. Paths of the search share
their ends, so its memory grows with a pre-token's length, not with its square.

Ties go to the longest last piece, then to the order of ids. Defined results: a null or empty text has one empty segmentation of score 0; a
text with fewer than n segmentations has them all; an empty table gives an empty table; rows keep all their columns in the struct
``row``, whatever their names.
"""

from __future__ import annotations

import heapq
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pieces as P
from . import words as W
from .rows import carried


KNOWN = 50_000  # pre-tokens whose lists a task keeps
KEPT = 1_000  # characters of the longest of them


def _best(v: P.Vocabulary, chars: np.ndarray):
    """Best score, gap to the second best, and pieces of the best segmentation (flat, with counts) of each row."""
    rows, width = chars.shape
    length = (chars != 0).sum(axis=1)
    longest = min(v.longest, width)
    # arc[l][:, i]: score of the piece of l + 1 characters from i on
    kind, never = (np.int32, np.int32(-(1 << 29))) if width <= 16 else (np.int64, P.NEVER)
    arc = np.full((longest, width, rows), never)
    found = np.full((longest, width, rows), -1, np.int32)
    h = np.zeros((width, rows), np.uint64)
    columns = np.ascontiguousarray(chars.T)
    wide = columns.astype(np.uint64)
    for size in range(1, longest + 1):
        n = width - size + 1
        h = P.step(h[:n], wide[size - 1:size - 1 + n])
        inside = np.flatnonzero(columns[size - 1:size - 1 + n])
        k = v.find(h.ravel()[inside])
        inside, k = inside[k >= 0], k[k >= 0]
        found[size - 1, :n].ravel()[inside] = k
        arc[size - 1, :n].ravel()[inside] = v.score[k].astype(kind)
    missing = (found[0] < 0) & (columns != 0)
    arc[0][missing] = (v.char_bytes(columns[missing]) * v.byte_score).astype(kind)
    forward = np.full((width + 1, rows), never)
    forward[0] = 0
    back = np.zeros((width + 1, rows), np.int8 if longest < 127 else np.int32)
    for j in range(1, width + 1):
        for size in range(min(longest, j), 0, -1):  # longest piece first
            total = forward[j - size] + arc[size - 1, j - size]
            np.copyto(back[j], size, where=total > forward[j], casting="unsafe")
            np.maximum(forward[j], total, out=forward[j])
    backward = np.full((width + 1, rows), never)
    at = np.arange(rows)
    backward[length, at] = 0
    for i in range(width - 1, -1, -1):
        for size in range(1, min(longest, width - i) + 1):
            np.maximum(backward[i], arc[size - 1, i] + backward[i + size], out=backward[i])
    best = forward[length, at]
    # walk back; arcs on the best path do not count for the second best
    second = np.full(rows, never)
    steps, end = [], length.copy()
    while (alive := np.flatnonzero(end > 0)).size:
        size = back[end[alive], alive].astype(np.int64)
        begin = end[alive] - size
        arc[size - 1, begin, alive] = never
        steps.append((alive, begin, found[size - 1, begin, alive]))
        end[alive] = begin
    for size in range(1, longest + 1):
        n = width - size + 1
        total = forward[:n] + arc[size - 1, :n]
        total += backward[size:size + n]
        np.maximum(second, total.max(axis=0), out=second)
    row = np.concatenate([s[0] for s in steps]) if steps else np.empty(0, np.int64)
    begin = np.concatenate([s[1] for s in steps]) if steps else row
    piece = np.concatenate([s[2] for s in steps]) if steps else row
    order = np.lexsort((begin, row))
    row, begin, piece = row[order], begin[order], piece[order]
    # a character without a piece becomes its byte pieces
    lost = np.flatnonzero(piece < 0)
    size = np.ones(len(row), np.int64)
    size[lost] = v.char_bytes(chars[row[lost], begin[lost]])
    ids = np.repeat(np.where(piece >= 0, v.id[piece], 0), size)
    place = np.cumsum(size) - size
    for k in lost:
        ids[place[k]:place[k] + size[k]] = v.char_ids(int(chars[row[k], begin[k]]))
    best, second = best.astype(np.int64), second.astype(np.int64)
    gap = np.where(second > never // 2, best - second, -P.NEVER)
    return best, gap, ids.astype(np.int32), np.bincount(row, size, minlength=rows).astype(np.int64)


def _best_each(v: P.Vocabulary, chars: np.ndarray):
    """``_best`` for long rows, one by one."""
    found = [P.long_best(v, row[row != 0]) for row in chars]
    return (np.array([f[0] for f in found]), np.array([f[1] for f in found]), np.concatenate([np.array(f[2], np.int32) for f in found]),
            np.array([len(f[2]) for f in found]))


class _Path:
    """Pieces from a text's end back to ``at``: the last arc, and the path behind it.

    ``jump`` is a path further back, so that two paths find where they part in a logarithmic number of steps.
    """

    __slots__ = ("at", "behind", "depth", "ids", "jump", "parent")

    def __init__(self, at: int, behind: int, ids: tuple[int, ...], parent: _Path | None):
        self.at, self.behind, self.ids, self.parent = at, behind, ids, parent
        if parent is None:
            self.depth, self.jump = 0, self
        else:
            self.depth, far = parent.depth + 1, parent.jump
            self.jump = far.jump if parent.depth - far.depth == far.depth - far.jump.depth else parent

    def up(self, depth: int) -> _Path:
        """The part of the path that has ``depth`` arcs."""
        p = self
        while p.depth > depth:
            p = p.jump if p.jump.depth >= depth else p.parent
        return p

    def __lt__(self, other: _Path) -> bool:
        """Longest last piece first; where the paths part their arcs end at one place and begin at different ones."""
        depth = min(self.depth, other.depth)
        a, b = self.up(depth), other.up(depth)
        if a is b:
            return self.depth < other.depth
        while a.parent is not b.parent:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.parent, b.parent)
        return a.at < b.at

    def all_ids(self) -> list[int]:
        out, p = [], self
        while p.parent is not None:
            out += p.ids
            p = p.parent
        return out


def n_best(v: P.Vocabulary, chars: list[int], n: int) -> list[tuple[int, list[int]]]:
    """The n best segmentations of a string: scores and ids. Forward Viterbi, then A-star from the end."""
    size = len(chars)
    text = "".join(chr(c) if c < P.LITERAL else "\0" for c in chars)  # no piece has a zero character

    def arcs(j):
        """Pieces that end at ``j``: where they start, their score and ids."""
        for i in range(max(0, j - v.longest), j):
            k = v.number.get(text[i:j])
            if k is not None:
                yield i, int(v.score[k]), (int(v.id[k]),)
            elif i == j - 1:
                ids = tuple(v.char_ids(chars[i]))
                yield i, len(ids) * int(v.byte_score), ids

    forward = [0] + [None] * size
    for j in range(1, size + 1):
        forward[j] = max(forward[i] + s for i, s, _ in arcs(j))
    # (-(score so far + forward score), path) by rising order, so ties are the same every time. None of the paths holds another, and
    # each leads to a segmentation in this order, so those beyond the number still wanted are never needed
    queue = [(-forward[size], _Path(size, 0, (), None))]
    out = []
    while queue and len(out) < n:
        bound, path = queue.pop(0)
        if path.at == 0:
            out.append((-bound, path.all_ids()))
            continue
        wanted = n - len(out)
        for i, s, own in arcs(path.at):
            loss = -(path.behind + s + forward[i])
            if len(queue) < wanted or loss <= queue[-1][0]:
                insort(queue, (loss, _Path(i, path.behind + s, own, path)))
                del queue[wanted:]
    return out


def _merge(lists: list[list[int]], n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The n smallest sums of one loss from each list (rising, from 0): sums and choices, best first."""
    start = (0,) * len(lists)
    queue, seen, out = [(0, start)], {start}, []
    while queue and len(out) < n:
        loss, choice = heapq.heappop(queue)
        out.append((loss, choice))
        for k, c in enumerate(choice):
            if c + 1 < len(lists[k]):
                more = (*choice[:k], c + 1, *choice[k + 1:])
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(queue, (loss - lists[k][c] + lists[k][c + 1], more))
    return out


RESULT = [
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("score", T.DoubleType()),
    T.StructField("others", T.ArrayType(T.StructType([
        T.StructField("score", T.DoubleType()), T.StructField("n_pieces", T.LongType()),
        T.StructField("changes", T.ArrayType(T.StructType([
            T.StructField("pretoken", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))),
    ]))),
]


def _bytes_of(v: P.Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each piece by id, filled up with 0, and their number."""
    table = np.zeros((max(v.text) + 1, max(map(len, v.text.values()))), np.uint8)
    size = np.zeros(len(table), np.int64)
    for i, b in v.text.items():
        table[i, :len(b)] = np.frombuffer(b, np.uint8)
        size[i] = len(b)
    return table, size


def _decoded(ids: np.ndarray, bounds: np.ndarray, pieces: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each with the blank put before it, and where each begins."""
    table, size = pieces
    out = np.empty(int(size[ids].sum()), np.uint8)
    ends = np.r_[0, np.cumsum(size[ids])]
    for a in range(0, len(ids), 1 << 18):
        some = ids[a:a + (1 << 18)]
        inside = np.arange(table.shape[1]) < size[some][:, None]
        out[ends[a]:ends[a + len(some)]] = table[some][inside]
    return out, ends[bounds]


def _encode(shared, n: int, verify: bool):
    known: dict[bytes, list] = {}  # lists of the task's pre-tokens so far

    def run(batches):
        v = shared.value
        pieces = _bytes_of(v) if verify else None
        for batch in batches:
            for a, b in W.parts(batch.column(1), P.PARTS):
                yield one(v, pieces, batch.slice(a, b - a))

    def one(v: P.Vocabulary, pieces, part: pa.RecordBatch) -> pa.RecordBatch:
        t = P.tokens(part.column(1))
        kinds = len(t.first) - 1
        score, gap, size = (np.zeros(kinds, np.int64) for _ in range(3))
        flat, at = [], np.zeros(kinds, np.int64)
        done = 0
        for rows, chars in P.by_length(t):
            score[rows], gap[rows], ids, size[rows] = (_best if chars.shape[1] <= P.LONG else _best_each)(v, chars)
            at[rows] = done + np.cumsum(size[rows]) - size[rows]
            flat.append(ids)
            done += len(ids)
        flat = np.concatenate(flat) if flat else np.empty(0, np.int32)
        take = size[t.number]
        ids = flat[np.repeat(at[t.number] - (np.cumsum(take) - take), take) + np.arange(take.sum())]
        bounds = np.r_[0, np.cumsum(take)]
        sums = np.r_[0, np.cumsum(score[t.number])]
        if len(known) > KNOWN:
            known.clear()

        def alternatives(kind: int) -> list:
            chars = t.chars[t.first[kind]:t.first[kind + 1]]
            name = chars.tobytes()
            if name in known:
                return known[name]
            found = n_best(v, chars.tolist(), n)
            if len(chars) <= KEPT:
                known[name] = found
            return found

        others = []
        gaps = gap[t.number]
        for x, y in zip(t.doc_first[:-1], t.doc_first[1:], strict=True):
            mine = gaps[x:y]
            near = np.arange(y - x)
            if len(near) > n - 1:  # the smallest gaps, equal ones by place
                edge = np.partition(mine, n - 2)[n - 2] if n > 1 else -1
                near = np.r_[np.flatnonzero(mine < edge), np.flatnonzero(mine == edge)][:n - 1]
            near = near[mine[near] < -P.NEVER]
            lists = [alternatives(int(t.number[x + k])) for k in near]
            best, count = int(sums[y] - sums[x]), int(bounds[y] - bounds[x])
            mine = []
            for loss, choice in _merge([[p[0][0] - s for s, _ in p] for p in lists], n)[1:]:
                changed = [(int(k), p[c][1], len(p[0][1])) for k, p, c in zip(near, lists, choice, strict=True) if c]
                mine.append({
                    "score": (best - loss) / P.UNIT, "n_pieces": count + sum(len(i) - m for _, i, m in changed),
                    "changes": sorted(({"pretoken": k, "ids": i} for k, i, _ in changed), key=lambda c: c["pretoken"]),
                })
            others.append(mine)
        kind = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("changes", pa.list_(
            pa.struct([("pretoken", pa.int64()), ("ids", pa.list_(pa.int32()))])))]))
        checked = {}
        if verify:
            data, offsets = W.buffers(part.column(1))
            back, starts = _decoded(ids, bounds[t.doc_first], pieces)
            checked["round_trip"] = pa.array([
                np.array_equal(back[x + (x < y):y], data[p:q])
                for x, y, p, q in zip(starts[:-1], starts[1:], offsets[:-1], offsets[1:], strict=True)])
        return pa.RecordBatch.from_pydict({
            "row": part.column(0),
            "ids": pa.ListArray.from_arrays(pa.array(bounds[t.doc_first].astype(np.int32)), pa.array(ids)),
            "score": pa.array((sums[t.doc_first[1:]] - sums[t.doc_first[:-1]]) / P.UNIT), "others": pa.array(others, kind),
        } | checked)
    return W.tidied(run)


def encode(docs: DataFrame, vocabulary: str, n: int = 4, text: str = "text", scores: str = "rank", verify: bool = False,
           columns: list[str] | None = None) -> DataFrame:
    """Each row as struct ``row`` with the best ``ids``, their ``score``, and the ``others`` of the n best segmentations.

    Another segmentation is given by its pre-tokens that differ from the best one. With ``verify`` the ids are decoded again
    and ``round_trip`` says whether that gives the text. ``columns`` limits what ``row`` carries.
    """
    shared = docs.sparkSession.sparkContext.broadcast(P.Vocabulary(vocabulary, scores))
    row, field = carried(docs, columns)
    schema = T.StructType([field, *RESULT, *([T.StructField("round_trip", T.BooleanType())] if verify else [])])
    return docs.select(row, F.col(text).alias("text")).mapInArrow(_encode(shared, n, verify), schema)


def _decode(shared):
    def run(batches):
        pieces = _bytes_of(shared.value)
        for batch in batches:
            column = batch.column(1)
            column = column.fill_null([]) if column.null_count else column
            bounds = column.offsets.to_numpy()
            data, starts = _decoded(column.values.to_numpy()[bounds[0]:bounds[-1]], bounds - bounds[0], pieces)
            data = data.tobytes()
            texts = [data[x + (x < y):y].decode("utf-8", "replace") for x, y in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"row": batch.column(0), "decoded": pa.array(texts, pa.string())})
    return W.tidied(run)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", scores: str = "rank") -> DataFrame:
    """Each row without its ids as struct ``row``, and ``decoded``, the text of the ids without the blank put before it."""
    shared = rows.sparkSession.sparkContext.broadcast(P.Vocabulary(vocabulary, scores))
    row, field = carried(rows, [c for c in rows.columns if c != ids])
    schema = T.StructType([field, T.StructField("decoded", T.StringType())])
    return rows.select(row, F.col(ids).alias("ids")).mapInArrow(_decode(shared), schema)
