"""Token counts of texts by dynamic programming over a trie of pre-tokens.

The different pre-tokens of a task's texts are sorted, so that those with a common prefix stand together: the nodes
of their trie at depth d are the runs of equal prefixes of d characters. Forward scores of the unigram model are computed level by level,
once for each node, whatever number of pre-tokens shares it. A terminal node holds the number of pieces of its
pre-token's best segmentation, and a text's count is the sum over its pre-tokens. Pre-tokens of more than 256 characters are
scored one by one over the arcs that exist, in time linear in their length.

Ties go to the longest last piece. Defined results: a null or empty text has no tokens; an empty table gives an empty table;
rows keep all their columns in the struct ``row``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pieces as P
from . import words as W
from .rows import carried


def terminal_counts(v: P.Vocabulary, chars: np.ndarray) -> np.ndarray:
    """Pieces in the best segmentation of each row of ``chars`` (filled up with 0)."""
    order = np.lexsort(chars.T[::-1])
    chars = chars[order]
    rows, width = chars.shape
    length = (chars != 0).sum(axis=1)
    # depth of the common prefix with the row before
    differ = np.ones((rows, width), bool)
    differ[1:] = chars[1:] != chars[:-1]
    fresh = np.logical_or.accumulate(differ, axis=1)  # a node of depth d + 1 begins at this row
    node = [np.zeros(rows, np.int64)]  # node of each row at each depth
    score, count = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    hashes: list[np.ndarray] = []  # by start depth: hash of the characters from there on, at the rows in use
    out = np.zeros(rows, np.int64)
    for d in range(1, width + 1):
        alive = length >= d
        begin = np.flatnonzero(fresh[:, d - 1] & alive)  # first row of each node
        if not len(begin):
            break
        node.append(np.cumsum(fresh[:, d - 1] & alive) - 1)
        c = chars[begin, d - 1].astype(np.uint64)
        best = np.full(len(begin), P.NEVER)
        pieces = np.zeros(len(begin), np.int64)
        hashes.append(np.zeros(rows, np.uint64))
        for start in range(max(0, d - v.longest), d):  # longest piece first
            h = P.step(hashes[start][begin], c)
            # all rows of a node share the hash; it is kept at the rows below
            spread = h[np.clip(node[d], 0, None)]
            hashes[start] = np.where(alive, spread, hashes[start])
            k = v.find(h)
            gain = np.where(k >= 0, v.score[k], P.NEVER)
            used = np.ones(len(begin), np.int64)
            if start == d - 1:
                size = v.char_bytes(chars[begin, d - 1])
                gain = np.where(k >= 0, gain, size * v.byte_score)
                used = np.where(k >= 0, 1, size)
            above = node[start][begin]
            total = score[start][above] + gain
            better = total > best
            best = np.where(better, total, best)
            pieces = np.where(better, count[start][above] + used, pieces)
        score.append(best)
        count.append(pieces)
        ends = length == d
        out[ends] = pieces[node[d][ends]]
    result = np.empty(rows, np.int64)
    result[order] = out
    return result


def _count(shared):
    def run(batches):
        v = shared.value
        for batch in batches:
            for a, b in W.parts(batch.column(1), P.PARTS):
                part = batch.slice(a, b - a)
                t = P.tokens(part.column(1))
                pieces = np.zeros(len(t.first) - 1, np.int64)
                for rows, chars in P.by_length(t):
                    if chars.shape[1] > P.LONG:  # hardly ever two with a common prefix: a trie of one path each
                        pieces[rows] = [len(P.long_best(v, row[row != 0])[2]) for row in chars]
                    else:
                        pieces[rows] = terminal_counts(v, chars)
                total = np.r_[0, np.cumsum(pieces[t.number])]
                yield pa.RecordBatch.from_pydict({
                    "row": part.column(0), "n_pretokens": pa.array(np.diff(t.doc_first).astype(np.int64)),
                    "n_tokens": pa.array(total[t.doc_first[1:]] - total[t.doc_first[:-1]]),
                })
    return W.tidied(run)


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", scores: str = "rank",
                 columns: list[str] | None = None) -> DataFrame:
    """Each row (or its ``columns``) as struct ``row`` with ``n_pretokens`` and ``n_tokens``. A vocabulary has a fixed size, so it is sent to all tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(P.Vocabulary(vocabulary, scores))
    row, field = carried(docs, columns)
    schema = T.StructType([field, T.StructField("n_pretokens", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    return docs.select(row, F.col(text).alias("text")).mapInArrow(_count(shared), schema)
