import heapq
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import pieces, segment, tokencount
from tidewatch.llm.queries import VOCABULARY

from . import helpers as H


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(VOCABULARY)


def _all(v, text):
    """All segmentations of a text, best first."""
    chars = [pieces.BLANK] + [pieces.BLANK if c == " " else pieces.LITERAL if c == "▁" else ord(c) for c in text] if text else []
    out = []

    def go(i, score, ids):
        if i == len(chars):
            out.append((score, ids))
        for j in range(i + 1, min(len(chars), i + v.longest) + 1):
            part = chars[i:j]
            k = None if pieces.LITERAL in part else v.number.get("".join(map(chr, part)))
            if k is not None:
                go(j, score + int(v.score[k]), [*ids, int(v.id[k])])
            elif j == i + 1:
                own = [int(v.bytes[b]) for b in ("▁" if part[0] == pieces.LITERAL else chr(part[0])).encode()]
                go(j, score + len(own) * int(v.byte_score), ids + own)

    go(0, 0, [])
    return sorted(out, key=lambda x: -x[0])


def test_n_best_equal_all_segmentations(spark, vocabulary):
    texts = ["ab cd", "", None, "  x", "hello ", "the\ncat▁s", "日本 ñu", "   ", "a", "a a a a", "\x00😀"]
    rows = segment.encode(H.documents(spark, texts), VOCABULARY, n=5).collect()
    for r in rows:
        want = _all(vocabulary, texts[r.row.doc_id] or "")
        got = [r.score, *(o.score for o in r.others)]
        assert [round(s * pieces.UNIT) for s in got] == [s for s, _ in want[:5]]
        assert r.ids in [i for s, i in want if s == want[0][0]]
        for o in r.others:
            assert o.n_pieces in {len(i) for s, i in want if s == round(o.score * pieces.UNIT)}
            assert o.changes


def _n_best_by_whole_paths(v, chars, n):
    """The search with each path held whole, for short texts."""
    text = "".join(chr(c) if c < pieces.LITERAL else "\0" for c in chars)

    def arcs(j):
        for i in range(max(0, j - v.longest), j):
            k = v.number.get(text[i:j])
            if k is not None:
                yield i, int(v.score[k]), (int(v.id[k]),)
            elif i == j - 1:
                ids = tuple(v.char_ids(chars[i]))
                yield i, len(ids) * int(v.byte_score), ids

    forward = [0]
    for j in range(1, len(chars) + 1):
        forward.append(max(forward[i] + s for i, s, _ in arcs(j)))
    queue, out = [(-forward[-1], (), len(chars), 0, ())], []
    while queue and len(out) < n:
        bound, order, j, behind, ids = heapq.heappop(queue)
        if j == 0:
            out.append((-bound, list(ids)))
            continue
        for i, s, own in arcs(j):
            heapq.heappush(queue, (-(behind + s + forward[i]), (*order, i - j, own), i, behind + s, own + ids))
    return out


def test_shared_paths_give_the_lists_and_ties_of_whole_paths(vocabulary):
    rng = random.Random(7)
    texts = ["", "a", "x" * 300, "ab" * 100, "日本語" * 40, "\x00😀" * 20, "the" * 60]
    texts += ["".join(rng.choice("aaabt-=x1ñ日") for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    for text in texts:
        for n in (1, 2, 4, 9):
            chars = [ord(c) for c in text]
            assert segment.n_best(vocabulary, chars, n) == _n_best_by_whole_paths(vocabulary, chars, n)


@pytest.mark.parametrize("make", [lambda r: r.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/"), lambda r: "x"])
def test_n_best_of_a_blank_free_megabyte(vocabulary, make):
    rng = random.Random(8)
    chars = [ord(make(rng)) for _ in range(1 << 20)]
    found = segment.n_best(vocabulary, chars, 4)
    assert len(found) == 4 and len({tuple(ids) for _, ids in found}) == 4
    assert sorted((s for s, _ in found), reverse=True) == [s for s, _ in found]
    assert all("".join(vocabulary.text[k].decode() for k in ids) == "".join(map(chr, chars)) for _, ids in found)


def test_round_trip_and_counts(spark):
    docs = H.documents(spark, H.AWKWARD)
    encoded = segment.encode(docs, VOCABULARY).select("row.doc_id", "score", F.col("ids").alias("best"))
    back = {r.row.doc_id: r.decoded for r in segment.decode(encoded, VOCABULARY, ids="best").collect()}
    assert back == {k: t or "" for k, t in enumerate(H.AWKWARD)}
    counts = {r.row.doc_id: r.n_tokens for r in tokencount.token_counts(docs, VOCABULARY).collect()}
    assert counts == {r.doc_id: len(r.best) for r in encoded.collect()}
    assert segment.encode(docs.limit(0), VOCABULARY).collect() == []
    assert tokencount.token_counts(docs.limit(0), VOCABULARY).collect() == []


def test_trie_counts_equal_single_words(vocabulary):
    t = pieces.tokens(pa.array(["an ant anteater antenna anteater's  antics ñ ññ", "another ant"]))
    for rows, chars in pieces.by_length(t):
        got = tokencount.terminal_counts(vocabulary, chars)
        for k, n in zip(rows, got, strict=True):
            one = segment.n_best(vocabulary, t.chars[t.first[k]:t.first[k + 1]].tolist(), 1)
            assert n == len(one[0][1])


def test_file_scores_are_another_choice():
    v = pieces.Vocabulary(VOCABULARY, scores="model")
    assert v.score.max() <= 0 and len(v.pieces) > 30_000


def test_long_pretokens_are_segmented_like_short_ones(vocabulary):
    rng = random.Random(4)
    alphabet = "aaabcde-=/+日本語é▁"
    for _ in range(150):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40)))
        chars = np.array([pieces.LITERAL if c == "▁" else ord(c) for c in text], np.uint32)
        best, gap, ids, size = segment._best(vocabulary, chars[None])
        assert pieces.long_best(vocabulary, chars) == (best[0], gap[0], ids.tolist())
        assert tokencount.terminal_counts(vocabulary, chars[None])[0] == size[0] == len(ids)


def test_a_blank_free_megabyte_takes_seconds(spark, vocabulary):
    texts = ["日本語のテキスト" * 60_000, "QUJD" * 60_000 + "/+=", "-" * 300_000, "line\n" * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    start = time.perf_counter()
    counted = {r.doc_id: r.n_tokens for r in tokencount.token_counts(docs, VOCABULARY, columns=["doc_id"]).select("row.doc_id", "n_tokens").collect()}
    encoded = segment.encode(docs, VOCABULARY, n=2, verify=True, columns=["doc_id"]).select("row.doc_id", "ids", "round_trip").collect()
    assert time.perf_counter() - start < 240
    assert counted == {r.doc_id: len(r["ids"]) for r in encoded} and all(r.round_trip for r in encoded)
