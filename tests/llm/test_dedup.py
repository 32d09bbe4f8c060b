import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import components, neardup, substrings

from . import helpers as H


def _edit(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10_000)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near(spark):
    """Groups of copies with a few edits, near the threshold on both sides."""
    rng, texts = random.Random(3), list(H.AWKWARD)
    for group in range(12):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(60 + 10 * group)]
        texts += [_edit(base, rng, rng.randrange(0, 6)) for _ in range(9)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, near, width, percent):
    got = neardup.near_duplicates(H.documents(spark, near), width=width, percent=percent).collect()
    assert {tuple(r) for r in got} == H.near_duplicates(enumerate(near), width, percent)


def test_open_pairs_of_large_buckets_are_found(spark, near, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 2)
    monkeypatch.setattr(neardup, "GROUP", 7)
    monkeypatch.setattr(neardup, "BROADCAST", 0)
    got = neardup.near_duplicates(H.documents(spark, near), width=3, percent=85).collect()
    assert {tuple(r) for r in got} == H.near_duplicates(enumerate(near), 3, 85)


def test_null_and_equal_ids(spark):
    docs = H.documents(spark, ["a b c d", "a b c d", "a b c d", "a b c d", None], [None, 4, 4, 9, None])
    got = sorted((tuple(r) for r in neardup.near_duplicates(docs, width=3, percent=85).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False), (None, 0, None, True)], key=str)
    assert neardup.near_duplicates(docs.limit(0)).collect() == []


def test_drop_near_duplicates_keeps_columns(spark):
    docs = H.documents(spark, ["a b c d e f", "a b c d e f", None, "other"])
    out = neardup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 3]


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2), (2, 3)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_least_agreements():
    need = neardup.least_agreements([25, 125], 0.85, 1e-6)
    rng = np.random.default_rng(0)
    assert (rng.binomial(25, 0.85, 100_000) >= need[0]).mean() > 0.9999
    assert need[1] / 125 > need[0] / 25  # more values, closer bound


def _repeats(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()), key=str)


@pytest.mark.parametrize("chunk", [5 << 20, 300])
def test_repeats_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk)
    rng, texts = random.Random(5), list(H.AWKWARD)
    passages = [" ".join(f"p{k}x{j}" for j in range(rng.choice([11, 12, 13, 14, 25, 40]))) for k in range(15)]
    for _ in range(80):
        parts = [" ".join(f"r{rng.randrange(50)}" for _ in range(rng.randrange(20))) for _ in range(3)]
        texts.append(f"{parts[0]}  {rng.choice(passages)}\n{parts[1]} {rng.choice(passages)} {parts[2]}")
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[3], ids[-1], ids[-2] = None, None, ids[-3]
    docs = H.documents(spark, texts, ids).repartition(5)
    assert _repeats(substrings.remove_repeats(docs, part_bytes=2000)) == H.repeats(zip(ids, texts, strict=True))


def test_settled_windows_of_a_chunk_are_spread_over_the_partitions():
    rng = random.Random(6)
    passages = [" ".join(f"p{k}x{j}" for j in range(40)) for k in range(50)]
    texts = [rng.choice(passages) for _ in range(400)]
    batch = pa.record_batch({"doc_id": pa.array(range(400), pa.int64()), "text": pa.array(texts),
                             "text_key": pa.array([rng.getrandbits(63) for _ in texts], pa.int64())})
    full = SimpleNamespace(value=b"\xff" * (8 * 1024 // 8))
    sent = pa.Table.from_batches(list(substrings._send_windows(full, 8, 1024, 16, 7, 13)([batch])))
    done = [(p, np.frombuffer(d, np.int64).reshape(2, -1)[0].tolist(), len(at) // 8) for p, d, at, yes in zip(
        *(sent[c].to_pylist() for c in ("part", "docs", "at", "done")), strict=True) if yes]
    assert sum(n for _, _, n in done) == sum(i > texts.index(t) for i, t in enumerate(texts)) * 28
    assert {p for p, _, _ in done} == set(range(16))
    assert max(n for _, _, n in done) < 4 * sum(n for _, _, n in done) / 16
    where = [i for _, docs, _ in done for i in docs]
    assert len(where) == len(set(where))  # a document's settled windows stay together


def test_full_bitmap_changes_nothing(spark):
    texts = [H.PASSAGE, f"a {H.PASSAGE} b", "c " * 30, "c " * 31]
    docs = H.documents(spark, texts)
    assert _repeats(substrings.remove_repeats(docs, max_bits=8)) == H.repeats(enumerate(texts))
    assert substrings.remove_repeats(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="whole block"):
        substrings.remove_repeats(docs, width=13, anchor=8)


def test_the_anchor_bitmap_is_bounded_at_every_size():
    for total in (0, 1, 10**6, 10**9, 3 * 10**10, 10**12, 4 * 10**12, 10**13, 10**14, 10**17):
        parts, size = substrings.layout(total)
        assert parts * size <= substrings.MAX_BITS and size % 8 == 0 and parts >= 8
        assert total > 5 * 10**14 or total <= max(8, parts) * substrings.PART_BYTES
    assert substrings.layout(3 * 10**10)[1] == substrings.layout(3 * 10**10, max_bits=1 << 28)[1] >= 1 << 16
