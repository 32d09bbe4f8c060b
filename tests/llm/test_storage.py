import base64
import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import sharding, warc
from tidewatch.session import new_path

from . import helpers as H

TRAP = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\ny"
PAGES = [(5, "http://a b/\r\nEvil: 1", "<p>ñ</p>", "x"), (7, "http://a", "<p>ñ</p>", "x"), (1, None, None, "x"), (2, "u", "", "x"),
         (3, "u", TRAP, "x"), (4, "u", "WARC/1.1\r\n", "x"), (6, "u", "a\nb\r\n\r\n", "x"), (8, "u", "z" * 100_000, "x"), (None, "u", "only", "x")]


def _expected(pages, least):
    out = []
    for i, _, html, _ in pages:
        raw = (html or "").encode()
        newest = max((p for p, _, h, _ in pages if (h or "") == (html or "") and p is not None), default=None)
        revisit = len(raw) >= least and i != newest
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response",
                    newest if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, sha1 string")
    path = new_path(spark, "warc")
    warc.write(pages, path, least, records_each=4)
    got = warc.read(spark, path, payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == _expected(PAGES, least)
    assert {bytes(r.payload).decode() for r in got if r.record_type == "response"} == {h or "" for _, _, h, _ in PAGES}


def test_empty_table_and_broken_archive(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, sha1 string")
    path = new_path(spark, "warc")
    warc.write(pages.limit(0), path)
    assert warc.read(spark, path).collect() == []
    text = "".join(r.value + "\n" for r in warc.records(pages.where("page_id in (3, 4, 8)").coalesce(1)).sort("value").collect())
    path = new_path(spark, "warc").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/cut.warc", "w", newline="") as f:
        f.write(text[:-200])
    assert len(warc.read(spark, path).collect()) == 2


def test_long_urls_lose_no_record(spark, tmp_path):
    url = "data:," + "u" * 100_000
    pages = [(k, url if k == 5 else "é " * 30_000 if k == 7 else "u", f"page {k}", "x") for k in range(10)]
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string, sha1 string").coalesce(1), path)
    got = {r.page_id: r.target for r in warc.read(spark, path).collect()}
    assert got == {k: u.replace(" ", "%20") for k, u, _, _ in pages}


def test_archives_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    """Pages of a few bytes to 20 MB in one partition: no archive is longer than the bound, but those of one record."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4 << 20)
    sizes = [10] * 3000 + [50_000] * 300 + [900_000] * 12 + [20 << 20] * 3
    order = np.random.default_rng(1).permutation(len(sizes))
    pages = spark.range(len(sizes)).join(spark.createDataFrame([(int(i), sizes[k]) for i, k in enumerate(order)], "id long, n int"), "id").selectExpr(
        "id as page_id", "'u' as url", "concat(cast(id as string), repeat('z', n)) as html").coalesce(1)
    warc.write(pages, str(tmp_path / "a"))
    found = warc.read(spark, str(tmp_path / "a")).groupBy("archive").agg(F.sum("length").alias("bytes"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in found) == len(sizes) and all(r.bytes <= 4 << 20 or r.n == 1 for r in found)
    assert len(found) < 25


def test_a_chain_that_ends_early_fails(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, sha1 string").where("page_id in (4, 6, 8)")
    records = [r.value + "\n" for r in warc.records(pages).collect()]
    broken = records[1].replace("Content-Length", "Content-Longth")
    (tmp_path / "a.warc").write_bytes((records[0] + broken + records[2]).encode())
    with pytest.raises(Exception, match="no record at byte"):
        warc.read(spark, str(tmp_path)).collect()
    for cut in (3, 40, 200):
        part = tmp_path / f"cut{cut}"
        part.mkdir()
        (part / "a.warc").write_bytes((records[0] + records[1][:cut]).encode())
        assert warc.read(spark, str(part)).count() == 1


def test_reached_by_pointer_jumping():
    offset = np.arange(0, 5000, 5)
    on = warc.reached(offset, np.where(offset % 10 == 0, offset + 10, offset + 5))
    assert (on == (offset % 10 == 0)).all()
    assert not warc.reached(np.array([5, 10]), np.array([10, 15])).any()
    assert len(warc.reached(np.empty(0, np.int64), np.empty(0, np.int64))) == 0


def _check(rows, limit):
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    for name, members in shards.items():
        assert len(name) == members[0].depth and {r.depth for r in members} == {len(name)}
        assert {r.shard_bytes for r in members} == {sum(r.n_bytes for r in members)}
        assert {r.shard_rows for r in members} == {len(members)}
        assert members[0].shard_bytes <= limit or len(members) == 1
        assert not any(other != name and other.startswith(name) for other in shards)
    return shards


def test_shards_fit_and_split_only_where_needed(spark):
    texts = [f"text {k} " * (k % 50) for k in range(400)] + H.AWKWARD
    docs = H.documents(spark, texts)
    rows = sharding.shard(docs, limit=4000).collect()
    assert sorted(r.row.doc_id for r in rows) == list(range(len(texts)))
    shards = _check(rows, 4000)
    for name in shards:  # the parent of a shard is too large
        if name:
            assert sum(r.n_bytes for s, m in shards.items() if s.startswith(name[:-1]) for r in m) > 4000
    assert len(_check(sharding.shard(docs, limit=1 << 30).collect(), 1 << 30)) == 1
    assert sharding.shard(docs.limit(0)).collect() == []


def test_one_hot_key_splits_too(spark):
    texts = [f"{k} " * 20 for k in range(120)]
    docs = H.documents(spark, texts, [7] * 80 + [None] * 30 + list(range(100, 110)))
    shards = _check(sharding.shard(docs, limit=500).collect(), 500)
    assert len(shards) >= 12
    # rows that are equal in every column cannot be told apart
    same = sharding.shard(H.documents(spark, ["a" * 100] * 6, [1] * 6).drop("lang"), limit=150).collect()
    assert {r.shard_rows for r in same} == {6}
