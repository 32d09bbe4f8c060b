import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidewatch.llm import oracles, queries

from . import helpers as H


def _run(spark, name, docs, folder="/root/testdata/sf0.001"):
    stage = dict(corpus_pipeline.STAGES)[name]
    return stage(spark, docs, folder)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, name, tmp_path):
    texts = [*H.AWKWARD, "again"]
    docs = H.documents(spark, texts, [*range(len(H.AWKWARD)), None])
    out = _run(spark, name, docs)
    out.write.parquet(str(tmp_path / "out"))
    if name != "sentencepiece":
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    assert _run(spark, name, docs.limit(0)).count() == 0


def test_stages_decide(spark, folder):
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    clean = " ".join(f"clean{k}" for k in range(60))
    docs = H.documents(spark, [clean, clean + " more", f"x {item} y", "reach me@mail.example", "short"])
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(_run(spark, "quality_rules", docs)) == [0, 1]
    assert ids(_run(spark, "near_dedup", docs)) == [0, 2, 3, 4]
    assert ids(_run(spark, "decontamination", docs)) == [0, 1, 3, 4]
    assert [r.text for r in _run(spark, "personal_data", docs.where("doc_id = 3")).collect()] == ["reach [EMAIL]"]
    assert all(r.ids for r in _run(spark, "sentencepiece", docs).collect())


def test_last_stage_decodes_what_it_encodes(spark):
    rows = _run(spark, "sentencepiece", H.documents(spark, H.AWKWARD)).collect()
    assert len(rows) == len(H.AWKWARD) and all(r.round_trip for r in rows)


def test_whole_pipeline_on_documents(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert 0 < len(out) < len(docs) and len({r.doc_id for r in out}) == len(out)
    base = {i for i, r in docs.items() if not H.quality(r.text)[-1]}
    assert {r.doc_id for r in out} <= base
    for r in out:
        spans = H.personal(docs[r.doc_id].text)
        assert ("[" in r.text) or not spans
        assert not any(k == "email" for k, _, _ in H.personal(r.text))


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_queries_equal_their_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    want = con.execute(f"select {', '.join(columns)} from ({oracles.SQL[name]})").fetchall()
    assert got == sorted(want)


def test_registered_queries_equal_brute_force(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op4_pii(spark, folder).collect():
        assert r.base_sha256 == H.sha(H.listed(H.personal(docs[r.doc_id])))
    for r in queries.op7_quality_rules(spark, folder).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == H.quality(docs[r.doc_id])
        assert not (r.kept and r.base_failed)
    rows = queries.op3_sentencepiece(spark, folder).collect()
    assert len(rows) == len(docs) and all(r.round_trip for r in rows)
    counts = {r.doc_id: r.n_tokens for r in queries.op9_token_counts(spark, folder).collect()}
    assert counts == {r.doc_id: r.n_pieces for r in rows}
    assert len(queries.op6_lbl_scores(spark, folder).collect()) == len(docs)


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(re.match(rf"op{n}_", x) for x in names) for n in range(1, 11))
