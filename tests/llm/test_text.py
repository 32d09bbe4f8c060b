import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, lbl, pii, quality, words

from . import helpers as H


def test_words_match_the_patterns():
    column = pa.array(["skipped", *H.AWKWARD], pa.string()).slice(1)
    for separators, pattern, folded in ((words.SPACE, H.SPACE, False), (words.NOT_ALNUM, H.ALNUM, True)):
        w = words.words(column, separators, folded)
        want = [(k, x) for k, t in enumerate(H.AWKWARD) for x in re.findall(pattern, H.fold(t) if folded else t or "")]
        raw = bytes(w.data)
        got = [(int(d), raw[a:b].decode()) for d, a, b in zip(w.doc, w.start, w.end, strict=True)]
        assert [(d, H.fold(x) if folded else x) for d, x in got] == want
        assert len(set(w.hash.tolist())) == len({x for _, x in want})
    assert len(words.words(pa.array([], pa.string())).hash) == 0


def test_personal_data_equals_patterns(spark):
    rng = random.Random(1)
    texts = [*H.AWKWARD, "4111 1111-1111 1111 and 4111111111111112", "x@y.z_q@r.st a@b.c..d", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255",
             "+1 (555) 010-9999 +12 +1234567890123456", "😀 ñ me@mail.example 10.0.0.1", "1 " * 3000, "a1." * 3000, "12-34 " * 500]
    alphabet = "0123456789 -+.()@aZ_%ñ"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(300)]
    out = pii.spans(H.documents(spark, texts)).select("row.doc_id", pii.listed(pii.BASE), *(pii.count(k) for k in pii.BASE)).collect()
    for r in out:
        want = H.personal(texts[r[0]])
        assert r[1] == H.listed(want)
        assert list(r)[2:] == [sum(k == kind for k, _, _ in want) for kind in pii.BASE]


def test_checksums_and_context_add_spans(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 now", "DE89370400440532013001", "my ssn is 123-45-6789", "order 123-45-6789", "123-45-6789"]
    out = pii.spans(H.documents(spark, texts)).select("row.doc_id", pii.listed(pii.EXTRA)).sort("doc_id").collect()
    assert [r[1] for r in out] == ["iban:5:32", "", "identity:10:21", "", ""]


def test_redaction_replaces_overlapping_spans_once(spark):
    texts = ["mail a@b.cd or +49 30 1.2.3.44 end", None, "nothing", "10.0.0.1"]
    out = pii.spans(H.documents(spark, texts)).select(pii.redacted()).collect()
    assert [r[0] for r in out] == ["mail [EMAIL] or [PHONE] end", "", "nothing", "[IP]"]
    assert pii.spans(H.documents(spark, [])).collect() == []


def test_quality_measures_and_bands(spark):
    rng = random.Random(2)
    clean = [" ".join(rng.choice(["the", "river", "stone", "walks", "slowly", "green", "under", "light"]) + rng.choice("abcde")
                      for _ in range(120)) for _ in range(80)]
    junk = ["".join(rng.choice("qxzjvkw #$ñ9") for _ in range(900)) for _ in range(3)]
    texts = [*H.AWKWARD, *clean, *junk]
    out = quality.judge(H.documents(spark, texts)).collect()
    assert len(out) == len(texts)
    for r in out:
        want = H.quality(texts[r.row.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        if texts[r.row.doc_id] in clean and not r.base_failed:
            assert r.kept
        if texts[r.row.doc_id] in junk:
            assert not r.kept
    assert quality.judge(H.documents(spark, [])).collect() == []


def test_bands_part_symbol_ridden_and_list_like_junk_from_clean_documents(spark):
    rng = random.Random(4)
    syllables = [a + b for a in "bdfglmnprstv" for b in ("a", "e", "i", "o", "an", "er", "is")]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.choice([1, 2, 2, 3]))) for _ in range(3000)]
    text = lambda: [rng.choice(vocabulary) for _ in range(rng.randrange(150, 400))]
    clean = [" ".join(text()) + "." for _ in range(300)]
    symbols = [" ".join(w + rng.choice(["", "", "", "", "", " *", " #", "|"]) for w in text()) for _ in range(10)]
    lists = ["\n".join(f"{rng.randrange(100, 999)}. {w} {v}" for w, v in zip(text(), text(), strict=False)) for _ in range(10)]
    out = quality.judge(H.documents(spark, [*clean, *symbols, *lists])).collect()
    kept = {r.row.doc_id for r in out if r.kept}
    assert not any(r.base_failed for r in out)
    assert sum(k < 300 for k in kept) >= 294
    assert sum(300 <= k for k in kept) == 0


def test_bands_leave_out_most_labelled_junk_only(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    passed = quality.judge(docs, columns=["doc_id", "lang"]).where("not base_failed").select("row.doc_id", "kept").collect()
    share = lambda q: [sum(k) / len(k) for k in [[r.kept for r in passed if labels.get(r.doc_id) == q]]][0]
    assert share(1) > 0.97
    assert share(0) < 0.4


def test_language_model_of_characters_is_normalised(spark):
    model = quality.train(H.documents(spark, [*H.AWKWARD, "some words here"]))
    total = (10 ** model.table().astype(float)).reshape(-1, quality.CLASSES).sum(axis=1)
    assert abs(total - 1).max() < 1e-3


SCRIPTS = ["река течёт медленно под мостом", "мост стоит над рекой и рекой", "川はゆっくり流れる橋の下", "The river, the River 42 and 97\nrivers", "",
           None, "señor ñandú", "река река река"]


def _kneser_ney(texts):
    """Probability of each 5-gram of the texts, by the definition."""
    plain = lambda t: re.sub(r"[0-9]", "0", re.sub(r"[\x20\x09-\x0D]", " ", H.fold(t)))
    padded = [f"    {plain(t)} " for t in texts]
    levels = {5: Counter(t[k:k + 5] for t in padded for k in range(len(t) - 4))}
    for n in (4, 3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def probability(gram):
        if not gram:
            return 1 / (len(levels[1]) + 1)
        counts = levels[len(gram)]
        of = [sum(c == k for c in counts.values()) for k in range(1, 5)]
        y = of[0] / max(1, of[0] + 2 * of[1])
        own = [k - (k + 1) * y * of[k] / of[k - 1] if min(of) else 0 for k in (1, 2, 3)]
        off = [x if min(of) and 0 < x <= k else k / 2 for k, x in zip((1, 2, 3), own, strict=True)]
        after = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        cut = lambda c: off[min(c, 3) - 1]
        seen = counts[gram] - cut(counts[gram]) if gram in counts else 0
        return (seen + sum(map(cut, after)) * probability(gram[1:])) / sum(after) if after else probability(gram[1:])

    return [[probability(t[k:k + 5]) for k in range(len(t) - 4)] for t in padded]


@pytest.mark.parametrize("sent", [quality.GRAMS, 0])
def test_losses_equal_kneser_ney_over_characters_of_all_scripts(spark, monkeypatch, sent):
    """Whether the model is sent to the tasks or joined with the documents' 5-grams."""
    monkeypatch.setattr(quality, "GRAMS", sent)
    docs = H.documents(spark, SCRIPTS)
    want = [-sum(map(math.log10, p)) / len(p) for p in _kneser_ney(SCRIPTS)]
    got = {r.row.doc_id: r.loss for r in quality.measures(docs, quality.train(docs).scores).collect()}
    assert [got[k] for k in range(len(SCRIPTS))] == pytest.approx(want, rel=1e-5)
    assert len({round(x, 6) for x in (got[0], got[1], got[2])}) == 3


@pytest.mark.parametrize("sent", [quality.GRAMS, 0])
def test_documents_are_measured_once_for_bands_and_verdicts(spark, monkeypatch, sent):
    monkeypatch.setattr(quality, "GRAMS", sent)
    calls, measured = [], quality._measured
    monkeypatch.setattr(quality, "_measured", lambda *a: calls.append(a) or measured(*a))
    rng = random.Random(6)
    texts = [*SCRIPTS, *(" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(90)) for _ in range(12)), "#q7$ " * 9 + "x" * 99]
    docs = H.documents(spark, texts * 2).withColumn("a b.c", F.lit("x"))
    out = quality.judge(docs)
    assert len(calls) == 1
    assert "MapInArrow" not in out._jdf.queryExecution().toString()  # read back, not measured again
    want = {r.row.doc_id: r for r in measured(docs, quality.train(docs).scores, None, "text", None).collect()}
    found = {r.row.doc_id: r for r in out.collect()}
    assert found.keys() == want.keys() and any(not r.base_failed for r in found.values())
    for k, r in found.items():
        assert r.row == want[k].row and r[1:6] == want[k][1:6] and r.base_failed == want[k].base_failed
        assert r.loss == pytest.approx(want[k].loss, rel=1e-6)


ITEMS = [(1, H.PASSAGE), (10, "Lorem, ipsum dolor!"), (2, H.PASSAGE), (None, "ñandú"), (3, ""), (4, None), (5, "A B C a b c"),
         (5, "zz yy"), (6, " ".join(f"u{k}" for k in range(60)))]


@pytest.mark.parametrize("block", [500_000, 20])
def test_contamination_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 20_000)
    docs = H.documents(spark, H.AWKWARD)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.contamination(docs, items, block_words=block)
    got = sorted((tuple(r) for r in found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit"))).collect()), key=str)
    assert got == H.contamination(enumerate(H.AWKWARD), ITEMS)
    by = {r.row.doc_id: r for r in found.collect()}
    assert by[8].longest == 30 and [tuple(x) for x in by[8].runs] == [(1, 31)]
    assert found.limit(0).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("block", [500_000, 30])
def test_longest_matches_equal_brute_force(spark, monkeypatch, block):
    """Items that repeat their windows, overlap each other, or are shorter than a window."""
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 2_000)
    monkeypatch.setattr(decontaminate, "EXTENDED", 7)
    rng = random.Random(3)
    text = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    items = [(k, text(rng.randint(1, 40), "abc")) for k in range(12)] + [(20, "a " * 33), (21, "b c " * 20 + "a b c " * 9), (22, "a b"), (22, "c c c c"), (23, None)]
    docs = [text(rng.randint(0, 120), "abcd") for _ in range(40)] + ["a " * 50, "d " + "b c " * 20 + "a " + "a b c " * 9 + "d", "a b", None, "", "c d"]
    docs += [f"{items[k][1]} d {items[k + 1][1]}" for k in range(10)]

    def longest(x, width=5):
        best = 0
        for _, y in items:
            y = (y or "").split()
            least, before = min(width, len(y)), [0] * (len(y) + 1)
            for u in x:
                before = [0] + [before[j] + 1 if u == v else 0 for j, v in enumerate(y)]
                best = max([best, *(b for b in before if b >= least)])
        return best

    found = decontaminate.contamination(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), width=5, block_words=block)
    assert {r.row.doc_id: r.longest for r in found.collect()} == {k: longest((t or "").split()) for k, t in enumerate(docs)}


def test_language_model_base_scores_and_held_out_gain(spark, folder):
    import math
    import zlib
    from collections import Counter

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows += [(1000 + k, t) for k, t in enumerate(H.AWKWARD)] + [(None, "alone")]
    docs = H.documents(spark, [t for _, t in rows], [i for i, _ in rows])
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(i, [*re.findall(H.SPACE, H.fold(t)), "\n"]) for i, t in rows]
    count = Counter(x for i, w in tokens if not held(i) for x in w)
    total = sum(count.values())
    for head in (lbl.HEAD, 300):
        got = {r.doc_id: r for r in lbl.language_model(docs, head=head).collect()}
        for i, w in tokens:
            r = got[i]
            base = sum(math.log10((count[x] + 0.5) / (total + 0.5 * (len(count) + 1))) for x in w)
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(count[x] > 0 for x in w), total)
            assert abs(r.base_score - base) < 1e-6 * abs(base)
        tested = [r for r in got.values() if r.held_out]
        assert sum(r.score for r in tested) > sum(r.base_score for r in tested)
    assert lbl.language_model(docs.limit(0)).collect() == []


def test_table_of_the_neural_model_is_normalised():
    import numpy as np

    rng = np.random.default_rng(0)
    part = lambda *s: rng.normal(size=s).astype(np.float32)
    noise = np.full(lbl.UNITS, 1 / lbl.UNITS)
    m = lbl.Model(np.empty(0, np.uint64), noise, part(lbl.UNITS, lbl.DIM), part(lbl.UNITS, lbl.DIM), part(2, lbl.DIM, lbl.DIM) / 8,
                  part(lbl.UNITS))
    total = (10 ** m.table().astype(float)).reshape(-1, lbl.UNITS).sum(axis=1)
    assert abs(total - 1).max() < 1e-3


def test_a_text_of_very_many_addresses(spark):
    import time

    text = "".join(f"to a{k}@mail.org or 10.0.{k % 250}.7, call +1 555 {1000000 + k}\n" for k in range(40_000)) + "😀 end"
    start = time.perf_counter()
    found = pii.spans(H.documents(spark, [text, "x@y.zz 😀 " * 700])).select(
        "row.doc_id", pii.listed(pii.BASE).alias("listed"), pii.redacted().alias("redacted"), F.size("spans").alias("n")).collect()
    assert time.perf_counter() - start < 200
    for r in found:
        whole = [text, "x@y.zz 😀 " * 700][r.doc_id]
        want = H.personal(whole)
        assert r.listed == H.listed(want) and r.n >= len(want)
        out, at = [], 0
        for begin, end, kind in sorted((b, e, k) for k, b, e in want):
            if begin >= at:
                out += [whole[at:begin], f"[{kind.upper()}]"]
            at = max(at, end)
        assert r.redacted == "".join(out) + whole[at:]


def test_language_model_does_not_depend_on_the_files(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    scores = []
    for part in (docs.coalesce(1), docs.repartition(7, "doc_id"), docs.orderBy(F.desc("doc_id")).repartition(3)):
        scores.append({r.doc_id: r.score for r in lbl.language_model(part).collect()})
    for other in scores[1:]:
        assert other.keys() == scores[0].keys()
        assert all(other[k] == pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in scores[0].items())
