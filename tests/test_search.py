"""Ranked search against plain BM25, and sketches against the events themselves."""

import math
import re
from datetime import timedelta

from pyspark.sql import functions as F

from tests.helpers import T0, event, table
from tidewatch.functions.text import STOP_WORDS
from tidewatch.operators import search, sketches


def bm25(texts, query, k, k1=1.2, b=0.75):
    words = {i: [w for w in re.split("[^a-z0-9]+", (t or "").lower()) if w and w not in STOP_WORDS] for i, t in texts}
    mean = sum(map(len, words.values())) / len(words)
    out = {}
    for term in dict.fromkeys(w for w in re.split("[^a-z0-9]+", query.lower()) if w and w not in STOP_WORDS):
        df = sum(term in w for w in words.values())
        for i, w in words.items():
            if n := w.count(term):
                gain = math.log(1 + (len(words) - df + 0.5) / (df + 0.5)) * n * (k1 + 1) / (n + k1 * (1 - b + b * len(w) / mean))
                out[i] = out.get(i, 0) + gain
    best = sorted((-round(s, 9), i) for i, s in out.items())[:k]
    return [(i, -s, r + 1) for r, (s, i) in enumerate(best)]


def test_ranked_search_equals_plain_bm25(spark, tmp_path):
    texts = [(i, " ".join(["error"] * (i % 4) + ["payment"] * (i % 3) + ["filler"] * (i % 7) + [f"x{i}"])) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "Payment, PAYMENT; payment!"), (103, "the of and"), (104, "error"), (105, "error"), (106, "long " * 5000 + "payment")]
    search.build_index(spark.createDataFrame(texts, "id long, body string").repartition(3), "id", "body", str(tmp_path / "i"))
    for query in ("payment error", "the payment of payment", "x7", "nowhere", "the", ""):
        got = [(r.id, round(r.score, 9), r["rank"]) for r in search.search(spark, str(tmp_path / "i"), query, 12).orderBy("rank").collect()]
        want = bm25(texts, query, 12)
        assert [g[0] for g in got] == [w[0] for w in want] and all(abs(g[1] - w[1]) < 1e-8 for g, w in zip(got, want, strict=True))
        assert [g[2] for g in got] == [w[2] for w in want]


def test_search_of_an_empty_table(spark, tmp_path):
    search.build_index(spark.createDataFrame([], "id long, body string"), "id", "body", str(tmp_path / "i"))
    assert search.search(spark, str(tmp_path / "i"), "payment").count() == 0


def test_sketches_merge_to_any_window(spark):
    rows = [event(i, T0 + timedelta(seconds=i / 4), "ab"[i % 2], float(i * 7919 % 4001), user_id=f"u{i % 500}") for i in range(4000)]
    rows += [event("n", T0, "b", latency=1.0) | {"latency_ms": None}, event("s", T0, None, 5.0), event("k", T0, "a", 5.0, user_id=None) | {"user_id": None}]
    ev = table(spark, rows)
    panes = sketches.pane_sketches(ev)
    for width, every in ((2, 2), (10, 1), (40, 20)):
        found = sketches.error_of(sketches.merged(panes, width, every), ev).collect()
        assert found and all(r.rank_error <= sketches.RANK_ERROR and r.distinct_error <= sketches.DISTINCT_ERROR for r in found)
    whole = sketches.merged(panes, 2880, 2880, by=[]).first()
    assert whole.event_count == len(rows) and abs(whole.distinct_keys - 501) <= 501 * sketches.DISTINCT_ERROR
    alone = sketches.merged(panes.where("service is null"), 2, 2).collect()
    assert [(r.service, r.event_count, r.p99_latency_ms) for r in alone] == [(None, 1, 5.0)]


def test_panes_of_a_sketch_stay_small(spark):
    rows = [event(i, T0, "a", float(i), user_id=f"u{i}") for i in range(30_000)]
    size = sketches.pane_sketches(table(spark, rows)).select(F.octet_length("latencies") + F.octet_length("keys")).first()[0]
    assert size < 40_000


def test_top_keys_are_exact_whether_or_not_keys_are_heavy(spark):
    from tidewatch.operators import heavy

    rows = [event(i, T0 + timedelta(seconds=i / 10), user_id=f"u{i * i % 37}" if i % 2 else f"x{i}") for i in range(6000)]
    rows += [event(f"n{i}", T0, "a") | {"user_id": None} for i in range(300)]
    ev = table(spark, rows)
    counts = {}
    for r in rows:
        counts[r["user_id"]] = counts.get(r["user_id"], 0) + 1
    want = sorted(((n, u) for u, n in counts.items()), key=lambda x: (-x[0], x[1] is not None, x[1] or ""))[:8]
    for tracked in (1024, 16):  # enough for the heavy keys; far too few
        got = heavy.top_keys(ev, "user_id", tracked=tracked).orderBy("rank").collect()
        assert [(r.n, r.key) for r in got] == want and [r["rank"] for r in got] == list(range(1, 9))
    assert heavy.top_keys(ev.limit(0), "user_id").count() == 0
