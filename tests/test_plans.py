import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, anomaly_table, at, event, table
from tidewatch.functions.text import matches_all, matches_any
from tidewatch.operators import matching, ordering
from tidewatch.plans import dashboards, evaluation, metrics, reports, scaling
from tidewatch.settings import Settings


def anomaly(i, t, **more):
    t = at(t) if isinstance(t, str) else t
    row = {"service": "user-auth", "anomaly_type": "throughput_drop", "window_start": t - timedelta(seconds=70),
           "window_end": t - timedelta(seconds=10), "detected_at": t, "event_count": 142, "prev_event_count": 387,
           "error_count": 0, "drop_pct": 63.3, "severity": "high", "session_key": f"k{i}"}
    row.update(more)
    return row


# --- reports

def test_batches_of_ten(spark):
    found = anomaly_table(spark, [anomaly(i, "0:00:05", error_count=i) for i in range(23)])
    docs = reports.report_docs(found).collect()
    assert sorted(d.anomaly_count for d in docs) == [3, 10, 10]
    batches = reports.report_batches(found)
    assert sorted(r.position for r in batches.collect()) == list(range(1, 24))


def test_batches_never_cross_a_window(spark):
    found = anomaly_table(spark, [anomaly(0, "0:00:29"), anomaly(1, "0:00:30"), anomaly(2, "0:00:31")])
    assert sorted(d.anomaly_count for d in reports.report_docs(found).collect()) == [1, 2]


def test_no_anomalies_no_report(spark):
    assert reports.report_docs(anomaly_table(spark, [])).count() == 0


def test_missing_service_is_unknown(spark):
    (d,) = reports.report_docs(anomaly_table(spark, [anomaly(0, "0:00:01", service=None)])).collect()
    assert d.services == ["unknown"] and d.anomaly_types == ["throughput_drop"]


def test_report_text(spark):
    found = anomaly_table(spark, [anomaly(i, at("0:00:05") + timedelta(minutes=i)) for i in range(4)])
    last = reports.report_docs(found).orderBy(F.desc("generated_at")).first()
    assert last.summary.splitlines() == [
        "## Anomaly Report — 2024-01-01 00:03:05 UTC",
        "**Type:** throughput_drop",
        "**Affected services:** user-auth",
        "**Window:** 2024-01-01 00:01:55 to 2024-01-01 00:02:55 UTC",
        "**Impact:** 245 events fewer than in the windows before (at most 63 % less); 0 server errors",
        "**Root cause hypothesis:** a service sends less",
        "**Recommended action:** follow the missing events of user-auth",
        "**Confidence:** High; earlier incidents of the kind: 3",
    ]
    assert last.model == "rules-v1"


def test_prior_incidents_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [anomaly(i, T0 + timedelta(seconds=rng.randrange(400)), service=rng.choice("ab")) for i in range(300)]
    got = {r.session_key: r.prior_count for r in reports.prior_incidents(anomaly_table(spark, rows)).collect()}
    for r in rows:
        want = sum(o["service"] == r["service"] and o["detected_at"] < r["detected_at"] for o in rows)
        assert got[r["session_key"]] == want


def test_prompt_lists_records_in_order(spark):
    import json

    found = anomaly_table(spark, [anomaly(2, "0:00:07"), anomaly(1, "0:00:05")])
    (r,) = reports.batch_prompts(reports.report_batches(found)).collect()
    records = json.loads(r.records_json)
    assert [x["session_key"] for x in records] == ["k1", "k2"]
    assert records[0]["detected_at_text"] == "2024-01-01 00:00:05"
    assert r.records_json in r.prompt


def test_keyword_search(spark):
    df = spark.createDataFrame([("Throughput drop: the outage",), ("Latency spike",)], "summary string")
    assert df.where(matches_any(F.col("summary"), "Outage of payments")).count() == 1
    assert df.where(matches_all(F.col("summary"), "spike latency")).count() == 1
    assert df.where(matches_any(F.col("summary"), "the of")).count() == 0


# --- ordering

def test_number_within_equals_sorting(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xxxxy"), rng.randrange(5), rng.random(), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, c int, o double, i int")
    got = {r.i: r.position for r in ordering.number_within(df, ["g"], ["c"], ["o", "i"]).collect()}
    for g in "xy":
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])
        assert [got[r[3]] for r in mine] == list(range(1, len(mine) + 1))


def test_top_k_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "service string, n int")
    top = ordering.top_k(df.withColumn("g", F.lit(1)), ["g"], [F.desc("n"), F.col("service")], 2)
    assert [r.service for r in top.orderBy("rank").collect()] == ["c", "a"]


def test_pages(spark):
    df = spark.range(25)
    assert [r.id for r in ordering.page(df, [F.desc("id")], 3, 10).collect()] == [4, 3, 2, 1, 0]


# --- matching

def test_events_in_windows(spark):
    ev = table(spark, [event(1, "0:00:10"), event(2, "0:01:00"), event(3, "0:00:30", service="b"),
                       event(4, "0:00:59.999999")])
    found = spark.createDataFrame(
        [("user-auth", at("0:00:05"), at("0:01:00")), ("user-auth", at("0:00:00"), at("0:00:20"))],
        "service string, window_start timestamp, window_end timestamp")
    assert sorted(r.event_id for r in matching.in_windows(ev, found).collect()) == ["1", "4"]
    assert sorted(r.event_id for r in matching.in_windows(ev, found, False).collect()) == ["2", "3"]


def test_baseline_default(spark):
    got = {r.service: (r.mu, r.zscore) for r in matching.with_baseline(
        table(spark, [event(1, "0:00:01", "user-auth", 60.0), event(2, "0:00:01", "other", 80.0)])).collect()}
    assert got == {"user-auth": (40.0, 2.0), "other": (50.0, 2.0)}


# --- scaling

def test_shard_diff(spark):
    active = spark.createDataFrame([("a",), ("b",), ("c",)], "shard_id string")
    current = spark.createDataFrame([("b",), ("d",)], "shard_id string")
    got = sorted(tuple(r) for r in scaling.shard_diff(active, current).collect())
    assert got == [("a", "add"), ("c", "add"), ("d", "remove")]


def test_scale_advice(spark):
    use = [0.75, 0.2, 0.2, 0.2, 0.2, 0.5, 0.2, 0.2, 0.2, 0.2, 0.2, 0.2]
    rows = [("s", "x", T0 + timedelta(minutes=i), u) for i, u in enumerate(use)]
    rows += [("s", "gap", T0 + timedelta(minutes=m), 0.1) for m in (0, 1, 2, 4, 5)]
    df = spark.createDataFrame(rows, "stream string, shard_id string, minute timestamp, utilisation double")
    got = scaling.scale_advice(df).orderBy("minute").collect()
    assert [r.advice for r in got if r.shard_id == "x"] == ["up"] + ["none"] * 9 + ["down", "down"]
    assert {r.advice for r in got if r.shard_id == "gap"} == {"none"}


# --- metrics and dashboards

def test_histogram_is_cumulative(spark):
    ev = table(spark, [event(i, "0:00:01", latency=v) for i, v in enumerate([0.5, 1.0, 40.0, 9000.0])])
    got = {r.le: r.bucket_count for r in metrics.histogram(ev, "service").collect()}
    assert got["1"] == 2 and got["50"] == 3 and got["5000"] == 3 and got["+Inf"] == 4


def test_gauge_and_lag(spark):
    samples = spark.createDataFrame([("t", 0, 5, T0), ("t", 0, 3, T0 + timedelta(seconds=1))],
                                    "topic string, partition int, lag bigint, ts timestamp")
    assert metrics.last_value(samples, ["topic", "partition"], "lag").first().lag == 3
    offs = spark.createDataFrame([("t", 0, 60_000), ("t", 1, 9)], "topic string, partition int, offset bigint")
    done = spark.createDataFrame([("t", 0, 9_999)], "topic string, partition int, offset bigint")
    lag = metrics.consumer_lag(offs, done)
    assert {r.partition: r.lag for r in lag.collect()} == {0: 50_001, 1: 10}
    assert [r.partition for r in metrics.lag_alerts(lag).collect()] == [0]
    assert metrics.lag_alerts(lag, Settings(lag_alert=50_001)).count() == 0


def test_metric_points_have_dimensions(spark):
    rows = spark.createDataFrame([("a", 2.5)], "service string, v double")
    (r,) = metrics.metric_points("n", "m", rows, "v", ["service"], "Milliseconds").collect()
    assert (r.value, r.unit, r.dimensions) == (2.5, "Milliseconds", {"service": "a"})


def test_summary_table_limits(spark):
    rows = [(T0 + timedelta(seconds=i % 12), [f"s{j}" for j in range(7)]) for i in range(13)]
    df = spark.createDataFrame(rows, "generated_at timestamp, services array<string>")
    got = dashboards.summary_table(df).collect()
    assert len({r.generated_at for r in got}) == 10 and len(got) == 50
    assert max(r.total for r in got) == 2 and {r.service for r in got} == {f"s{j}" for j in range(5)}


def test_p99_line(spark):
    ev = table(spark, [event(i, "0:00:01", f"s{i}", 100.0 * i) for i in range(10)])
    got = dashboards.p99_by_service(ev).orderBy("rank").collect()
    assert [r.service for r in got] == [f"s{i}" for i in range(9, 1, -1)]
    assert [r.breach for r in got] == [True] * 4 + [False] * 4


def test_label_rules(spark):
    rows = [event(1, "0:00:01"), event(2, "0:00:01", status=500),
            event(3, "0:00:01", latency=5.0, is_anomaly=True, anomaly_type="latency_spike"),
            event(4, "0:00:01", status=502, is_anomaly=True, anomaly_type="error_burst")]
    got = {r.rule: r.violations for r in evaluation.label_violations(table(spark, rows)).collect()}
    assert got["normal_is_200"] == 1 and got["spike_is_slow"] == 1
    assert got["burst_is_5xx"] == got["burst_is_error_event"] == got["normal_has_no_type"] == 0


def test_rates(spark):
    ev = table(spark, [event(i, T0 + timedelta(milliseconds=10 * i), is_anomaly=i % 10 == 0,
                             anomaly_type="error_burst" if i % 10 == 0 else None) for i in range(101)])
    assert 80 <= dashboards.event_rate(ev).first().events_per_second <= 120
    assert 0.04 < metrics.anomaly_rate(ev).first().anomaly_rate < 0.20
    assert metrics.anomaly_rate_alerts(ev).count() == 1


def test_free_form_search(spark):
    ev = table(spark, [event(1, "0:00:01"), event(2, "0:00:02", service="b")])
    assert dashboards.event_search(ev).count() == 2
    assert dashboards.event_search(ev, "service = 'b'").first().event_id == "2"


def test_clean_latency(spark):
    from tidewatch.functions.events import clean_latency

    df = spark.createDataFrame([(0.2,), (3.14159,)], "v double")
    assert [r[0] for r in df.select(clean_latency(F.col("v"))).collect()] == [1.0, 3.14]


def test_shared_folder_comes_from_the_session(spark):
    from tidewatch.session import new_path

    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_no_folder_is_made_up():
    from types import SimpleNamespace

    from tidewatch.session import shared_folder

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(bare)


def test_mean_keeps_all_decimals(spark):
    ev = table(spark, [event(i, "0:00:01", latency=1.0049) for i in range(3)])
    from tidewatch.operators.windows import tumbling_stats

    assert abs(tumbling_stats(ev, 60).first().avg_latency_ms - 1.0049) < 1e-9


def test_sections_are_the_same_in_prompt_and_report(spark):
    found = anomaly_table(spark, [anomaly(1, "0:00:05")])
    report = reports.report_docs(found).first().summary
    prompt = reports.batch_prompts(reports.report_batches(found)).first().prompt
    assert all(f"**{name}:**" in report and f"**{name}:**" in prompt for name in reports.SECTIONS)


def test_idle_minutes_make_a_low_streak(spark):
    rows = [("s", "x", at("0:00:05"))] * 10 + [("s", "x", at("0:20:00")), ("s", "y", at("0:20:30"))]
    records = spark.createDataFrame(rows, "stream string, shard_id string, timestamp timestamp")
    advice = scaling.scale_advice(scaling.utilisation(records, F.lit(10.0))).where("shard_id = 'x'")
    assert advice.count() == 21 and advice.agg(F.max("streak")).first()[0] == 20
    assert advice.where("advice = 'down'").count() == 16


def test_recent_events_push_the_bound_on_the_raw_time(spark, folder):
    from tidewatch.sources import tables

    recent = tables.events(spark, folder, tables.SESSIONS, last_s=3600)
    plan = recent._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(ts" in plan or ">= Subquery" in plan or "ts" in plan.split("PushedFilters")[1][:200]
    whole = tables.events(spark, folder, tables.SESSIONS)
    last = dashboards.last_hour(whole, dashboards.latest(whole))
    assert recent.count() >= last.count()
    assert last.select("event_id").exceptAll(recent.select("event_id")).isEmpty()


@pytest.mark.parametrize("bad", ["median", ""])
def test_unknown_method(spark, bad):
    from tidewatch.operators.detectors import latency_spike

    with pytest.raises(ValueError):
        latency_spike(table(spark, []), method=bad)
