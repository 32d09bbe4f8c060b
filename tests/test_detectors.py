from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, anomaly_table, at, event, table
from tidewatch.operators import detectors
from tidewatch.operators.sessions import sessions


def minute_of(service, minute, n, first_id):
    return [event(first_id + i, T0 + timedelta(minutes=minute, milliseconds=40 * i), service) for i in range(n)]


def test_golden_throughput_drop(spark):
    rows = minute_of("payment-gateway", 0, 387, 0) + minute_of("payment-gateway", 1, 142, 1000)
    rows += [event(5000, "0:05:00", "user-auth")]
    (r,) = detectors.throughput_drop(table(spark, rows)).where(
        "event_count > 0 and service = 'payment-gateway'").collect()
    assert (r.event_count, r.prev_event_count) == (142, 387)
    assert r.drop_pct == pytest.approx(63.307, abs=1e-3)
    assert r.severity == "high"
    assert r.detected_at - r.window_end == timedelta(seconds=10)


def test_golden_latency_ratio(spark):
    rows = [event(i, T0 + timedelta(seconds=4 * i), latency=132.6) for i in range(75)]
    rows += [event(1000 + i, T0 + timedelta(seconds=300 + 4 * i), latency=1847.3) for i in range(75)]
    rows += [event(9999, "0:30:00")]
    for method, tolerance in (("exact", 1e-9), ("grid", 0.011)):
        found = detectors.latency_spike(table(spark, rows), method=method)
        r = found.where(F.col("window_end") == F.lit(at("0:10:00"))).collect()[0]
        assert r.p99_latency_ms == pytest.approx(1847.3, rel=tolerance)
        assert r.baseline_p99 == pytest.approx(132.6, rel=tolerance)
        assert r.severity == "critical"


def test_boundary_drop_is_strict(spark):
    rows = minute_of("a", 0, 100, 0) + minute_of("a", 1, 60, 1000)
    rows += minute_of("b", 0, 100, 2000) + minute_of("b", 1, 59, 3000)
    rows += minute_of("a", 2, 60, 4000) + minute_of("b", 2, 59, 5000) + [event(9999, "0:03:10", "b")]
    found = detectors.throughput_drop(table(spark, rows)).collect()
    assert [(r.service, r.event_count) for r in found] == [("b", 59)]
    assert found[0].drop_pct == pytest.approx(41.0)


def test_total_outage_is_seen_and_open_windows_are_not(spark):
    rows = minute_of("a", 0, 10, 0) + [event(100, "0:04:00", "b")]
    found = detectors.throughput_drop(table(spark, rows)).collect()
    assert [(r.service, r.event_count, r.drop_pct, r.avg_latency_ms) for r in found] == [("a", 0, 100.0, None)]
    # the end of the data is no outage: the last window of b is still open
    assert "b" not in {r.service for r in found}


def test_spike_needs_enough_events(spark):
    rows = [event(i, T0 + timedelta(seconds=10 * i), latency=10.0) for i in range(30)]
    rows += [event(100 + i, T0 + timedelta(seconds=300 + 16 * i), latency=900.0) for i in range(19)]
    rows += [event(999, "0:30:00", "b")]
    assert detectors.latency_spike(table(spark, rows)).where(
        F.col("window_start") >= F.lit(at("0:05:00"))).count() == 0


def test_exact_gap_is_one_session(spark):
    rows = [event(1, "0:00:00"), event(2, "0:10:00"), event(3, "0:19:59"), event(4, "2:00:00", session="z")]
    (r,) = sessions(table(spark, rows)).collect()
    assert r.event_count == 3
    assert (r.window_start, r.window_end) == (at("0:00:00").replace(tzinfo=None), at("0:29:59").replace(tzinfo=None))


def test_sessions_equal_brute_force_with_a_hot_key(spark):
    import random

    rng = random.Random(3)
    rows, t = [], {"hot": 0.0, "cold": 0.0}
    for i in range(3000):
        key = "hot" if rng.random() < 0.9 else "cold"
        t[key] += rng.choice([1, 5, 60, 599, 600, 600.000001, 900]) if rng.random() < 0.1 else rng.random()
        rows.append(event(i, T0 + timedelta(seconds=t[key]), rng.choice(["a", "b", "c"]),
                          rng.choice([10.0, 200.0]), rng.choice([200, 500]), key))
    rows.append(event(10**6, T0 + timedelta(days=9), session="end"))
    want = []
    for key in t:
        mine = sorted((r for r in rows if r["session_id"] == key), key=lambda r: r["timestamp"])
        groups = [[mine[0]]]
        for r in mine[1:]:
            if r["timestamp"] - groups[-1][-1]["timestamp"] <= timedelta(minutes=10):
                groups[-1].append(r)
            else:
                groups.append([r])
        for g in groups:
            n = len(g)
            e = sum(r["status_code"] >= 500 for r in g) / n
            s = sum(r["latency_ms"] > 100 for r in g) / n
            names = [r["service"] for r in g]
            top = min(set(names), key=lambda x: (-names.count(x), x))
            want.append((key, g[0]["timestamp"].replace(tzinfo=None), n, top, round(1 - (1 - e) * (1 - s), 9)))
    got = [(r.session_key, r.window_start, r.event_count, r.service, round(r.anomaly_score, 9))
           for r in sessions(table(spark, rows)).collect()]
    assert sorted(got) == sorted(want)


def test_slow_can_be_relative_to_the_service(spark):
    from tidewatch.operators.matching import with_baseline

    rows = [event(i, T0 + timedelta(seconds=i), "user-auth", 90.0, 500) for i in range(3)]
    rows += [event(10 + i, T0 + timedelta(seconds=i), "payment-gateway", 90.0, 200, "s2") for i in range(3)]
    rows += [event(99, "5:00:00", session="end")]
    ev = with_baseline(table(spark, rows))
    found = detectors.session_anomalies(ev, slow=F.col("latency_ms") > 2 * F.col("mu")).collect()
    assert [(r.session_key, r.anomaly_score) for r in found] == [("sess_1", 1.0)]


def test_union_fills_missing_fields(spark):
    one = anomaly_table(spark, [{"service": "a"}]).select("service")
    two = anomaly_table(spark, [{"service": "b", "drop_pct": 50.0}]).select("service", "drop_pct")
    both = detectors.anomalies(one, two)
    from tidewatch.schemas import ANOMALY

    assert both.columns == ANOMALY.names
    assert sorted((r.service, r.drop_pct) for r in both.collect()) == [("a", None), ("b", 50.0)]
