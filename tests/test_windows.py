import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, at, event, table
from tidewatch.functions.quantiles import exact_quantile, grid, grid_quantile, grid_value
from tidewatch.operators import windows


def test_sliding_quantile_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [("a" if rng.random() < 0.8 else "b", rng.choice([0, 1, 2, 3, 7, 8, 20]),
             round(rng.lognormvariate(3, 2), 2)) for _ in range(1500)]
    rows += [("c", 5, 7.0)] * 300 + [("d", 5, 1.0), ("d", 6, -4.0), ("d", 7, 0.0)]
    df = spark.createDataFrame(rows, "k string, pane bigint, v double")
    for q in (0.5, 0.99, 1.0):
        found = exact_quantile(df, ["k"], F.col("pane"), F.col("v"), q, 4)
        got = {(r.k, r.win): (r.total, r.quantile) for r in found.collect()}
        want = {}
        for k in "abcd":
            panes = [p for key, p, _ in rows if key == k]
            for win in range(min(panes) - 3, max(panes) + 1):
                values = [v for key, p, v in rows if key == k and win <= p < win + 4]
                if values:
                    want[(k, win)] = (len(values), np.percentile(values, q * 100))
        assert got.keys() == want.keys()
        for key, (n, value) in want.items():
            assert got[key][0] == n and got[key][1] == pytest.approx(value, abs=1e-9)
        near = {(r.k, r.win): r.quantile for r in grid_quantile(df, ["k"], F.col("pane"), F.col("v"), q, 4).collect()}
        assert near.keys() == want.keys()
        assert all(near[key] == pytest.approx(value, rel=0.0102) for key, (_, value) in want.items() if value > 1)


def test_exact_quantile_equals_numpy_and_ignores_nulls(spark):
    rng = np.random.default_rng(1)
    values = {k: np.round(rng.exponential(40, n), 2) for k, n in (("x", 1), ("y", 2), ("z", 977))}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("z", None)] * 50
    df = spark.createDataFrame(rows, "k string, v double")
    for threshold in ("10485760", "-1"):  # the second reading with and without a broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = {r.k: r.quantile for r in exact_quantile(df, ["k"], F.lit(0), F.col("v"), 0.99).collect()}
        for k, vs in values.items():
            assert got[k] == pytest.approx(np.percentile(vs, 99))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_grid_error_is_within_one_percent(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 1.5, 99.99, 1847.3, 250000.0)], "v double")
    for r in df.select("v", grid_value(grid(F.col("v"))).alias("g")).collect():
        assert abs(r.g - r.v) / r.v < 0.0102


def test_tumbling_stats(spark):
    rows = [event(i, T0 + timedelta(seconds=i), latency=float(i + 1), status=503 if i < 3 else 200) for i in range(60)]
    rows += [event(100, "0:01:30", latency=5.0)]
    got = windows.tumbling_stats(table(spark, rows), 60).orderBy("window_start").collect()
    assert [(r.event_count, r.error_count) for r in got] == [(60, 3), (1, 0)]
    assert got[0].avg_latency_ms == pytest.approx(30.5)
    assert got[0].p99_latency_ms == pytest.approx(np.percentile(np.arange(1, 61), 99))


def test_sliding_window_bounds(spark):
    got = windows.sliding_p99(table(spark, [event(1, "0:10:00", latency=8.0)])).collect()
    assert len(got) == 10
    assert all((r.window_end - r.window_start) == timedelta(minutes=5) for r in got)
    assert min(r.window_start for r in got) == at("0:05:30").replace(tzinfo=None)
    assert {r.p99_latency_ms for r in got} == {8.0}
