import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check import rows_of

from tidewatch.catalog.oracles import SQL
from tidewatch.catalog.queries import QUERIES

#: Measured times differ from run to run.
NO_SQL = {"write_time_histogram"}
QUICK = [
    "throughput_drop", "latency_spike", "sessions", "anomaly_reports", "p99_by_service", "latency_histogram",
    "decode_quarantine", "scale_advice", "report_docs", "label_hits", "time_gate", "summary_table_busy",
]


def test_every_query_has_sql():
    assert set(QUERIES) - NO_SQL == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())


def test_streams_read_a_folder_of_part_files(spark, folder, tmp_path):
    """``events.parquet`` as one file and as a folder give the same rows; neighbours are not read."""
    spark.read.parquet(f"{folder}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(1).write.parquet(str(tmp_path / "events-old.parquet"))
    for name in ("stream_throughput_drop", "stream_progress"):
        one, many = (sorted(map(str, QUERIES[name](spark, f).collect())) for f in (folder, str(tmp_path)))
        assert one == many and one


def test_entry(spark):
    df = entry_module.entry(spark)
    assert "anomaly_type" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{folder}/events.parquet'")
    df = entry_module.queries()[name](spark, folder)
    cursor = con.execute(entry_module.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_dense_reports_have_full_batches_of_mixed_records(spark, folder):
    docs = QUERIES["report_docs_dense"](spark, folder).collect()
    assert max(d.anomaly_count for d in docs) == 10 and max(len(d.anomaly_types) for d in docs) >= 2


def test_summary_table_has_many_counts_ties_and_times(spark, folder):
    rows = QUERIES["summary_table_busy"](spark, folder).collect()
    per_time = {t: [r.summary_count for r in rows if r.generated_at == t] for t in {r.generated_at for r in rows}}
    assert len(per_time) == 10 and max(r.summary_count for r in rows) >= 3
    assert any(len(n) > len(set(n)) for n in per_time.values())  # services of equal counts, by name
    totals = [r.total for r in rows]
    assert len(set(totals)) < len(per_time)  # times of equal totals, the earlier one first
    docs = QUERIES["report_docs_dense"](spark, folder).collect()
    assert len({d.generated_at.timestamp() // 120 for d in docs}) > 10


def test_all_anomalies_scan_the_events_three_times_at_most(spark, folder):
    plan = QUERIES["anomaly_reports"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") <= 3
