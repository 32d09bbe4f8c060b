"""The registered queries as plain SQL over the same tables, for comparison."""

from __future__ import annotations

EV = """
ev as (
  select event_id, user_id as uid, k, idx, t, t60,
         (epoch_us(t) // 1000)::bigint as epoch_ms,
         (epoch_us(t60) // 1000)::bigint as epoch_ms60,
         ['payment-gateway','user-auth','product-catalog','order-management','inventory-sync',
          'recommendation-engine','search-service','notification-hub'][idx + 1] as service,
         event_type,
         ['us-east-1','us-west-2','eu-west-1','ap-southeast-1'][k % 4 + 1] as region,
         'user_' || user_id as user_id, 'sess_' || user_id as session_id,
         case when slow then value * 8 else value end as latency_ms,
         case when event_type = 'error' then [500, 502, 503, 504][k % 4 + 1] else 200 end as status_code,
         slow or event_type = 'error' as is_anomaly,
         case when slow then 'latency_spike' when event_type = 'error' then 'error_burst' end as anomaly_type,
         (200 + event_id * 7919 % 7993)::int as payload_bytes,
         ['web','mobile-ios','mobile-android','api'][event_id % 4 + 1] as client,
         'v' || (1 + k % 5) || '.' || (k % 10) || '.' || (event_id % 10) as version
  from (
    select *, idx = 3 and minute between 14 and 16 as slow
    from (
      select *, (user_id % 8)::int as idx, (props::json->>'$.k')::int as k,
             make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 1440) as t,
             make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) as t60,
             (epoch_us(ts) - 1704067200000000) // 86400000000 as minute
      from events)
    where not (idx = 5 and minute in (9, 20) and event_id % 10 < 8))
)"""

DROPS = """
drop_pane as (
  select service, time_bucket(interval '1 minute', t) ws, 1 cur, 0 prev, (status_code >= 500)::int err, latency_ms lat from ev
  union all
  select service, time_bucket(interval '1 minute', t) + interval '1 minute', 0, 1, 0, null from ev),
drop_pair as (
  select service, ws, sum(cur)::bigint c, sum(prev)::bigint p, sum(err)::bigint e, sum(lat::decimal(28,6))::double / sum(cur) lat
  from drop_pane group by 1, 2),
drops as (
  select service, 'throughput_drop' as anomaly_type, ws as window_start, ws + interval '1 minute' as window_end,
         ws + interval '70 seconds' as detected_at, c as event_count, p as prev_event_count, e as error_count,
         lat as avg_latency_ms, 100 * ((p - c)::double / p) as drop_pct,
         case when (p - c)::double / p / 0.40 >= 2 then 'critical'
              when (p - c)::double / p / 0.40 >= 1.5 then 'high' else 'medium' end as severity
  from drop_pair
  where p > 0 and (p - c)::double / p > 0.40
    and ws + interval '1 minute' <= (select max(t) - interval '10 seconds' from ev))"""

SPIKES = """
spike_slice as (
  select service, t, latency_ms, unnest(generate_series(
           time_bucket(interval '30 seconds', t) - interval '570 seconds',
           time_bucket(interval '30 seconds', t), interval '30 seconds')) w0 from ev),
spike_pair as (
  select service, w0,
         count(*) filter (where t >= w0 + interval '5 minutes') n,
         count(*) filter (where t < w0 + interval '5 minutes') nb,
         quantile_cont({value}, 0.99) filter (where t >= w0 + interval '5 minutes') p99,
         quantile_cont({value}, 0.99) filter (where t < w0 + interval '5 minutes') b
  from spike_slice group by 1, 2),
spikes as (
  select service, 'latency_spike' as anomaly_type, w0 + interval '5 minutes' as window_start,
         w0 + interval '10 minutes' as window_end, w0 + interval '610 seconds' as detected_at,
         n as event_count, p99 as p99_latency_ms, b as baseline_p99,
         case when p99 / b / 2.0 >= 2 then 'critical' when p99 / b / 2.0 >= 1.5 then 'high' else 'medium' end as severity
  from spike_pair
  where n >= 20 and nb >= 20 and p99 > 2 * b
    and w0 + interval '10 minutes' <= (select max(t) - interval '10 seconds' from ev))"""
GRID_VALUE = "exp((floor(ln(greatest(latency_ms, 1)) * 50) + 0.5) / 50)"
EXACT_SPIKES = SPIKES.format(value="latency_ms")
GRID_SPIKES = SPIKES.format(value=GRID_VALUE)

SESSIONS = """
session_step as (
  select *, case when t60 - lag(t60) over (partition by session_id order by t60, event_id) <= interval '10 minutes'
                 then 0 else 1 end as begins from ev),
session_nr as (
  select *, sum(begins) over (partition by session_id order by t60, event_id rows unbounded preceding) as nr
  from session_step),
session_all as (
  select session_id as session_key, mode(service order by service) as service, min(t60) as window_start,
         max(t60) + interval '10 minutes' as window_end, count(*) as event_count,
         count(*) filter (where status_code >= 500) as error_count,
         count(*) filter (where latency_ms > 100) as slow_count,
         1 - (1 - avg((status_code >= 500)::int)) * (1 - avg((latency_ms > 100)::int)) as anomaly_score
  from session_nr group by session_id, nr),
session_closed as (
  select * from session_all where window_end <= (select max(t60) - interval '10 seconds' from ev)),
flagged as (
  select service, 'session_anomaly' as anomaly_type, window_start, window_end,
         window_end + interval '10 seconds' as detected_at, event_count, error_count,
         case when anomaly_score / 0.85 >= 2 then 'critical' when anomaly_score / 0.85 >= 1.5 then 'high'
              else 'medium' end as severity, session_key, anomaly_score
  from session_closed where event_count >= 3 and anomaly_score > 0.85)"""

ANOMALIES = f"""{EV}, {DROPS}, {EXACT_SPIKES}, {SESSIONS},
anomalies as (
  select * from drops
  union all by name select * from spikes
  union all by name select * from flagged)"""

DROP_OUT = """service, anomaly_type, window_start, window_end, detected_at, event_count, prev_event_count,
  error_count, round(avg_latency_ms, 6) as avg_latency_ms, round(drop_pct, 6) as drop_pct, severity"""
SPIKE_OUT = """service, anomaly_type, window_start, window_end, detected_at, event_count,
  round(p99_latency_ms, 6) as p99_latency_ms, round(baseline_p99, 6) as baseline_p99, severity"""
SESSION_OUT = """session_key, service, window_start, window_end, event_count, error_count, slow_count,
  round(anomaly_score, 6) as anomaly_score"""
FLAGGED_OUT = """service, anomaly_type, window_start, window_end, detected_at, event_count, error_count,
  severity, session_key, round(anomaly_score, 6) as anomaly_score"""
ANOMALY_OUT = """service, anomaly_type, window_start, window_end, detected_at, event_count, prev_event_count,
  error_count, round(avg_latency_ms, 6) as avg_latency_ms, round(p99_latency_ms, 6) as p99_latency_ms,
  round(baseline_p99, 6) as baseline_p99, round(drop_pct, 6) as drop_pct, severity, session_key,
  round(anomaly_score, 6) as anomaly_score"""

SQL: dict[str, str] = {
    "throughput_drop": f"with {EV}, {DROPS} select {DROP_OUT} from drops",
    "latency_spike": f"with {EV}, {EXACT_SPIKES} select {SPIKE_OUT} from spikes",
    "latency_spike_grid": f"with {EV}, {GRID_SPIKES} select {SPIKE_OUT} from spikes",
    "sessions": f"with {EV}, {SESSIONS} select {SESSION_OUT} from session_closed",
    "session_anomalies": f"with {EV}, {SESSIONS} select {FLAGGED_OUT} from flagged",
    "anomaly_reports": f"with {ANOMALIES} select {ANOMALY_OUT} from anomalies",
    "tumbling_stats": f"""with {EV}
        select service, time_bucket(interval '1 minute', t) as window_start,
               time_bucket(interval '1 minute', t) + interval '1 minute' as window_end, count(*) as event_count,
               count(*) filter (where status_code >= 500) as error_count, round(sum(latency_ms::decimal(28,6))::double / count(*), 6) as avg_latency_ms,
               round(quantile_cont(latency_ms, 0.99), 6) as p99_latency_ms
        from ev group by all""",
    "sliding_p99": f"""with {EV}, s as (
          select service, latency_ms, unnest(generate_series(
                   time_bucket(interval '30 seconds', t) - interval '270 seconds',
                   time_bucket(interval '30 seconds', t), interval '30 seconds')) as window_start from ev)
        select service, window_start, window_start + interval '5 minutes' as window_end, count(*) as event_count,
               round(quantile_cont(latency_ms, 0.99), 6) as p99_latency_ms
        from s group by all""",
}
SQL["stream_throughput_drop"] = SQL["throughput_drop"]
SQL["stream_latency_spike"] = SQL["latency_spike"]
SQL["stream_latency_spike_grid"] = SQL["latency_spike_grid"]
SQL["stream_sessions"] = SQL["sessions"]

# --- dashboards and searches

SQL["stream_tumbling_stats"] = SQL["tumbling_stats"].replace(
    "from ev group by all",
    "from ev where time_bucket(interval '1 minute', t) + interval '1 minute' "
    "<= (select max(t) - interval '10 seconds' from ev) group by all")

SQL["stream_sliding_p99"] = SQL["sliding_p99"].replace(
    "from s group by all",
    "from s where window_start + interval '5 minutes' <= (select max(t) - interval '10 seconds' from ev) group by all")
# one batch holds all data, so early alerts end with every window of the data, finished or not
SQL["stream_latency_spike_early"] = SQL["latency_spike_grid"].replace(
    "and w0 + interval '10 minutes' <= (select max(t) - interval '10 seconds' from ev)", "")

NOW = "(select max(t) from ev)"
SECONDS = "(epoch_us(max(t)) - epoch_us(min(t))) / 1000000"
EVENT_COLUMNS = "event_id::varchar as event_id, {t} as timestamp, service, event_type, latency_ms, status_code, is_anomaly"

SQL.update({
    "events_per_second": f"""with {EV}
        select time_bucket(interval '1 second', t) as window_start, count(*) as event_count from ev group by all""",
    "event_rate": f"""with {EV}
        select count(*) as event_count, round({SECONDS}, 6) as span_s,
               round(count(*) / ({SECONDS}), 6) as events_per_second from ev""",
    "anomaly_counts": f"""with {ANOMALIES}
        select service, anomaly_type, count(*) as anomaly_count from anomalies group by all""",
    "p99_by_service": f"""with {EV}, p as (
          select time_bucket(interval '10 seconds', t) as bucket, service, quantile_cont(latency_ms, 0.99) as p99
          from ev group by all)
        select bucket, service, round(p99, 6) as p99_latency_ms,
               row_number() over (partition by bucket order by p99 desc, service)::int as rank, p99 > 500 as breach
        from p qualify rank <= 8""",
    "error_rate": f"""with {EV}
        select service, time_bucket(interval '10 seconds', t) as window_start, count(*) as event_count,
               count(*) filter (where status_code >= 500) as error_count,
               round(count(*) filter (where status_code >= 500) / count(*), 6) as error_rate from ev group by all""",
    "heatmap": f"""with {EV}
        select service, time_bucket(interval '1 minute', t) as window_start, count(*) as event_count
        from ev group by all""",
    "heatmap_grid": f"""with {EV}
        select time_bucket(interval '1 minute', t) as window_start, {', '.join(
            f"count(*) filter (where service = '{name}' and event_id % 10 <> 4) as {chr(34)}{name}{chr(34)}" for name in (
                "payment-gateway", "user-auth", "product-catalog", "order-management", "inventory-sync",
                "recommendation-engine", "search-service", "notification-hub"))},
          count(*) filter (where event_id % 10 = 4) as other
        from ev group by 1""",
    "active_anomalies": f"""with {EV}, {DROPS}, {EXACT_SPIKES}, {SESSIONS.replace("t60", "t")}, a as (
          select service, anomaly_type, detected_at from drops
          union all select service, anomaly_type, detected_at from flagged
          union all select service, anomaly_type, detected_at from spikes)
        select service, anomaly_type, count(*) as anomaly_count, max(detected_at) as last_detected_at from a
        where detected_at > {NOW} - interval '10 minutes' and detected_at <= {NOW} group by all""",
    "recent_events": f"""with {EV}
        select {EVENT_COLUMNS.format(t="t60")} from ev
        where t60 > (select max(t60) from ev) - interval '1 hour' order by t60 desc, event_id""",
    "recent_page": f"""with {EV}
        select {EVENT_COLUMNS.format(t="t")} from ev order by t desc, event_id::varchar limit 10 offset 10""",
    "filtered_events": f"""with {EV}
        select {EVENT_COLUMNS.format(t="t")} from ev where service = 'payment-gateway' and latency_ms > 200""",
    "top_services": f"""with {EV}, c as (select region, service, count(*) as event_count from ev group by all)
        select region, service, event_count,
               row_number() over (partition by region order by event_count desc, service)::int as rank
        from c qualify rank <= 3""",
})

# --- reports

REPORTS = f"""{ANOMALIES},
prior as (
  select *, (rank() over (partition by service, anomaly_type order by detected_at) - 1)::bigint as prior_count
  from anomalies),
numbered as (
  select *, time_bucket(interval '30 seconds', detected_at) as batch_window,
         row_number() over (
           partition by time_bucket(interval '30 seconds', detected_at)
           order by date_trunc('second', detected_at), service, anomaly_type,
                    substr(md5(coalesce(session_key, '')), 1, 2), detected_at, window_start, session_key) as position
  from prior),
batched as (select *, (position - 1) // 10 as batch_no from numbered),
facts as (
  select batch_window, batch_no, count(*)::int as anomaly_count,
         list_sort(list_distinct(list(service))) as services,
         list_sort(list_distinct(list(anomaly_type))) as anomaly_types,
         max(detected_at) as generated_at, min(window_start) as since, max(window_end) as until,
         sum(prev_event_count - event_count) filter (where anomaly_type = 'throughput_drop')::bigint as missed,
         max(drop_pct) as drop_pct, max(p99_latency_ms) as p99, max(p99_latency_ms / baseline_p99) as rise,
         sum(case when anomaly_type = 'session_anomaly' then 1 end)::bigint as flagged,
         coalesce(sum(error_count), 0)::bigint as errors, max(prior_count) as prior
  from batched group by 1, 2),
docs as (
  select concat_ws(chr(10),
      '## Anomaly Report — ' || strftime(generated_at, '%Y-%m-%d %H:%M:%S') || ' UTC',
      '**Type:** ' || array_to_string(anomaly_types, ', '),
      '**Affected services:** ' || array_to_string(services, ', '),
      '**Window:** ' || strftime(since, '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(until, '%Y-%m-%d %H:%M:%S') || ' UTC',
      '**Impact:** ' || concat_ws('; ',
          missed || ' events fewer than in the windows before (at most ' || round(drop_pct)::bigint || ' % less)',
          'p99 latency up to ' || round(p99)::bigint || ' ms', errors || ' server errors'),
      '**Root cause hypothesis:** ' || concat_ws('; ',
          case when drop_pct >= 100 then 'a service sends nothing' when drop_pct is not null then 'a service sends less' end,
          'latency rose to ' || round(100 * rise)::bigint || ' % of its level',
          flagged || ' sessions with errors or slow calls'),
      '**Recommended action:** ' || concat_ws('; ',
          case when drop_pct is not null then 'follow the missing events of '
               || case when len(services) > 1 then 'what these services share' else services[1] end end,
          case when rise is not null then 'trace slow calls of '
               || case when len(services) > 1 then 'what these services share' else services[1] end end,
          case when flagged is not null then 'read the flagged sessions' end),
      '**Confidence:** ' || case when prior >= 3 then 'High' when prior >= 1 then 'Medium' else 'Low' end
          || '; earlier incidents of the kind: ' || prior) as summary,
    anomaly_count, services, anomaly_types, generated_at, 'rules-v1' as model
  from facts)"""
SUMMARY_COLUMNS = "generated_at, services, anomaly_types, anomaly_count, summary"
TEXT_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}_text"
WHEN = "strftime(max(detected_at), '%Y-%m-%d %H:%M:%S')"

SQL.update({
    "report_batches": f"""with {REPORTS}
        select batch_window, batch_no, position, service, anomaly_type, window_start, session_key from batched""",
    "batch_prompts": f"""with {REPORTS}, texts as (
          select batch_window, batch_no, position, detected_at, service, anomaly_type,
                 {', '.join(TEXT_TIME.format(c) for c in ("window_start", "window_end", "detected_at"))},
                 event_count, prev_event_count, error_count, severity, session_key from batched),
        grouped as (
          select batch_window, batch_no, count(*)::int as anomaly_count, {WHEN} as stamp,
                 to_json(list({{service: service, anomaly_type: anomaly_type, window_start_text: window_start_text,
                   window_end_text: window_end_text, detected_at_text: detected_at_text, event_count: event_count,
                   prev_event_count: prev_event_count, error_count: error_count, severity: severity,
                   session_key: session_key}} order by position))::varchar as records_json
          from texts group by 1, 2)
        select batch_window, batch_no, anomaly_count, records_json,
               anomaly_count || ' anomaly records, newest ' || stamp || ' UTC:' || chr(10) || records_json || chr(10)
               || 'Fill in this form:' || chr(10) || '## Anomaly Report — ' || stamp || array_to_string(list_transform(
                    ['Type', 'Affected services', 'Window', 'Impact', 'Root cause hypothesis', 'Recommended action',
                     'Confidence'], lambda s: chr(10) || '**' || s || ':**'), '') as prompt
        from grouped""",
    "report_docs": f"with {REPORTS} select * from docs",
    "summaries": f"with {REPORTS} select {SUMMARY_COLUMNS} from docs order by generated_at desc",
    "summary_keywords": f"""with {REPORTS} select {SUMMARY_COLUMNS} from docs
        where regexp_matches(lower(summary), '(^|[^a-z0-9])(outage|partition)($|[^a-z0-9])')""",
    "summary_table": f"""with {REPORTS},
        largest as (select generated_at, count(*) as total from docs group by 1 order by 2 desc, 1 limit 10),
        counts as (select generated_at, total, service, count(*) as summary_count
                   from (select generated_at, unnest(services) as service from docs) join largest using (generated_at)
                   group by all)
        select generated_at, total, service, summary_count from counts
        qualify row_number() over (partition by generated_at order by summary_count desc, service) <= 5""",
    "summaries_by_model": f"with {REPORTS} select model, count(*) as summary_count from docs group by all",
    "missed_events": f"""with {EV}, {DROPS}
        select service, sum(prev_event_count - event_count)::bigint as missed_events, count(*) as drop_count
        from drops group by all""",
    "prior_incidents": f"""with {REPORTS}
        select service, anomaly_type, window_start, session_key, detected_at, prior_count from prior""",
    "metric_points": f"""with {REPORTS}
        select 'StreamingAnalytics' as namespace, 'EventLatencyMs' as metric_name, round(latency_ms, 6) as value,
               'Milliseconds' as unit, '{{"service":"' || service || '"}}' as dimensions from ev
        union all
        select 'StreamingAnalytics', 'AnomaliesDetected', 1.0, 'Count',
               '{{"service":"' || service || '","anomaly_type":"' || anomaly_type || '"}}' from anomalies
        union all
        select 'StreamingAnalytics', 'LLMSummariesGenerated', 1.0, 'Count', '{{"model":"' || model || '"}}' from docs""",
})

# --- metrics, lag, scaling, alerts


def histogram_sql(key: str, bounds: list[int]) -> str:
    """Cumulative histogram of latency per key."""
    wide = ", ".join(f"count(*) filter (where latency_ms <= {b}) as le_{b}" for b in bounds)
    tail = "n as value_count, value_sum"
    parts = [f"select {key}, '{b}' as le, le_{b} as bucket_count, {tail} from h" for b in bounds]
    parts.append(f"select {key}, '+Inf' as le, n as bucket_count, {tail} from h")
    return (f"with {EV}, h as (select {key}, {wide}, count(*) as n, "
            "round(sum(latency_ms::decimal(28,6))::double, 6) as value_sum from e group by 1) "
            + " union all ".join(parts))


LAG = f"""{EV},
offs as (select 'analytics-events' as topic, (event_id % 6)::int as partition, event_id // 6 as "offset", t from ev),
lag as (
  select topic, partition, max("offset") as latest_offset,
         max("offset") filter (where t <= {NOW} - to_minutes(partition + 1)) as committed_offset
  from offs group by 1, 2),
lagged as (select *, latest_offset - coalesce(committed_offset, -1) as lag from lag)"""
SHARDS = """
recs as (select 'analytics-events' as stream, 'shard-' || (event_id % 6) as shard_id, (event_id % 6)::int as nr,
                event_id // 6 as sequence_number, t from ev),
recs8 as (select 'shard-' || (event_id % 8) as shard_id, event_id % 8 as nr, event_id // 8 as sequence_number from ev),
shards as (select shard_id, min(sequence_number) as starting_seq,
                  case when nr >= 6 then max(sequence_number) end as ending_seq from recs8 group by shard_id, nr)"""
RATE = """rates as (
  select time_bucket(interval '1 minute', t) as window_start, count(*) as event_count,
         count(*) filter (where is_anomaly) as anomaly_count,
         count(*) filter (where is_anomaly) / count(*) as rate from ev group by 1)"""

SQL.update({
    "events_by_status": f"""with {EV}
        select service, case when status_code >= 500 then 'error' else 'ok' end as status, count(*) as event_count
        from ev group by all""",
    "latency_histogram": histogram_sql("service", [1, 5, 10, 50, 100, 250, 500, 1000, 2500, 5000]).replace(
        "from e group", "from ev group"),
    "index_latency_histogram": histogram_sql("index_pattern", [1, 5, 10, 50, 100, 500, 1000]).replace(
        "from e group", "from (select *, 'events-' || event_type as index_pattern from ev) group"),
    "delivery_rate": f"""with {EV}
        select time_bucket(interval '10 seconds', t) as window_start,
               count(*) filter (where event_id % 211 <> 0) as sent,
               count(*) filter (where event_id % 211 = 0) as errors,
               round(count(*) filter (where event_id % 211 <> 0) / 10, 6) as events_per_second from ev group by 1""",
    "delivery_total": f"""with {EV}
        select count(*) filter (where event_id % 211 <> 0) as sent, count(*) filter (where event_id % 211 = 0) as errors,
               round({SECONDS}, 6) as elapsed_s,
               round(count(*) filter (where event_id % 211 <> 0) / ({SECONDS}), 6) as mean_rate from ev""",
    "consumer_lag": f"with {LAG} select * from lagged",
    "lag_alerts": f"with {LAG} select * from lagged where lag > 50000",
    "lag_alerts_low": f"with {LAG} select * from lagged where lag > 20",
    "last_offset_gauge": f"""with {LAG}
        select topic, partition, max_by("offset", t) as "offset", max(t) as timestamp from offs
        where t <= {NOW} - to_minutes(partition + 1) group by 1, 2""",
    "shard_lag": f"""with {EV}, {SHARDS}
        select stream, shard_id, round((epoch_us(max(t)) - epoch_us(max(t) filter (
                 where t <= {NOW} - to_seconds(30 * nr)))) / 1000000, 6) as lag_s from recs group by 1, 2""",
    "anomaly_rate": f"""with {EV}
        select count(*) as event_count, count(*) filter (where is_anomaly) as anomaly_count,
               round(count(*) filter (where is_anomaly) / count(*), 6) as anomaly_rate from ev""",
    "anomaly_rate_alerts": f"""with {EV}, {RATE}
        select window_start, event_count, anomaly_count, round(rate, 6) as anomaly_rate from rates where rate > 0.05""",
    "anomaly_rate_alerts_high": f"""with {EV}, {RATE}
        select window_start, event_count, anomaly_count, round(rate, 6) as anomaly_rate from rates where rate > 0.22""",
    "shard_active": f"with {EV}, {SHARDS} select * from shards where ending_seq is null",
    "shard_diff": f"""with {EV}, {SHARDS}, active as (select shard_id from shards where ending_seq is null),
        used as (select distinct shard_id from recs8 where nr >= 2)
        select shard_id, 'add' as action from active where shard_id not in (select shard_id from used)
        union all select shard_id, 'remove' from used where shard_id not in (select shard_id from active)""",
    "consumer_heartbeat": f"""with {EV}, {SHARDS}
        select time_bucket(interval '1 minute', t) as window_start, count(distinct shard_id) as active_consumers
        from recs group by 1""",
    "scale_advice": f"""with {EV}, {SHARDS},
        counted as (select stream, shard_id, time_bucket(interval '1 minute', t) as minute, count(*) as n
                    from recs where not (nr = 2 and minute(t) between 3 and 20) group by all),
        load as (select stream, shard_id, minute, coalesce(n, 0) as n
                 from (select stream, shard_id, unnest(generate_series(min(minute),
                         (select max(minute) from counted), interval '1 minute')) as minute from counted group by 1, 2)
                 left join counted using (stream, shard_id, minute)),
        util as (select stream, shard_id, minute, n / ((select max(n) from load) * case when minute(minute) % 15 < 8 then 1 else 5 end) as utilisation from load),
        runs as (
          select *, utilisation < 0.25 as low,
                 epoch_us(minute) // 60000000 - row_number() over (
                   partition by stream, shard_id, utilisation < 0.25 order by minute) as island from util),
        streaks as (
          select *, case when low then row_number() over (partition by stream, shard_id, low, island order by minute)
                         else 0 end::int as streak from runs)
        select stream, shard_id, minute, round(utilisation, 6) as utilisation, streak,
               case when utilisation > 0.70 then 'up' when streak >= 5 then 'down' else 'none' end as advice
        from streaks""",
})

# --- transport

COPIES = "copies as (select * from ev union all select * from ev where event_id % 20 = 3)"
RESUME = """marks as (select shard_id, max(sequence_number) as read_up_to from recs
                     where nr < 4 and minute(t) < 12 group by 1),
todo as (select * from recs left join marks using (shard_id)
         where coalesce(sequence_number > read_up_to, {fresh}))"""
RESUMED = """select shard_id, count(*) as records, min(sequence_number) as first_sequence,
       max(sequence_number) as last_sequence from todo group by 1"""

SQL.update({
    "decode_quarantine": f"""with {EV}
        select service as key, case when event_id % 100 = 13 then 'malformed' when event_id % 100 in (59, 83, 91) then 'bad_value'
               else 'unknown_field' end as reason, count(*) as records
        from ev where event_id % 100 in (13, 27, 41, 59, 83, 91) group by all""",
    "strict_gate": f"""with {EV}
        select event_id::varchar as event_id, case when event_id % 100 in (27, 41) then 'unknown_field' else 'bad_value' end
               as reason from ev where event_id % 100 in (27, 41, 59, 83, 91)""",
    "required_fields": f"""with {EV}
        select field, case when field = 'region' then (select count(*) from ev where event_id % 100 = 73)
                           else 0 end as missing
        from (select unnest(['event_id', 'timestamp', 'epoch_ms', 'service', 'event_type', 'region', 'user_id',
                             'session_id', 'latency_ms', 'status_code', 'is_anomaly', 'payload_bytes', 'metadata'])
              as field)""",
    "json_round_trip": f"""with {EV}
        select event_id::varchar as event_id, t as timestamp, epoch_ms, service, event_type, region, user_id, session_id,
               round(latency_ms, 6) as latency_ms, status_code, is_anomaly, anomaly_type, payload_bytes, client, version
        from ev""",
    "dedupe": f"""with {EV}, {COPIES}
        select event_id::varchar as event_id, service, t as timestamp from copies
        qualify row_number() over (partition by event_id) = 1""",
    "shard_resume": f"with {EV}, {SHARDS}, {RESUME.format(fresh='true')} {RESUMED}",
    "shard_resume_latest": f"with {EV}, {SHARDS}, {RESUME.format(fresh='false')} {RESUMED}",
    "shard_resume_at_time": f"""with {EV}, {SHARDS},
        {RESUME.format(fresh="t >= timestamp '2024-01-01 00:20:00'")} {RESUMED}""",
    "stream_progress": "select 'events_per_minute' as source, count(*) as input_rows, 0::bigint as late_rows from events",
})
SQL["time_gate"] = f"""with {EV}
    select case when event_id % 100 in (17, 31) then 'implausible_time' end as reason,
           case event_id % 100 when 17 then 2999 when 31 then 1970 else year(t) end::int as year, count(*) as records
    from ev group by 1, 2"""
SQL["stream_dedupe"] = SQL["dedupe"]
SQL["stream_events_by_status"] = SQL["events_by_status"]

# --- fields and evaluation

LATENCY_MODEL = """model(service, mu, sigma) as (values
  ('payment-gateway', 120.0::double, 30.0::double), ('user-auth', 40, 10), ('product-catalog', 25, 8),
  ('order-management', 90, 20), ('inventory-sync', 60, 15), ('recommendation-engine', 200, 50),
  ('search-service', 45, 12), ('notification-hub', 30, 8))"""
REPORTED = f"""{EV}, {DROPS}, {EXACT_SPIKES},
reported as (select service, window_start, window_end from drops
             union all select service, window_start, window_end from spikes)"""
IN_REPORT = """exists (select 1 from reported r where r.service = e.service
                and e.t >= r.window_start and e.t < r.window_end)"""

SQL.update({
    "clock_drift": f"""with {EV}
        select event_id % 5 as drift_ms, count(*) as event_count from ev group by 1""",
    "client_versions": f"with {EV} select client, version, count(*) as event_count from ev group by all",
    "unknown_services": f"""with {EV}
        select case when event_id % 10 = 4 then 'unknown' else service end as service, count(*) as event_count
        from ev group by 1""",
    "clean_latencies": f"""with {EV}
        select event_id::varchar as event_id, round(greatest(1.0::double, latency_ms / 3), 2) as latency_ms from ev""",
    "server_errors": f"""with {EV}
        select service, event_type, status_code, count(*) as event_count from ev where status_code >= 500 group by all""",
    "baseline_zscore": f"""with {EV}, {LATENCY_MODEL}
        select event_id::varchar as event_id, service, coalesce(mu, 50) as mu, coalesce(sigma, 15) as sigma,
               round((latency_ms - coalesce(mu, 50)) / coalesce(sigma, 15), 6) as zscore
        from ev left join model using (service)""",
    "label_violations": f"""with {EV}
        select 'normal_is_200' as rule, count(*) filter (where not is_anomaly and status_code <> 200) as violations from ev
        union all select 'normal_has_no_type', count(*) filter (where not is_anomaly and anomaly_type is not null) from ev
        union all select 'anomaly_has_type', count(*) filter (where is_anomaly and anomaly_type is null) from ev
        union all select 'spike_is_slow', count(*) filter (where anomaly_type = 'latency_spike' and latency_ms <= 10) from ev
        union all select 'burst_is_5xx', count(*) filter (where anomaly_type = 'error_burst' and status_code < 500) from ev
        union all select 'burst_is_error_event',
                         count(*) filter (where anomaly_type = 'error_burst' and event_type <> 'error') from ev""",
    "label_hits": f"""with {REPORTED}
        select event_id::varchar as event_id, service, t as timestamp, anomaly_type from ev e
        where is_anomaly and {IN_REPORT}""",
    "label_misses": f"""with {REPORTED}
        select event_id::varchar as event_id, service, t as timestamp, anomaly_type from ev e
        where is_anomaly and not {IN_REPORT}""",
})

NO_SERVICE = "(select * replace (case when event_id % 10 = 4 then null else service end as service) from ev)"
SQL["null_service_p99"] = SQL["sliding_p99"].replace("interval '30 seconds')) as window_start from ev)",
                                                     f"interval '30 seconds')) as window_start from {NO_SERVICE})")
SQL["null_service_stats"] = SQL["tumbling_stats"].replace("from ev group by all", f"from {NO_SERVICE} group by all")
SQL["null_id_dedupe"] = f"""with {EV}
    select case when event_id % 50 <> 3 then event_id::varchar end as event_id, service, t as timestamp from ev"""
SQL["session_anomalies_by_service"] = f"with {EV}, {LATENCY_MODEL}, " + SESSIONS.replace(
    "as begins from ev)", "as begins from ev left join model using (service))").replace(
    "latency_ms > 100", "latency_ms > 2 * coalesce(mu, 50)") + f" select {FLAGGED_OUT} from flagged"
# a batch is filtered by the watermark that the batch before it started with
SQL["stream_late_windows"] = f"""with {EV},
    arrived as (select *, time_bucket(interval '1 minute', t) as ws, least(minute(t + case when event_id % 40 = 7
                  then interval '90 seconds' else interval '0 seconds' end) // 8, 3) as batch from ev),
    tops as (select batch, max(t) as top from arrived group by 1),
    marks as (select b as batch, (select max(top) - interval '10 seconds' from tops where tops.batch <= b - 2) as mark
              from range(0, 4) r(b))
    select service, ws as window_start, count(*) as event_count from arrived join marks using (batch)
    where (mark is null or ws + interval '1 minute' > mark)
      and ws + interval '1 minute' <= (select max(t) - interval '10 seconds' from ev)
    group by all"""


def dense(sql: str) -> str:
    """A query over reports with the low thresholds, sessions on the same timeline."""
    for plain, low in (
        ("0.40", "0.05"), ("/ 2.0 >=", "/ 1.02 >="), ("n >= 20 and nb >= 20 and p99 > 2 * b", "n >= 5 and nb >= 5 and p99 > 1.02 * b"),
        ("/ 0.85 >=", "/ 0.5 >="), ("event_count >= 3 and anomaly_score > 0.85", "event_count >= 2 and anomaly_score > 0.5"),
        ("max(t60)", "max(t)"), ("min(t60)", "min(t)"), ("t60 - lag(t60)", "t - lag(t)"), ("order by t60", "order by t"),
    ):
        assert plain in sql, plain
        sql = sql.replace(plain, low)
    return sql


SQL.update({f"{name}_dense": dense(SQL[name]) for name in ("report_batches", "batch_prompts", "report_docs", "summary_table")})
SQL["summary_table_busy"] = SQL["summary_table_dense"].replace(
    "largest as (select", "times as (select * replace (time_bucket(interval '2 minutes', generated_at) as generated_at) from docs),\n        largest as (select").replace(
    "as total from docs", "as total from times").replace("as service from docs", "as service from times")
# full batches leave at once, the rest of a window when it is closed
SQL["stream_report_batches"] = SQL["report_batches_dense"] + """
    where (select count(*) from batched b where b.batch_window = batched.batch_window and b.batch_no = batched.batch_no) = 10
       or batch_window + interval '30 seconds' <= (select max(detected_at) - interval '10 seconds' from batched)"""
SQL["throughput_drop_joined"] = SQL["stream_throughput_drop_joined"] = SQL["throughput_drop"]
SQL["stream_replay_once"] = SQL["dedupe"]

# --- sketches: the windows and their counts; that the errors stay within the stated bounds

SQL["sketch_windows"] = f"""with {EV}, s as (
      select service, unnest(generate_series(time_bucket(interval '30 seconds', t) - interval '270 seconds',
               time_bucket(interval '30 seconds', t), interval '30 seconds')) as window_start from ev)
    select service, window_start, window_start + interval '5 minutes' as window_end, count(*) as event_count,
           true as p99_within, true as users_within from s group by all"""
SQL["sketch_days"] = f"""with {EV}
    select service, time_bucket(interval '1 day', t) as window_start, time_bucket(interval '1 day', t) + interval '1 day' as window_end,
           count(*) as event_count, true as p99_within, true as users_within from ev group by all"""
SQL["stream_sketch_windows"] = f"""with {EV}
    select service, time_bucket(interval '1 minute', t) as window_start,
           time_bucket(interval '1 minute', t) + interval '1 minute' as window_end, count(*) as event_count
    from ev where time_bucket(interval '30 seconds', t) + interval '30 seconds' <= (select max(t) - interval '10 seconds' from ev)
    group by all"""
SQL["heartbeat_sketch"] = f"""with {EV}, {SHARDS}, w as (
      select time_bucket(interval '1 minute', t) as window_start, interval '1 minute' as width, shard_id from recs
      union all select time_bucket(interval '1 day', t), interval '1 day', shard_id from recs)
    select window_start, window_start + width as window_end, count(distinct shard_id) as active_consumers from w group by all"""

STOP_LIST = """['a', 'an', 'and', 'are', 'as', 'at', 'be', 'but', 'by', 'for', 'if', 'in', 'into', 'is', 'it', 'no', 'not', 'of', 'on', 'or', 'such',
    'that', 'the', 'their', 'then', 'there', 'these', 'they', 'this', 'to', 'was', 'will', 'with']"""
SQL["summary_search_ranked"] = dense(f"""with {REPORTS},
    texts as (select md5(summary) as id, list_filter(flatten(list(regexp_split_to_array(lower(summary), '[^a-z0-9]+'))),
                lambda w: w <> '' and not list_contains({STOP_LIST}, w)) as words from docs group by 1),
    size as (select count(*) as n, avg(len(words)) as mean from texts),
    posting as (select id, len(words) as length, term, count(*) as times from (select id, words, unnest(words) as term from texts) group by all),
    wanted as (select * from posting where term in ('throughput', 'payment', 'gateway', 'search', 'service', 'nothing', 'sent')),
    known as (select term, count(*) as df from wanted group by 1),
    scored as (select id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * length / mean))), 9) as score
               from wanted join known using (term), size group by 1)
    select id, round(score, 6) as score, (row_number() over (order by scored.score desc, id))::int as rank from scored
    qualify rank <= 10""")

# --- heavy hitters

SQL["top_callers"] = f"""with {EV}, c as (
      select case when event_id % 3 = 0 then 'user ' || user_id else region || ' ' || service || ' ' || event_type end as key, count(*) as n
      from ev group by 1)
    select key, n, (row_number() over (order by n desc, key))::int as rank from c qualify rank <= 8"""
SQL["top_users"] = f"""with {EV}, c as (select user_id as key, count(*) as n from ev group by 1)
    select key, n, (row_number() over (order by n desc, key))::int as rank from c qualify rank <= 8"""

# --- compaction: days are days, not compressed

DAYS = EV.replace("// 1440)", "// 1)")
SQL["compacted_events"] = f"""with {DAYS}
    select event_id::varchar as event_id, service, t as timestamp from ev
    where t > timestamp '2024-01-05 06:00:00' and t <= timestamp '2024-01-26 06:00:00' and service in ('user-auth', 'search-service')"""
SQL["compacted_files"] = f"""with {DAYS}
    select t::date as event_date, count(*) as event_count, true as few_files from ev where t < timestamp '2024-01-24 00:00:00' group by all"""

# --- similar incidents: all pairs

SQL["similar_incidents"] = dense(f"""with {REPORTS},
    item as (select batch_window, batch_no, detected_at, unnest(['type:' || anomaly_type, 'service:' || service, anomaly_type || '@' || service,
               'severity:' || severity, case when drop_pct >= 100 then 'silent:' || service end]) as item from batched),
    feat as (select batch_window, batch_no, max(detected_at) as detected_at,
               list_sort(list_distinct(list(item) filter (where item is not null))) as features from item group by 1, 2),
    pair as (select a.batch_window, a.batch_no, len(list_intersect(a.features, b.features)) as s, len(a.features) + len(b.features) as total
             from feat a join feat b on b.detected_at < a.detected_at),
    near as (select batch_window, batch_no, count(*) as n from pair where 100 * s >= 50 * (total - s) group by 1, 2)
    select batch_window, batch_no, detected_at, features, coalesce(n, 0)::bigint as similar_count from feat left join near using (batch_window, batch_no)""")

# --- open state

SQL["open_sessions"] = f"""with {EV}, {SESSIONS}
    select session_key, window_start, window_end, event_count, window_end + interval '10 seconds' as expires_at
    from session_all where window_end > (select max(t60) - interval '10 seconds' from ev)"""
SQL["open_windows"] = f"""with {EV}, w as (
      select service, time_bucket(interval '1 minute', t) as window_start, count(*) as event_count from ev group by all)
    select service, window_start, window_start + interval '1 minute' as window_end, event_count, window_start + interval '70 seconds' as expires_at
    from w where window_start + interval '1 minute' > (select max(t) - interval '10 seconds' from ev)"""
SQL["stream_bulk_documents"] = f"""with {EV}
    select event_id::varchar as document_id, event_id::varchar as event_id, service, t as timestamp, true as within from ev"""
