"""Incident reports: anomalies in small batches, written up by fixed rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.events import or_unknown
from tidewatch.operators.ordering import count_earlier, number_within
from tidewatch.operators.similar import count_similar_earlier
from tidewatch.settings import DEFAULTS, Settings, seconds

BATCH = ["batch_window", "batch_no"]
_TIME = "yyyy-MM-dd HH:mm:ss"

# The sections of a report and their order.
HEADING = "## Anomaly Report — "
SECTIONS = ["Type", "Affected services", "Window", "Impact", "Root cause hypothesis", "Recommended action", "Confidence"]


def report_batches(found: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Numbers anomalies into batches: at most ``report_batch`` records of one time window.

    Inside a window records are ordered by second, service, type and key; a digest of the key keeps
    even a window that holds most of all anomalies divisible.
    """
    keyed = (
        found.withColumn("batch_window", F.window("detected_at", seconds(cfg.report_window_s)).getField("start"))
        .withColumn("second", F.date_trunc("second", "detected_at"))
        .withColumn("named", or_unknown("service"))
        .withColumn("kind", or_unknown("anomaly_type"))
        .withColumn("spread", F.substring(F.md5(F.coalesce("session_key", F.lit(""))), 1, 2))
    )
    numbered = number_within(keyed, ["batch_window"], ["second", "named", "kind", "spread"],
                             ["detected_at", "window_start", "session_key"])
    batch_no = F.floor((F.col("position") - 1) / cfg.report_batch).cast("long")
    return numbered.withColumn("batch_no", batch_no).drop("second", "named", "kind", "spread")


def _named(found: DataFrame) -> DataFrame:
    return found.withColumns({c: or_unknown(c) for c in ("service", "anomaly_type")})


def prior_incidents(found: DataFrame, history: DataFrame | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """Adds ``prior_count``: earlier anomalies of the same service and type.

    ``history`` holds stored anomalies, ``earlier`` their counts ``n`` per service and type; both are counted too.
    """
    keys = ["service", "anomaly_type"]
    history = None if history is None else _named(history)
    out = count_earlier(_named(found), keys, "detected_at", "prior_count", history)
    if earlier is None:
        return out
    n = _named(earlier).groupBy(*keys).agg(F.sum("n").alias("_n"))
    return out.join(n, keys, "left").withColumn(
        "prior_count", F.col("prior_count") + F.coalesce("_n", F.lit(0))).drop("_n")


def incident_features(batches: DataFrame) -> DataFrame:
    """The items that describe each numbered batch: types, services, severities, types at services, and services that fell silent."""
    kind, where = or_unknown("anomaly_type"), or_unknown("service")
    items = F.array(
        F.concat(F.lit("type:"), kind), F.concat(F.lit("service:"), where), F.concat(kind, F.lit("@"), where),
        F.concat(F.lit("severity:"), "severity"), F.when(F.col("drop_pct") >= 100, F.concat(F.lit("silent:"), where)))
    return batches.withColumn("item", F.explode(items)).groupBy(*BATCH).agg(
        F.max("detected_at").alias("detected_at"), F.array_sort(F.collect_set("item")).alias("features"))


def similar_incidents(found: DataFrame, cfg: Settings = DEFAULTS, percent: int = 50) -> DataFrame:
    """``similar_count`` of each batch: earlier batches that share at least ``percent`` % of all the features of both."""
    return count_similar_earlier(incident_features(report_batches(found, cfg)), "features", "detected_at", percent)


def missed_events(found: DataFrame) -> DataFrame:
    """Events that throughput drops lost against the window before, per service."""
    drops = found.where(F.col("anomaly_type") == "throughput_drop")
    return drops.groupBy("service").agg(
        F.sum(F.col("prev_event_count") - F.col("event_count")).alias("missed_events"),
        F.count(F.lit(1)).alias("drop_count"))


def record_json(columns: list[str]) -> Column:
    """A batch's records as one JSON array in time order, times as text, nulls kept."""
    fields = [F.col(c) for c in columns]
    ordered = F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).alias("record"))))
    return F.to_json(F.transform(ordered, lambda r: r["record"]), {"ignoreNullFields": "false"})


def batch_prompts(batches: DataFrame) -> DataFrame:
    """The request text of each batch: its records as JSON and the sections wanted."""
    text = batches.select(
        *BATCH, "position", "detected_at", or_unknown("service").alias("service"), "anomaly_type",
        *[F.date_format(c, _TIME).alias(f"{c}_text") for c in ("window_start", "window_end", "detected_at")],
        "event_count", "prev_event_count", "error_count", "severity", "session_key",
    )
    columns = ["service", "anomaly_type", "window_start_text", "window_end_text", "detected_at_text",
               "event_count", "prev_event_count", "error_count", "severity", "session_key"]
    grouped = text.groupBy(*BATCH).agg(
        F.count(F.lit(1)).cast("int").alias("anomaly_count"),
        F.max("detected_at").alias("detected_at"), record_json(columns).alias("records_json"))
    when = F.date_format("detected_at", _TIME)
    prompt = F.concat(
        F.col("anomaly_count").cast("string"), F.lit(" anomaly records, newest "), when, F.lit(" UTC:\n"), F.col("records_json"),
        F.lit(f"\nFill in this form:\n{HEADING}"), when, F.lit("".join(f"\n**{name}:**" for name in SECTIONS)),
    )
    return grouped.withColumn("prompt", prompt)


def _whole(value: Column) -> Column:
    return F.round(value).cast("long").cast("string")


def _cause() -> Column:
    """What the records say: a service without any event, or with fewer; the largest rise of the p99; flagged sessions."""
    return F.concat_ws(
        "; ",
        F.when(F.col("drop_pct") >= 100, "a service sends nothing").when(F.col("drop_pct").isNotNull(), "a service sends less"),
        F.concat(F.lit("latency rose to "), _whole(100 * F.col("rise")), F.lit(" % of its level")),
        F.concat(F.col("flagged").cast("string"), F.lit(" sessions with errors or slow calls")),
    )


def _action() -> Column:
    """One step for each kind of record: for all services if several are hit, else for the one."""
    where = F.when(F.size("services") > 1, "what these services share").otherwise(F.element_at("services", 1))
    return F.concat_ws(
        "; ",
        F.when(F.col("drop_pct").isNotNull(), F.concat(F.lit("follow the missing events of "), where)),
        F.when(F.col("rise").isNotNull(), F.concat(F.lit("trace slow calls of "), where)),
        F.when(F.col("flagged").isNotNull(), F.lit("read the flagged sessions")),
    )


def report_docs(found: DataFrame, cfg: Settings = DEFAULTS, history: DataFrame | None = None,
                earlier: DataFrame | None = None) -> DataFrame:
    """One summary document per batch; no anomalies, no report. Records that are in numbered batches stay in them."""
    batches = prior_incidents(found, history, earlier)
    if "batch_no" not in found.columns:
        batches = report_batches(batches, cfg)
    drop = F.col("anomaly_type") == "throughput_drop"
    facts = batches.groupBy(*BATCH).agg(
        F.count(F.lit(1)).cast("int").alias("anomaly_count"),
        F.array_sort(F.collect_set(or_unknown("service"))).alias("services"),
        F.array_sort(F.collect_set(or_unknown("anomaly_type"))).alias("anomaly_types"),
        F.max("detected_at").alias("generated_at"),
        F.min("window_start").alias("since"),
        F.max("window_end").alias("until"),
        F.sum(F.when(drop, F.col("prev_event_count") - F.col("event_count"))).alias("missed"),
        F.max("drop_pct").alias("drop_pct"),
        F.max("p99_latency_ms").alias("p99"),
        F.max(F.col("p99_latency_ms") / F.col("baseline_p99")).alias("rise"),
        F.sum(F.when(F.col("anomaly_type") == "session_anomaly", 1)).alias("flagged"),
        F.coalesce(F.sum("error_count"), F.lit(0)).alias("errors"),
        F.max("prior_count").alias("prior"),
    )
    types = F.col("anomaly_types")
    impact = F.concat_ws(
        "; ",
        F.concat(F.col("missed").cast("string"), F.lit(" events fewer than in the windows before (at most "),
                 _whole(F.col("drop_pct")), F.lit(" % less)")),
        F.concat(F.lit("p99 latency up to "), _whole(F.col("p99")), F.lit(" ms")),
        F.concat(F.col("errors").cast("string"), F.lit(" server errors")),
    )
    confidence = F.when(F.col("prior") >= 3, "High").when(F.col("prior") >= 1, "Medium").otherwise("Low")
    window = F.concat(F.date_format("since", _TIME), F.lit(" to "), F.date_format("until", _TIME), F.lit(" UTC"))
    certainty = F.concat(confidence, F.lit("; earlier incidents of the kind: "), F.col("prior").cast("string"))
    content = [F.array_join(types, ", "), F.array_join("services", ", "), window, impact, _cause(), _action(), certainty]
    summary = F.concat_ws(
        "\n", F.concat(F.lit(HEADING), F.date_format("generated_at", _TIME), F.lit(" UTC")),
        *[F.concat(F.lit(f"**{name}:** "), text) for name, text in zip(SECTIONS, content, strict=True)])
    return facts.select(
        summary.alias("summary"), "anomaly_count", "services", "anomaly_types", "generated_at",
        F.lit(cfg.report_model).alias("model"))
