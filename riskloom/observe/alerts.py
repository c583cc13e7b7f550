"""Alerts from observations, from gauges and from outside payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.times import epoch_seconds
from riskloom.operators.compare import union_all
from riskloom.sources.results import failed_checks

RANK = {"INFO": 0, "WARNING": 1, "CRITICAL": 2}


def severity_rank(severity: Column) -> Column:
    """0, 1 or 2; an unknown severity is an error."""
    rank = F.raise_error(F.concat(F.lit("unsupported severity: "), severity)).cast("int")
    for name, value in RANK.items():
        rank = F.when(severity == name, value).otherwise(rank)
    return rank


def alerting(observations: DataFrame, min_severity: str = "WARNING") -> DataFrame:
    """Observations that warn or fail at least at the given severity."""
    minimum = min_severity.upper()
    if minimum not in RANK:
        raise ValueError(f"unsupported minimum severity: {min_severity}")
    severity = F.upper(F.coalesce("severity", F.lit("INFO")))
    status = F.upper(F.coalesce("status", F.lit("PASS")))
    ranked = observations.withColumns({"severity": severity, "status": status, "_rank": severity_rank(severity)})
    # The rank stands first, so an unknown severity is found in every row.
    return ranked.where((F.col("_rank") >= RANK[minimum]) & F.col("status").isin("WARN", "FAIL")).drop("_rank")


def evaluate_alerts(*observations: DataFrame, min_severity: str = "WARNING", now: Column | None = None) -> DataFrame:
    """Alert rows of one or several observation tables."""
    rows = alerting(union_all(*observations), min_severity)
    unknown = F.lit("unknown")
    return rows.select(
        (F.current_timestamp() if now is None else now).alias("alert_timestamp"),
        "severity",
        "status",
        *[F.coalesce(n, unknown).alias(n) for n in ("pipeline_name", "table_name", "metric_name")],
        "metric_value",
        F.coalesce("details", F.lit("")).alias("details"),
    )


# --- gauges ---------------------------------------------------------------------------

_COUNTS = {
    "input_count": "streaming_input_events_total",
    "clean_count": "streaming_clean_events_total",
    "invalid_count": "streaming_invalid_events_total",
    "duplicate_count": "streaming_duplicate_events_total",
    "late_count": "streaming_late_events_total",
    "schema_drift_count": "streaming_schema_drift_events_total",
    "dlq_count": "streaming_dlq_events_total",
    "risk_alert_count": "streaming_risk_alert_events_total",
}


def metric_gauges(metrics: DataFrame, load_status: DataFrame, checks: DataFrame) -> DataFrame:
    """One row of gauges over batch metrics, load status and stream check results.

    Tables read tolerantly (`results.tolerant`) hold their unreadable documents as rows with `_broken` text;
    these are counted as a gauge and left out of all others.
    """
    n = F.count(F.lit(1))
    broken = [t.where("_broken is not null").select("_broken") for t in (metrics, load_status, checks) if "_broken" in t.columns]
    unreadable = union_all(*broken).agg(n.cast("double").alias("streaming_unreadable_documents")) if broken else None
    metrics, load_status, checks = (
        t.where("_broken is null").drop("_broken") if "_broken" in t.columns else t for t in (metrics, load_status, checks))
    batches = metrics.agg(
        (n > 0).cast("double").alias("streaming_batch_metrics_available"),
        n.cast("double").alias("streaming_batches_total"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(name) for c, name in _COUNTS.items()],
        F.count_if(~F.coalesce("reconciliation", F.lit(False))).cast("double").alias(
            "streaming_reconciliation_failures_total"
        ),
        F.coalesce(F.max(epoch_seconds("processing_timestamp")), F.lit(0)).cast("double").alias(
            "streaming_last_batch_timestamp_seconds"
        ),
        F.coalesce(F.max_by("processing_duration_seconds", "batch_id"), F.lit(0.0)).alias(
            "streaming_last_batch_duration_seconds"
        ),
    )
    ratio = F.try_divide("streaming_invalid_events_total", "streaming_input_events_total")
    batches = batches.withColumn("streaming_invalid_record_ratio", F.coalesce(ratio, F.lit(0.0)))
    newest = F.max_by("success", "observation_timestamp")
    load = load_status.agg(
        (n > 0).cast("double").alias("streaming_load_status_available"),
        F.coalesce(newest.cast("double"), F.lit(0.0)).alias("streaming_load_success"),
    )
    stream_checks = failed_checks(checks.where(F.lower("table_name").contains("streaming"))).select(
        (F.col("checks_observed") > 0).cast("double").alias("streaming_test_results_available"),
        F.col("checks_failed").cast("double").alias("streaming_test_failures"),
    )
    # One-row tables side by side.
    gauges = batches.crossJoin(load).crossJoin(stream_checks)
    return gauges.withColumn("streaming_unreadable_documents", F.lit(0.0)) if unreadable is None else gauges.crossJoin(unreadable)


# Alert name -> severity, pipeline, condition over the gauges (`now` is epoch seconds).
GAUGE_RULES = {
    "NoStreamingBatchMetrics": (
        "WARNING", "transaction_event_stream", "streaming_batch_metrics_available = 0",
    ),
    "NoRecentStreamingBatch": (
        "WARNING", "transaction_event_stream",
        "streaming_batch_metrics_available = 1 and now - streaming_last_batch_timestamp_seconds > 300",
    ),
    "StreamingInvalidRecordRateHigh": (
        "CRITICAL", "transaction_event_stream", "streaming_invalid_record_ratio > 0.10",
    ),
    "StreamingDlqEventsDetected": (
        "WARNING", "transaction_event_stream", "streaming_dlq_events_total > 0",
    ),
    "StreamingLoadFailed": (
        "CRITICAL", "streaming_load", "streaming_load_status_available = 1 and streaming_load_success = 0",
    ),
    "StreamingTestsFailed": (
        "CRITICAL", "streaming_models", "streaming_test_results_available = 1 and streaming_test_failures > 0",
    ),
    "StreamingReportsUnreadable": (
        "WARNING", "transaction_event_stream", "streaming_unreadable_documents > 0",
    ),
    "StreamingDataFreshnessMissed": (
        "CRITICAL", "transaction_event_stream",
        "streaming_batch_metrics_available = 1 and now - streaming_last_batch_timestamp_seconds > 900",
    ),
}


def gauge_alerts(gauges: DataFrame, now: Column | None = None, rules: dict | None = None) -> DataFrame:
    """Alerts whose condition holds for the gauge row."""
    current = F.unix_timestamp(F.current_timestamp() if now is None else now)
    entries = [
        F.struct(
            F.lit(name).alias("alert_name"), F.lit(severity).alias("severity"),
            F.lit(pipeline).alias("pipeline_name"), F.expr(condition).alias("firing"),
        )
        for name, (severity, pipeline, condition) in (rules or GAUGE_RULES).items()
    ]
    judged = gauges.withColumn("now", current).select(F.explode(F.array(*entries)).alias("r")).select("r.*")
    return judged.where("firing").drop("firing")


# --- observation windows --------------------------------------------------------------------


def window_counts(observations: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Valid, invalid and write-failure records of the last minutes, and the invalid ratio."""
    recent = observations.where(
        (F.col("observation_timestamp") > now - F.make_dt_interval(mins=F.lit(minutes)))
        & (F.col("observation_timestamp") <= now)
    )

    def records(metric: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("metric_name") == metric, F.col("metric_value"))), F.lit(0.0))

    counted = recent.agg(
        records("valid_records").alias("valid_records"),
        records("invalid_records").alias("invalid_records"),
        records("sink_write_failures").alias("sink_write_failures"),
    )
    all_records = F.greatest(F.col("valid_records") + F.col("invalid_records"), F.lit(1.0))
    return counted.withColumn("invalid_ratio", F.col("invalid_records") / all_records)


def increases(samples: DataFrame) -> DataFrame:
    """Samples (job, metric_name, at, value) of counters that only grow, with what each grew by since the one before.

    A job's counters begin at zero; a value below the one before means that they began anew.
    """
    series = W.partitionBy("job", "metric_name").orderBy("at", "value")
    before = F.coalesce(F.lag("value").over(series), F.lit(0))
    return samples.withColumn("increase", F.when(F.col("value") >= before, F.col("value") - before).otherwise(F.col("value")))


# Alert name -> severity, minutes it has to hold before it fires (fixed values), condition at an evaluation.
WINDOW_RULES = {
    "invalid_record_rate_high": ("CRITICAL", 5, "invalid_5 / greatest(valid_5 + invalid_5, 1) > {ratio}"),
    "no_recent_valid_records": ("WARNING", 1, "valid_10 = 0 and evaluated >= first_minute + 9"),
    "sink_write_failure": ("CRITICAL", 0, "failures_5 > 0"),
}


def window_sums(samples: DataFrame) -> DataFrame:
    """Per minute from the first sample to the last: what the counters grew by in the last five and ten minutes.

    Every minute is sent to the ten evaluations that look back on it, so no task sees the whole time line.
    """
    def grown(metric: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("metric_name") == metric, F.col("increase"))), F.lit(0))

    per_minute = increases(samples).groupBy(F.floor(F.unix_timestamp("at") / 60).cast("long").alias("minute")).agg(
        grown("valid_records").alias("valid"), grown("invalid_records").alias("invalid"),
        grown("sink_write_failures").alias("failures"),
    )
    seen_from = per_minute.withColumn("evaluated", F.explode(F.sequence(F.col("minute"), F.col("minute") + 9)))
    recent = F.col("evaluated") - F.col("minute") < 5
    sums = seen_from.groupBy("evaluated").agg(
        F.sum(F.when(recent, F.col("valid"))).alias("valid_5"), F.sum(F.when(recent, F.col("invalid"))).alias("invalid_5"),
        F.sum(F.when(recent, F.col("failures"))).alias("failures_5"), F.sum("valid").alias("valid_10"),
    )
    span = per_minute.agg(F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute")).where("first_minute is not null")
    grid = span.select("first_minute", F.explode(F.sequence("first_minute", "last_minute")).alias("evaluated"))
    return grid.join(sums, "evaluated", "left").fillna(0)


def windowed_alerts(samples: DataFrame, max_ratio: float = 0.10) -> DataFrame:
    """Each time a rule fired: alert_name, severity, fired_at, ended_at (its last evaluation that held).

    Rules are evaluated every minute: too many invalid records in five minutes, no valid one in ten, any write
    failure in five.  A rule fires once it has held for its minutes, and once for as long as it holds.
    """
    rules = [
        F.struct(F.lit(name).alias("alert_name"), F.lit(severity).alias("severity"), F.lit(hold).alias("hold"),
                 F.expr(condition.format(ratio=max_ratio)).alias("firing"))
        for name, (severity, hold, condition) in WINDOW_RULES.items()
    ]
    holds = window_sums(samples).select("evaluated", F.explode(F.array(*rules)).alias("r")).select("evaluated", "r.*").where("firing")
    # Minutes without a gap share the difference of minute and row number; there is one row per rule and minute.
    run = F.col("evaluated") - F.row_number().over(W.partitionBy("alert_name").orderBy("evaluated"))
    runs = holds.withColumn("run", run).groupBy("alert_name", "severity", "hold", "run").agg(
        F.min("evaluated").alias("since"), F.max("evaluated").alias("last"))
    moment = lambda minute: F.timestamp_seconds(minute * 60)
    return runs.where("last - since >= hold").select(
        "alert_name", "severity", moment(F.col("since") + F.col("hold")).alias("fired_at"), moment(F.col("last")).alias("ended_at"))


# --- outside payloads --------------------------------------------------------------------------

_PAYLOAD = (
    "struct<status:string,alerts:array<struct<status:string,labels:map<string,string>,annotations:map<string,string>>>>"
)


def normalize_alert_payload(payloads: DataFrame, column: str = "value", now: Column | None = None) -> DataFrame:
    """Ten flat columns per alert of a JSON payload, with defaults for what is absent."""
    read = payloads.select(F.from_json(column, _PAYLOAD).alias("p"))
    each = read.select(F.col("p.status").alias("outer_status"), F.explode("p.alerts").alias("a"))

    def label(name: str, default: Column | str) -> Column:
        return F.coalesce(F.col("a.labels")[name], default if isinstance(default, Column) else F.lit(default))

    def note(name: str, default: str) -> Column:
        return F.coalesce(F.col("a.annotations")[name], F.lit(default))

    return each.select(
        (F.current_timestamp() if now is None else now).alias("alert_timestamp"),
        label("alertname", "unknown").alias("alert_name"),
        F.upper(label("severity", "WARNING")).alias("severity"),
        F.upper(F.coalesce("a.status", "outer_status", F.lit("firing"))).alias("status"),
        label("pipeline", "streaming_platform").alias("pipeline_name"),
        label("table", "streaming_transaction_events").alias("table_name"),
        label("metric", label("alertname", "unknown")).alias("metric_name"),
        note("value", "n/a").alias("metric_value"),
        note("summary", "").alias("summary"),
        note("description", "").alias("details"),
    )
