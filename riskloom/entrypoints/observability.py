"""Observation and alert queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.entrypoints.inputs import feature, processed, typed
from riskloom.entrypoints.registry import query
from riskloom.entrypoints.streams import _ACCOUNTING, RUN, _basic_run, judged
from riskloom.functions.times import epoch_seconds
from riskloom.observe import alerts, observations
from riskloom.observe.collect import Collection, collect
from riskloom.operators.merge import late_merge_row
from riskloom.quality.rules import evaluate, not_null
from riskloom.schemas import BATCH_METRICS
from riskloom.session import work_folder
from riskloom.sinks import tables
from riskloom.sources import star_schema as star
from riskloom.sources.results import LOAD_STATUS, read_batch_metrics, read_load_status, tolerant
from riskloom.streaming import strict

_NOW = "2024-02-01 00:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp")


_JUDGED = """CASE WHEN value < low OR value > high THEN (CASE WHEN warn THEN 'WARN' ELSE 'FAIL' END) ELSE 'PASS' END AS status,
       CASE WHEN value < low OR value > high THEN (CASE WHEN warn THEN 'WARNING' ELSE 'CRITICAL' END) ELSE 'INFO' END AS severity"""


def _merchant_metrics(spark, d):
    """One metric per merchant: its fraud rate against 5 to 9 %; larger merchants only warn."""
    m = feature(spark, d, "merchant_risk_features")
    return m.select(
        F.lit("batch").alias("pipeline_name"),
        F.lit(RUN).alias("run_id"),
        F.col("merchant_id").alias("table_name"),
        F.lit("fraud_rate").alias("metric_name"),
        F.col("fraud_rate").alias("metric_value"),
        F.lit(0.05).alias("expected_min"),
        F.lit(0.09).alias("expected_max"),
        (F.col("transaction_count") > 450).alias("warn_only"),
    )


_MERCHANT = f"""SELECT merchant_id, value, {_JUDGED} FROM (
    SELECT merchant_id, fraud_rate AS value, CAST(0.05 AS DOUBLE) AS low, CAST(0.09 AS DOUBLE) AS high,
           transaction_count > 450 AS warn FROM merchant_features)"""


@query(
    "n1_range_checks",
    f"""SELECT 'batch' AS pipeline_name, 'run-1' AS run_id, merchant_id AS table_name, 'fraud_rate' AS metric_name,
               value AS metric_value, CAST(0.05 AS DOUBLE) AS expected_min, CAST(0.09 AS DOUBLE) AS expected_max, status, severity, '' AS details
        FROM ({_MERCHANT})""",
)
def n1(spark, d):
    return observations.check_range(_merchant_metrics(spark, d)).drop("observation_timestamp")


@query(
    "n2_freshness",
    f"""SELECT 'freshness_age_hours' AS metric_name,
               round(greatest(0, epoch_us(TIMESTAMP '{_NOW}') - epoch_us(MAX(CAST(ts AS TIMESTAMP)))) / 3600000000.0, 3) AS metric_value,
               CASE WHEN epoch_us(TIMESTAMP '{_NOW}') - epoch_us(MAX(CAST(ts AS TIMESTAMP))) > 24 * 3600000000 THEN 'FAIL' ELSE 'PASS' END AS status
        FROM events""",
)
def n2(spark, d):
    events = star.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    checked = observations.check_freshness(events, "ts", 24, "stream", RUN, "events", _now())
    return checked.select("metric_name", "metric_value", "status")


@query(
    "n4_table_observations",
    """SELECT metric_name, CAST(value AS DOUBLE) AS metric_value, CASE WHEN value != want THEN 'FAIL' ELSE 'PASS' END AS status FROM (
         SELECT 'row_count' AS metric_name, COUNT(*) AS value, 100350 AS want FROM tx
         UNION ALL SELECT 'duplicate_transaction_ids', COUNT(*) - COUNT(DISTINCT transaction_id), 0 FROM tx
         UNION ALL SELECT 'null_transaction_ids', COUNT(*) FILTER (WHERE transaction_id IS NULL), 0 FROM tx
         UNION ALL SELECT 'event_date_count', COUNT(DISTINCT event_date), 31 FROM tx)""",
)
def n4(spark, d):
    rows = star.transactions(spark, d, ["transaction_id", "event_date"])
    return observations.table_observations(rows, RUN, 100350, 31).select("metric_name", "metric_value", "status")


_STREAM_OBSERVED = f"""
    SELECT 'transaction_event_stream' AS pipeline_name, 'run-1' AS run_id, 'streaming_transaction_events' AS table_name, metric_name,
           CAST(value AS DOUBLE) AS metric_value, CAST(low AS DOUBLE) AS expected_min, CAST(high AS DOUBLE) AS expected_max,
           CASE WHEN value < low OR value > high THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN value < low OR value > high THEN 'CRITICAL' ELSE 'INFO' END AS severity, '' AS details
    FROM (SELECT 'clean_event_count' AS metric_name, clean_count AS value, 1 AS low, NULL AS high FROM ({_ACCOUNTING})
          UNION ALL SELECT 'invalid_event_rate', invalid_count / input_count, 0, 0.10 FROM ({_ACCOUNTING})
          UNION ALL SELECT 'reconciled_batches', 12 // 4, 12 // 4, 12 // 4
          UNION ALL SELECT 'schema_drift_count', schema_drift_count, 0, 0 FROM ({_ACCOUNTING}))"""


@query("n3_stream_observations", _STREAM_OBSERVED)
def n3(spark, d):
    metrics = read_batch_metrics(spark, _basic_run(spark, d).path("metrics"))
    return observations.stream_observations(metrics, RUN).drop("observation_timestamp")


@query(
    "n6_collected_observations",
    f"""{_STREAM_OBSERVED}
        UNION ALL SELECT 'models', 'run-1', 'check_results', 'failed_nodes', CAST(failed AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE),
                         CASE WHEN failed > 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN failed > 0 THEN 'CRITICAL' ELSE 'INFO' END,
                         'nodes_observed=2'
        FROM (SELECT CAST(COUNT(*) FILTER (WHERE transaction_id IS NULL) > 0 AS INTEGER)
                     + CAST(COUNT(*) FILTER (WHERE event_date IS NULL) > 0 AS INTEGER) AS failed FROM typed)
        UNION ALL SELECT 'stored_evidence', 'run-1', 'merge_evidence', 'duplicate_rows', CAST(n AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE),
                         CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'INFO' END, ''
        FROM (SELECT COUNT(*) - COUNT(DISTINCT transaction_id) AS n FROM tx)
        UNION ALL SELECT 'stored_evidence', 'run-1', 'scale_results', 'reconciled_scale_runs', CAST(1 AS DOUBLE), CAST(1 AS DOUBLE),
                         CAST(1 AS DOUBLE), 'PASS', 'INFO', '' FROM (SELECT COUNT(*) AS n FROM tx) WHERE n > 0
        UNION ALL SELECT 'warehouse', 'run-1', 'processed_transactions', 'collection_success', CAST(0 AS DOUBLE), CAST(1 AS DOUBLE),
                         CAST(1 AS DOUBLE), 'FAIL', 'CRITICAL', 'AnalysisException'""",
)
def n6(spark, d):
    """One collection over what runs have stored; the processed table is not there, which is an observation, too."""
    folder = work_folder(spark, "results")
    evaluate(typed(spark, d, "transaction_id"), "processed", [not_null("transaction_id"), not_null("event_date")]).write.json(f"{folder}/checks")
    tx = star.transactions(spark, d, ["transaction_id"])
    row = late_merge_row(tx.withColumn("amount", F.lit(1.0)), "-", "-", 1.0).first()
    tables.write_evidence(spark, {"event_date": "1998-07-04", **row.asDict()}, f"{folder}/merges")
    tables.write_evidence(spark, {"rows": tx.count(), "seconds": 1.0, "status": "PASSED"}, f"{folder}/scale")
    where = Collection(transactions=f"{folder}/absent", batch_metrics=_basic_run(spark, d).path("metrics"),
                       check_results=f"{folder}/checks", scale_results=f"{folder}/scale", merge_evidence=f"{folder}/merges")
    found = collect(spark, where, RUN, f"{folder}/observations").drop("observation_timestamp")
    return found.withColumn("details", F.regexp_extract("details", "^[^:]*", 0))


@query(
    "k17_load_status",
    """SELECT COUNT(*) > 0 AS success, CAST(COUNT(*) AS VARCHAR) AS details FROM processed
       UNION ALL SELECT COUNT(*) < 0, 'RuntimeError' FROM processed""",
)
def k17(spark, d):
    """A load that succeeds and one that fails, as their status rows tell."""
    folder = work_folder(spark, "loads")
    rows = processed(spark, d, "transaction_id")
    tables.with_status(spark, f"{folder}/good", rows.count)

    def failing():
        raise RuntimeError("the target is gone")

    try:
        tables.with_status(spark, f"{folder}/bad", failing)
    except RuntimeError:
        pass
    status = read_load_status(spark, f"{folder}/*")
    return status.select("success", F.regexp_extract("details", "^[^:]*", 0).alias("details"))


@query(
    "n7_alerts",
    f"""SELECT merchant_id AS table_name, severity, status, value AS metric_value FROM ({_MERCHANT}) WHERE status = 'FAIL'""",
)
def n7(spark, d):
    judged_rows = observations.check_range(_merchant_metrics(spark, d))
    found = alerts.evaluate_alerts(judged_rows, min_severity="CRITICAL")
    return found.select("table_name", "severity", "status", "metric_value")


_NOON = "TIMESTAMP '2024-01-10 12:00:00'"


@query(
    "n9_windowed_invalid_ratio",
    f"""SELECT CAST(COUNT(*) FILTER (WHERE len(errors) = 0) AS DOUBLE) AS valid_records,
               CAST(COUNT(*) FILTER (WHERE len(errors) > 0) AS DOUBLE) AS invalid_records,
               CAST(0 AS DOUBLE) AS sink_write_failures,
               CAST(COUNT(*) FILTER (WHERE len(errors) > 0) AS DOUBLE) / greatest(COUNT(*), 1) AS invalid_ratio
        FROM (SELECT errors, {_NOON} - to_seconds(COALESCE(CAST(floor(epoch(arrived_at)) AS BIGINT) % 3600, 0)) AS seen_at FROM strict)
        WHERE seen_at > {_NOON} - INTERVAL 5 MINUTES""",
)
def n9(spark, d):
    # Arrivals are dealt over the hour before; records without a readable one count at the window's end.
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    age = F.coalesce(F.floor(F.unix_micros("ingestion_timestamp") / 1_000_000) % 3600, F.lit(0))
    rows = strict.observation_rows(judged(spark, d), RUN, now - F.make_dt_interval(secs=age.cast("decimal(18,6)")))
    return alerts.window_counts(rows, now, 5)


_PER_MINUTE = """
    SELECT CAST(floor(epoch(arrived_at) / 60) AS BIGINT) AS minute, COUNT(*) FILTER (WHERE len(errors) = 0) AS valid,
           COUNT(*) FILTER (WHERE len(errors) > 0) AS invalid, COUNT(*) FILTER (WHERE list_contains(errors, 'invalid_amount')) AS failures
    FROM strict WHERE arrived_at IS NOT NULL GROUP BY minute"""


@query(
    "n9_windowed_alerts",
    f"""SELECT alert_name, severity, to_timestamp((since + hold) * 60) AT TIME ZONE 'UTC' AS fired_at,
               to_timestamp(last * 60) AT TIME ZONE 'UTC' AS ended_at
        FROM (SELECT alert_name, severity, hold, run, MIN(evaluated) AS since, MAX(evaluated) AS last
              FROM (SELECT *, evaluated - row_number() OVER (PARTITION BY alert_name ORDER BY evaluated) AS run
                    FROM (SELECT evaluated, unnest([
                            {{'alert_name': 'invalid_record_rate_high', 'severity': 'CRITICAL', 'hold': 5,
                              'firing': invalid_5 / greatest(valid_5 + invalid_5, 1) > 0.10}},
                            {{'alert_name': 'no_recent_valid_records', 'severity': 'WARNING', 'hold': 1,
                              'firing': valid_10 = 0 AND evaluated >= first_minute + 9}},
                            {{'alert_name': 'sink_write_failure', 'severity': 'CRITICAL', 'hold': 0, 'firing': failures_5 > 0}}], recursive := true)
                          FROM (SELECT evaluated, first_minute, COALESCE(SUM(valid) FILTER (WHERE minute > evaluated - 5), 0) AS valid_5,
                                       COALESCE(SUM(invalid) FILTER (WHERE minute > evaluated - 5), 0) AS invalid_5,
                                       COALESCE(SUM(failures) FILTER (WHERE minute > evaluated - 5), 0) AS failures_5,
                                       COALESCE(SUM(valid), 0) AS valid_10
                                FROM (SELECT first_minute, unnest(range(first_minute, last_minute + 1)) AS evaluated
                                      FROM (SELECT MIN(minute) AS first_minute, MAX(minute) AS last_minute FROM ({_PER_MINUTE})))
                                LEFT JOIN ({_PER_MINUTE}) ON minute BETWEEN evaluated - 9 AND evaluated
                                GROUP BY evaluated, first_minute))
                    WHERE firing)
              GROUP BY alert_name, severity, hold, run)
        WHERE last - since >= hold""",
)
def n9_alerts(spark, d):
    """Counters of a stream that is started anew every day, sampled each minute; a bad amount stands for a failed write."""
    seen = judged(spark, d).where("ingestion_timestamp is not null").select(
        F.date_trunc("minute", "ingestion_timestamp").alias("at"),
        F.explode(F.array_compact(F.array(
            F.when(strict.is_valid(), "valid_records").otherwise("invalid_records"),
            F.when(F.array_contains("errors", "invalid_amount"), "sink_write_failures")))).alias("metric_name"))
    counted = seen.groupBy(F.to_date("at").cast("string").alias("job"), "metric_name", "at").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("job", "metric_name").orderBy("at")
    samples = counted.withColumn("value", F.sum("n").over(so_far)).drop("n")
    return alerts.windowed_alerts(samples)


@query(
    "n10_alert_payloads",
    f"""SELECT 'FraudRate' AS alert_name, upper(severity) AS severity, 'FIRING' AS status, 'streaming_platform' AS pipeline_name,
               merchant_id AS table_name, 'FraudRate' AS metric_name, 'n/a' AS metric_value, '' AS summary, 'rate' AS details
        FROM ({_MERCHANT}) WHERE status != 'PASS'""",
)
def n10(spark, d):
    bad = observations.check_range(_merchant_metrics(spark, d)).where("status != 'PASS'")
    alert = F.struct(
        F.create_map(
            F.lit("alertname"), F.lit("FraudRate"), F.lit("severity"), F.lower("severity"), F.lit("table"), F.col("table_name")
        ).alias("labels"),
        F.create_map(F.lit("description"), F.lit("rate")).alias("annotations"),
    )
    payload = F.to_json(F.struct(F.lit("firing").alias("status"), F.array(alert).alias("alerts")))
    return alerts.normalize_alert_payload(bad.select(payload.alias("value"))).drop("alert_timestamp")


@query(
    "n8_gauge_alerts",
    """SELECT alert_name, severity, 'transaction_event_stream' AS pipeline_name
       FROM (SELECT COUNT(*) AS taken, COUNT(*) FILTER (WHERE NOT is_valid) AS invalid FROM bronze),
            (SELECT unnest([{'alert_name': 'NoRecentStreamingBatch', 'severity': 'WARNING'},
                            {'alert_name': 'StreamingReportsUnreadable', 'severity': 'WARNING'},
                            {'alert_name': 'StreamingDlqEventsDetected', 'severity': 'WARNING'},
                            {'alert_name': 'StreamingInvalidRecordRateHigh', 'severity': 'CRITICAL'}], recursive := true))
       WHERE CASE alert_name WHEN 'StreamingDlqEventsDetected' THEN invalid > 0
                             WHEN 'StreamingInvalidRecordRateHigh' THEN invalid / taken > 0.10 ELSE taken > 0 END""",
)
def n8(spark, d):
    """Reports of a finished run beside one that is cut off, looked at 400 seconds after the last batch."""
    folder = work_folder(spark, "reports")
    run = read_batch_metrics(spark, _basic_run(spark, d).path("metrics"))
    run.write.json(folder)
    spark.createDataFrame([('{"pipeline_name": "p", "batch_id": ',)], "value string").write.mode("append").text(folder)
    reports = tolerant(spark, folder, BATCH_METRICS)
    status = spark.createDataFrame([], LOAD_STATUS)
    checks = evaluate(processed(spark, d, "transaction_id"), "processed_transactions", [not_null("transaction_id")])
    last = run.agg(F.max(epoch_seconds("processing_timestamp"))).first()[0]
    return alerts.gauge_alerts(alerts.metric_gauges(reports, status, checks), F.timestamp_seconds(F.lit(last + 400)))
