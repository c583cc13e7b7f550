"""Streaming queries: contract functions on all records, and real streams over them."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from riskloom.entrypoints.inputs import stored, table_once
from riskloom.entrypoints.oracle import CTES
from riskloom.entrypoints.registry import query
from riskloom.functions.times import is_late, is_late_whole_hours
from riskloom.operators import merge
from riskloom.operators.clean import dedup_latest
from riskloom.operators.compare import file_inventory, inventory_diff
from riskloom.plans import models
from riskloom.quality import rulesets
from riskloom.schemas import BRONZE, SILVER
from riskloom.session import work_folder
from riskloom.sources import star_schema as star
from riskloom.sources.events import SourceSpec, decode_records, read_events_jsonl
from riskloom.sources.results import read_batch_metrics
from riskloom.streaming import basic, metrics, runner, strict
from riskloom.streaming.live import LiveCounters

TYPES = star.EVENT_TYPES
LIMIT = star.EVENT_THRESHOLD
RUN = "run-1"

_BRONZE = ", ".join(BRONZE.fieldNames())
_SILVER = ", ".join(n for n in SILVER.fieldNames() if not n.startswith("processing_"))


def decoded(spark, d):
    return decode_records(star.event_records(spark, d))


def bronze(spark, d):
    return basic.mark(basic.type_events(basic.parse_events(decoded(spark, d))), TYPES)


def silver(spark, d):
    return basic.stamp_batch(basic.dedup_in_batch(basic.split_valid(bronze(spark, d))[0]), 0, RUN)


def stg(spark, d):
    return models.stg_stream(silver(spark, d), "local")


def judged(spark, d):
    return strict.judge(star.event_records(spark, d), TYPES)


# --- basic profile -------------------------------------------------------------------------


@query("p6_decode_records", "SELECT * FROM records")
def p6(spark, d):
    return decoded(spark, d)


@query("p7_parse_events", "SELECT * FROM parsed")
def p7(spark, d):
    return basic.parse_events(decoded(spark, d))


@query("p8_type_events", "SELECT * FROM typed_events")
def p8(spark, d):
    return basic.type_events(basic.parse_events(decoded(spark, d)))


@query("f5_basic_validity", f"SELECT {_BRONZE} FROM bronze")
def f5(spark, d):
    return bronze(spark, d)


@query("f6_invalid_split", f"SELECT {_BRONZE} FROM bronze WHERE NOT is_valid")
def f6(spark, d):
    return basic.split_valid(bronze(spark, d))[1]


@query("f7_risk_alerts", f"SELECT {_SILVER} FROM silver WHERE amount >= 200")
def f7(spark, d):
    return basic.risk_alerts(silver(spark, d), LIMIT).drop("processing_batch_id", "processing_run_id")


@query("f17_schema_drift", "SELECT kafka_offset, unexpected_field_count FROM bronze WHERE unexpected_field_count > 0")
def f17(spark, d):
    return basic.drifted(bronze(spark, d)).select("kafka_offset", "unexpected_field_count")


_TIMES = "SELECT kafka_offset, event_timestamp < ingestion_timestamp - INTERVAL 24 HOURS AS is_late FROM typed_events"


@query("f10a_late_exact", _TIMES)
def f10a(spark, d):
    return bronze(spark, d).select("kafka_offset", is_late(24).alias("is_late"))


@query(
    "f10b_late_whole_hours",
    "SELECT kafka_offset, datesub('hour', event_timestamp, ingestion_timestamp) > 24 AS is_late FROM typed_events",
)
def f10b(spark, d):
    return bronze(spark, d).select("kafka_offset", is_late_whole_hours(24).alias("is_late"))


@query("t6_late_events_kept", "SELECT is_late, COUNT(*) AS events FROM silver GROUP BY is_late")
def t6(spark, d):
    return silver(spark, d).groupBy("is_late").agg(F.count(F.lit(1)).alias("events"))


@query("d2_dedup_in_batch", f"SELECT {_SILVER} FROM silver")
def d2(spark, d):
    return basic.dedup_in_batch(basic.split_valid(bronze(spark, d))[0]).select(*_SILVER.split(", "))


@query(
    "p9_stamp_batch",
    f"SELECT {_SILVER}, CAST(0 AS BIGINT) AS processing_batch_id, 'run-1' AS processing_run_id FROM silver",
)
def p9(spark, d):
    return silver(spark, d)


@query(
    "k6_dead_letters",
    "SELECT transaction_id AS key, raw_json AS value FROM bronze WHERE NOT is_valid",
)
def k6(spark, d):
    return basic.as_messages(basic.split_valid(bronze(spark, d))[1])


@query("k7_risk_messages", "SELECT transaction_id AS key, raw_json AS value FROM silver WHERE amount >= 200")
def k7(spark, d):
    return basic.as_messages(basic.risk_alerts(silver(spark, d), LIMIT))


# --- strict profile ----------------------------------------------------------------------------


@query("f8_strict_errors", "SELECT raw_json AS raw_payload, array_to_string(errors, ';') AS errors FROM strict")
def f8(spark, d):
    return judged(spark, d).select("raw_payload", F.array_join("errors", ";").alias("errors"))


@query(
    "f9_decode_routing",
    """SELECT CASE WHEN NOT is_json THEN 'invalid_json' WHEN NOT is_object THEN 'event_not_json_object' ELSE 'object' END AS route,
              COUNT(*) AS records FROM json_kind GROUP BY route""",
)
def f9(spark, d):
    first = F.get("errors", F.lit(0))
    route = F.when(first.isin("invalid_json", "event_not_json_object"), first).otherwise("object")
    return judged(spark, d).groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("records"))


_AT = "TIMESTAMP '2026-01-01 00:00:00'"


def _at():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


_STRICT_EVENT = (
    "transaction_id, event_timestamp, ingestion_timestamp, customer_id, merchant_id, amount, currency, country, "
    "merchant_category, payment_method, device_id, event_type, event_date, event_hour, run_id, source_system, validation_status"
)


@query("p11_valid_rows", f"SELECT {_STRICT_EVENT}, {_AT} AS processing_timestamp FROM strict_valid")
def p11(spark, d):
    return strict.valid_rows(judged(spark, d), RUN, _at())


@query(
    "p12_quarantine_rows",
    f"""SELECT raw_json AS raw_payload, array_to_string(errors, ';') AS error_reason,
               CASE WHEN starts_with(errors[1], 'missing_') THEN substr(errors[1], 9)
                    WHEN starts_with(errors[1], 'invalid_') THEN substr(errors[1], 9)
                    WHEN starts_with(errors[1], 'unexpected_fields:') THEN split_part(substr(errors[1], 19), ',', 1)
                    WHEN errors[1] = 'event_timestamp_after_ingestion_timestamp' THEN 'event_timestamp' END AS error_field,
               arrived_at AS ingestion_timestamp, {_AT} AS processing_timestamp, 'run-1' AS run_id
        FROM strict WHERE len(errors) > 0""",
)
def p12(spark, d):
    return strict.quarantine_rows(judged(spark, d), RUN, _at())


_OBSERVED = f"""SELECT {_AT} AS observation_timestamp, 'run-1' AS run_id,
       CASE WHEN len(errors) = 0 THEN 'valid_records' ELSE 'invalid_records' END AS metric_name,
       CAST(1 AS DOUBLE) AS metric_value, CASE WHEN len(errors) = 0 THEN 'PASS' ELSE 'WARN' END AS status,
       CASE WHEN len(errors) = 0 THEN 'INFO' ELSE 'WARNING' END AS severity,
       array_to_string(errors, ',') AS details FROM strict"""


@query("p13_observation_rows", _OBSERVED)
def p13(spark, d):
    return strict.observation_rows(judged(spark, d), RUN, _at())


@query(
    "t11_observation_counts",
    """SELECT CASE WHEN len(errors) = 0 THEN 'valid_records' ELSE 'invalid_records' END AS metric_name, COUNT(*) AS records
       FROM strict GROUP BY metric_name""",
)
def t11(spark, d):
    return strict.counters(strict.observation_rows(judged(spark, d), RUN))


@query(
    "a21_quarantine_triage",
    """SELECT array_to_string(errors, ';') AS error_reason,
              CASE WHEN regexp_matches(errors[1], '^(missing|invalid)_') THEN regexp_replace(errors[1], '^(missing|invalid)_', '')
                   WHEN starts_with(errors[1], 'unexpected_fields:') THEN regexp_extract(errors[1], '^unexpected_fields:([^,]*)', 1)
                   WHEN errors[1] = 'event_timestamp_after_ingestion_timestamp' THEN 'event_timestamp' END AS error_field,
              'run-1' AS run_id, COUNT(*) AS records
       FROM strict WHERE len(errors) > 0 GROUP BY ALL""",
)
def a21(spark, d):
    from riskloom.observe.observations import quarantine_triage

    rows = strict.quarantine_rows(judged(spark, d), RUN)
    return quarantine_triage(rows)


@query(
    "k13_sink_failures",
    """SELECT 'sink_write_failure' AS error_reason, COUNT(*) AS records FROM strict_valid WHERE amount > 250
       UNION ALL SELECT 'stored', COUNT(*) FROM strict_valid WHERE amount <= 250""",
)
def k13(spark, d):
    # A required column without a value for larger amounts: the table cannot hold those rows.
    rows = strict.valid_rows(judged(spark, d), RUN, _at())
    rows = rows.withColumn("device_id", F.when(F.col("amount") <= 250, F.col("device_id")))
    kept, quarantine, _ = strict.route_sink_failures(rows, runner.STRICT_EVENT, runner.STRICT_REQUIRED["events"], RUN, _at())
    both = strict.flatten(quarantine.select("error_reason"), kept.select(F.lit("stored").alias("error_reason")))
    return both.groupBy("error_reason").agg(F.count(F.lit(1)).alias("records"))


@query(
    "u2_flatten_flows",
    """SELECT metric_name, COUNT(*) AS records FROM (
         SELECT CASE WHEN len(errors) = 0 THEN 'valid_records' ELSE 'invalid_records' END AS metric_name FROM strict
         UNION ALL SELECT 'sink_write_failures' FROM strict_valid WHERE amount > 250) GROUP BY metric_name""",
)
def u2(spark, d):
    j = judged(spark, d)
    rows = strict.valid_rows(j, RUN, _at())
    rows = rows.withColumn("device_id", F.when(F.col("amount") <= 250, F.col("device_id")))
    failures = strict.route_sink_failures(rows, runner.STRICT_EVENT, runner.STRICT_REQUIRED["events"], RUN, _at())[2]
    flows = strict.flatten(strict.observation_rows(j, RUN, _at()), failures)
    return flows.groupBy("metric_name").agg(F.count(F.lit(1)).alias("records"))


# --- staging and marts ----------------------------------------------------------------------------


@query("p4_stg_local", "SELECT * FROM stg_local")
def p4(spark, d):
    return stg(spark, d)


@query(
    "p5_stg_strict",
    f"""SELECT transaction_id, event_timestamp, event_date, event_hour, customer_id, merchant_id, amount, currency, country,
              merchant_category, payment_method, device_id, event_type, ingestion_timestamp,
              datesub('hour', event_timestamp, ingestion_timestamp) > 24 AS is_late, CAST(NULL AS BIGINT) AS processing_batch_id,
              run_id AS processing_run_id, run_id, source_system, validation_status, {_AT} AS processing_timestamp
       FROM strict_valid""",
)
def p5(spark, d):
    return models.stg_stream(strict.valid_rows(judged(spark, d), RUN, _at()), "strict")


@query("f4_staging_filter", "SELECT transaction_id, amount FROM typed_events WHERE transaction_id IS NOT NULL AND amount > 0")
def f4(spark, d):
    return models.stg_stream_filter(bronze(spark, d)).select("transaction_id", "amount")


_ROUNDED = """CAST(round(CAST(SUM(CAST(amount AS DECIMAL(22,4))) AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_amount,
       CAST(round(CAST(CAST(SUM(CAST(amount AS DECIMAL(22,4))) AS DOUBLE) / COUNT(amount) AS DECIMAL(38,10)), 2) AS DOUBLE)
           AS average_amount"""
CTES["trends"] = f"""
SELECT event_date, event_hour, event_type, COUNT(*) AS event_count,
       COUNT(*) FILTER (WHERE amount >= 200) AS high_value_event_count, {_ROUNDED},
       COUNT(DISTINCT customer_id) AS unique_customers, MAX(processing_timestamp) AS latest_processing_timestamp
FROM stg_local GROUP BY event_date, event_hour, event_type"""
CTES["quality"] = """
SELECT event_date, COUNT(*) AS event_count, COUNT(*) FILTER (WHERE transaction_id IS NULL) AS null_transaction_id_count,
       COUNT(*) FILTER (WHERE amount IS NULL OR amount <= 0 OR amount > 1000000) AS invalid_amount_count,
       COUNT(*) FILTER (WHERE is_late) AS late_event_count, COUNT(DISTINCT processing_batch_id) AS processing_batch_count,
       COUNT(DISTINCT processing_run_id) AS processing_run_count,
       CAST(round(CAST(CAST(SUM(datesub('second', event_timestamp, ingestion_timestamp)) AS DOUBLE) / COUNT(*) AS DECIMAL(38,10)), 2) AS DOUBLE)
           AS average_ingestion_delay_seconds,
       MAX(ingestion_timestamp) AS latest_ingestion_timestamp
FROM stg_local GROUP BY event_date"""
CTES["summary"] = f"""
SELECT event_date, COUNT(*) AS event_count, COUNT(*) FILTER (WHERE is_late) AS late_event_count,
       COUNT(*) FILTER (WHERE amount >= 200) AS high_value_event_count, {_ROUNDED},
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT merchant_id) AS unique_merchants
FROM stg_local GROUP BY event_date"""


@query("a9_realtime_trends", "SELECT * FROM trends")
def a9(spark, d):
    return models.realtime_trends(stg(spark, d), LIMIT)


@query("a10_event_quality", "SELECT * FROM quality")
def a10(spark, d):
    return models.event_quality(stg(spark, d))


@query("a11_streaming_summary", "SELECT * FROM summary")
def a11(spark, d):
    return models.streaming_risk_summary(stg(spark, d), LIMIT)


def _disturbed(mart):
    """A mart in which counts divisible by three are one too high and busy rows are missing."""
    return mart.where("event_count % 10 != 0").withColumn(
        "event_count", F.when(F.col("event_count") % 3 == 0, F.col("event_count") + 1).otherwise(F.col("event_count"))
    )


@query("j3_trend_reconciliation", "SELECT event_date, event_hour, event_type FROM trends WHERE event_count % 3 = 0 OR event_count % 10 = 0")
def j3(spark, d):
    staged = stg(spark, d)
    return rulesets.reconcile_trends(staged, _disturbed(models.realtime_trends(staged, LIMIT)))


@query(
    "j4_quality_reconciliation",
    """SELECT event_date, event_count AS expected_event_count,
              CASE WHEN event_count % 10 = 0 THEN NULL ELSE event_count + 1 END AS event_count
       FROM quality WHERE event_count % 3 = 0 OR event_count % 10 = 0""",
)
def j4(spark, d):
    staged = stg(spark, d)
    return rulesets.reconcile_quality(staged, _disturbed(models.event_quality(staged)))


@query(
    "q10g_stream_marts_reconcile",
    """SELECT * FROM (SELECT CAST(COUNT(*) AS INTEGER) AS trend_rows FROM trends WHERE event_count % 3 = 0 OR event_count % 10 = 0),
                     (SELECT CAST(COUNT(*) AS INTEGER) AS quality_rows FROM quality WHERE event_count % 3 = 0 OR event_count % 10 = 0),
                     (SELECT CAST(COUNT(*) AS INTEGER) AS summary_rows FROM summary WHERE event_count % 3 = 0 AND event_count % 10 != 0)""",
)
def q10g(spark, d):
    """Rows that the three reconciliations find in disturbed marts; the summary's looks at the mart's own dates only."""
    staged = stg(spark, d)
    found = {
        "trend_rows": rulesets.reconcile_trends(staged, _disturbed(models.realtime_trends(staged, LIMIT))),
        "quality_rows": rulesets.reconcile_quality(staged, _disturbed(models.event_quality(staged))),
        "summary_rows": rulesets.reconcile_summary(staged, _disturbed(models.streaming_risk_summary(staged, LIMIT))),
    }
    rows = [frame.agg(F.count(F.lit(1)).cast("int").alias(name)) for name, frame in found.items()]
    return rows[0].crossJoin(rows[1]).crossJoin(rows[2])


@query("q10f_bad_amounts", "SELECT transaction_id FROM typed_events WHERE amount <= 0 OR amount > 1000000")
def q10f_amounts(spark, d):
    return rulesets.bad_amounts(bronze(spark, d))


@query("q10f_impossible_times", "SELECT transaction_id FROM typed_events WHERE event_timestamp > ingestion_timestamp")
def q10f_times(spark, d):
    return rulesets.impossible_times(bronze(spark, d).withColumn("processing_timestamp", F.col("ingestion_timestamp")))


@query(
    "f16_blank_reasons",
    "SELECT raw_json AS raw_payload FROM strict WHERE len(errors) > 0 AND 'invalid_json' = errors[1]",
)
def f16(spark, d):
    rows = strict.quarantine_rows(judged(spark, d), RUN)
    blanked = rows.withColumn("error_reason", F.when(F.col("error_reason") == "invalid_json", "  ").otherwise(F.col("error_reason")))
    return rulesets.blank_reasons(blanked)


def _failures(table: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS \"check\", CAST({count} AS BIGINT) AS failures FROM {source}" for name, count in rules.items())


_MISSING = "COUNT(*) FILTER (WHERE {} IS NULL)"
_TWICE = "COUNT({0}) - COUNT(DISTINCT {0})"
_FOREIGN = "COUNT(*) FILTER (WHERE event_type NOT IN ('authorization', 'purchase', 'refund'))"
# Marts in which dates and counts are missing or the same where the count says so.
_MART_DATE = "CASE WHEN event_count % 4 = 0 THEN NULL WHEN event_count % 4 = 1 THEN DATE '1900-01-01' ELSE event_date END"
_MART_COUNT = "CASE WHEN event_count % 6 = 0 THEN NULL ELSE event_count END"
for _mart in ("trends", "quality", "summary"):
    CTES[f"bad_{_mart}"] = f"SELECT * REPLACE ({_MART_DATE} AS event_date, {_MART_COUNT} AS event_count) FROM {_mart}"
CTES["bad_stg"] = "SELECT * REPLACE (CASE WHEN amount > 400 THEN NULL ELSE amount END AS amount) FROM stg_local"


@query(
    "q9_stream_model_checks",
    "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (" + " UNION ALL ".join([
        _failures("stg_streaming_transaction_events", "bad_stg", {
            "not_null_transaction_id": _MISSING.format("transaction_id"), "unique_transaction_id": _TWICE.format("transaction_id"),
            "not_null_event_date": _MISSING.format("event_date"), "accepted_event_type": _FOREIGN, "not_null_amount": _MISSING.format("amount")}),
        _failures("mart_streaming_risk_summary", "bad_summary", {
            "not_null_event_date": _MISSING.format("event_date"), "unique_event_date": _TWICE.format("event_date")}),
        _failures("mart_streaming_event_quality", "bad_quality", {
            "not_null_event_date": _MISSING.format("event_date"), "unique_event_date": _TWICE.format("event_date"),
            "not_null_event_count": _MISSING.format("event_count")}),
        _failures("mart_realtime_risk_trends", "bad_trends", {
            "not_null_event_date": _MISSING.format("event_date"), "not_null_event_hour": _MISSING.format("event_hour"),
            "not_null_event_type": _MISSING.format("event_type"), "accepted_event_type": _FOREIGN,
            "not_null_event_count": _MISSING.format("event_count")}),
    ]) + ")",
)
def q9_stream(spark, d):
    """Every declared check of the four stream models, on tables with faults."""
    staged = stored(stg(spark, d), "staged")
    bad = lambda mart: mart.withColumns({"event_date": F.expr(_MART_DATE), "event_count": F.expr(_MART_COUNT)})
    tables = {
        "stg_streaming_transaction_events": staged.withColumn("amount", F.when(~(F.col("amount") > 400), F.col("amount"))),
        "mart_streaming_risk_summary": bad(models.streaming_risk_summary(staged, LIMIT)),
        "mart_streaming_event_quality": bad(models.event_quality(staged)),
        "mart_realtime_risk_trends": bad(models.realtime_trends(staged, LIMIT)),
    }
    return rulesets.model_checks(tables, rulesets.stream_model_rules())


# --- real streams over stored records --------------------------------------------------------------


def _record_files(spark, d):
    """All records as files of a record stream, several per micro-batch; copies of an id are in one file."""
    repeats = (F.col("offset") % 25 == 0) & (F.col("offset") > 0)
    first = F.when(repeats, F.col("offset") - 1).otherwise(F.col("offset"))
    # Small row groups, so that the few files of a batch are parsed by more tasks than there are files.
    write = lambda path: star.event_records(spark, d).repartition(12, first).write.option("parquet.block.size", 1 << 20).parquet(path)
    return table_once(spark, d, "records", write)


def _config(spark, d, label, **options):
    root = work_folder(spark, label)
    source = SourceSpec("parquet", _record_files(spark, d), max_files_per_trigger=4)
    return runner.StreamConfig(
        root, source, RUN, tuple(TYPES), risk_amount=LIMIT,
        dead_letters=runner.file_messages(f"{root}/dead-letters"),
        risk_messages=runner.file_messages(f"{root}/risk-messages"), **options,
    )


def _basic_run(spark, d):
    """A finished basic stream, run once for the queries that look at its outputs."""
    holder = {}

    def run(path):
        config = _config(spark, d, "stream-basic")
        runner.start_stream(spark, config, available_now=True)
        holder["config"] = config
        spark.createDataFrame([(config.root,)], "root string").write.json(path)

    folder = table_once(spark, d, "basic-run", run)
    root = spark.read.schema("root string").json(folder).first()["root"]
    return runner.StreamConfig(root, SourceSpec("parquet", root), RUN, tuple(TYPES), risk_amount=LIMIT)


@query("t1_basic_stream_bronze", f"SELECT {_BRONZE} FROM bronze")
def t1(spark, d):
    return runner.read_layer(spark, _basic_run(spark, d), "bronze")


@query("k5_stream_quarantine", f"SELECT {_BRONZE} FROM bronze WHERE NOT is_valid")
def k5(spark, d):
    return runner.read_layer(spark, _basic_run(spark, d), "quarantine")


@query("t13_dead_letter_audit", "SELECT transaction_id AS key, raw_json AS value FROM bronze WHERE NOT is_valid")
def t13(spark, d):
    return spark.read.parquet(f"{_basic_run(spark, d).root}/dead-letters/batch_id=*")


_ACCOUNTING = """
    SELECT CAST(COUNT(*) AS BIGINT) AS input_count, clean_count, COUNT(*) FILTER (WHERE NOT is_valid) AS invalid_count,
           COUNT(*) FILTER (WHERE is_valid) - clean_count AS duplicate_count, late_count,
           COUNT(*) FILTER (WHERE unexpected_field_count > 0) AS schema_drift_count,
           COUNT(*) FILTER (WHERE NOT is_valid) AS dlq_count, risk_alert_count
    FROM bronze, (SELECT COUNT(*) AS clean_count, COUNT(*) FILTER (WHERE is_late) AS late_count,
                         COUNT(*) FILTER (WHERE amount >= 200) AS risk_alert_count FROM silver)
    GROUP BY clean_count, late_count, risk_alert_count"""


@query(
    "t5_batch_accounting",
    f"""SELECT *, CAST(12 // 4 AS BIGINT) AS batch_count, input_count - clean_count - invalid_count - duplicate_count
              AS unreconciled_batches, CAST(invalid_count AS DOUBLE) / input_count AS invalid_rate FROM ({_ACCOUNTING})""",
)
def t5(spark, d):
    return metrics.summarize_metrics(read_batch_metrics(spark, _basic_run(spark, d).path("metrics")))


@query(
    "t8_stream_validation",
    f"""SELECT *, CAST(12 // 4 AS BIGINT) AS batch_count, input_count - clean_count - invalid_count - duplicate_count AS unreconciled_batches,
               CAST(invalid_count AS DOUBLE) / input_count AS invalid_rate, 'PASS' AS status FROM ({_ACCOUNTING})
        WHERE input_count = clean_count + invalid_count + duplicate_count AND invalid_count <= 0.5 * input_count""",
)
def t8(spark, d):
    total = metrics.validate_stream(read_batch_metrics(spark, _basic_run(spark, d).path("metrics")), 0.5)
    kinds = {int: "long", float: "double", str: "string"}
    return spark.createDataFrame([tuple(total.values())], ", ".join(f"{n} {kinds[type(v)]}" for n, v in total.items()))


def _failing_at(batch: int):
    """A callback that breaks the run off once, when the outputs of a batch are stored but not committed."""
    left = [batch]

    def done(batch_id: int) -> None:
        if batch_id in left:
            left.remove(batch_id)
            raise RuntimeError("the run is broken off here")

    return done


def _resumed_run(spark, d, profile):
    """Config and live counters of a run that broke off in its second batch and was started again, by new objects."""
    config = _config(spark, d, f"stream-resumed-{profile}", batch_stored=_failing_at(1))
    try:
        runner.start_stream(spark, config, profile, available_now=True, live=LiveCounters(spark, config.root, profile))
    except StreamingQueryException:
        pass
    counters = LiveCounters(spark, config.root, profile)
    runner.start_stream(spark, config, profile, available_now=True, live=counters)
    return config, counters


@query(
    "t9_resumed_run",
    f"""SELECT a.*, CAST(12 // 4 AS BIGINT) AS batch_count, CAST(0 AS BIGINT) AS rewritten_files, bronze_rows, silver_rows
        FROM ({_ACCOUNTING}) a, (SELECT COUNT(*) AS bronze_rows FROM bronze), (SELECT COUNT(*) AS silver_rows FROM silver)""",
)
def t9(spark, d):
    """A killed and resumed run leaves what an undisturbed one leaves, and a third start writes nothing."""
    config, _ = _resumed_run(spark, d, "basic")
    before = file_inventory(spark, config.root)
    before = stored(before, "files-before")
    fingerprint = metrics.fingerprint(spark, config.path("metrics"))
    runner.start_stream(spark, config, available_now=True)
    metrics.verify_restart(fingerprint, metrics.fingerprint(spark, config.path("metrics")))
    layers = lambda files: files.where(~F.col("path").contains("/checkpoint-"))
    written = inventory_diff(layers(before), layers(file_inventory(spark, config.root))).agg(F.count(F.lit(1)).alias("rewritten_files"))
    rows = [runner.read_layer(spark, config, name).agg(F.count(F.lit(1)).alias(f"{name}_rows")) for name in ("bronze", "silver")]
    total = metrics.summarize_metrics(read_batch_metrics(spark, config.path("metrics"))).drop("unreconciled_batches", "invalid_rate")
    return total.crossJoin(written).crossJoin(rows[0]).crossJoin(rows[1])  # one row each


def _counter_rows(spark, counters):
    return spark.createDataFrame(sorted(counters.totals().items()), "metric_name string, records long")


@query(
    "t12_live_counters",
    """SELECT 'valid_records' AS metric_name, COUNT(*) FILTER (WHERE len(errors) = 0) AS records FROM strict
       UNION ALL SELECT 'invalid_records', COUNT(*) FILTER (WHERE len(errors) > 0) FROM strict
       UNION ALL SELECT 'sink_write_failures', COUNT(*) FILTER (WHERE len(errors) = 0 AND (happened_at IS NULL OR arrived_at IS NULL)) FROM strict""",
)
def t12(spark, d):
    return _counter_rows(spark, _resumed_run(spark, d, "strict")[1])


@query(
    "t12_live_counters_basic",
    """SELECT 'input_count' AS metric_name, COUNT(*) AS records FROM bronze
       UNION ALL SELECT 'invalid_count', COUNT(*) FILTER (WHERE NOT is_valid) FROM bronze
       UNION ALL SELECT 'schema_drift_count', COUNT(*) FILTER (WHERE unexpected_field_count > 0) FROM bronze""",
)
def t12_basic(spark, d):
    return _counter_rows(spark, _resumed_run(spark, d, "basic")[1])


@query("t3_interval_run", f"SELECT {_BRONZE} FROM bronze")
def t3(spark, d):
    """An interval run that is stopped at its maximal runtime, wherever it is; a second run takes the rest."""
    config = _config(spark, d, "stream-interval")
    runner.start_stream(spark, config, interval="1 second", max_runtime=8)
    runner.start_stream(spark, config, available_now=True)
    return runner.read_layer(spark, config, "bronze")


@query("k8_batch_metrics")
def k8(spark, d):
    return read_batch_metrics(spark, _basic_run(spark, d).path("metrics"))


# Later copies of every 40th event: another amount, one day on.
_MOVED = """CASE WHEN kafka_offset % 40 = 7 THEN event_timestamp + INTERVAL 1 DAY ELSE event_timestamp END AS event_timestamp,
            CASE WHEN kafka_offset % 40 = 7 THEN event_date + 1 ELSE event_date END AS event_date,
            CASE WHEN kafka_offset % 40 = 7 THEN amount + 1 ELSE amount END AS amount,
            CASE WHEN kafka_offset % 40 = 7 THEN ingestion_timestamp + INTERVAL 1 DAY ELSE ingestion_timestamp END AS ingestion_timestamp"""


@query(
    "m5_streaming_merge",
    f"SELECT {_SILVER} FROM (SELECT * EXCLUDE (event_timestamp, event_date, amount, ingestion_timestamp), {_MOVED} FROM silver)",
)
def m5(spark, d):
    """The first load creates the target; the second brings later copies, some on another date, and old ones, which lose."""
    path = work_folder(spark, "stream-target")
    rows = runner.read_layer(spark, _basic_run(spark, d), "silver")
    merge.merge_streaming(spark, path, rows)
    day = F.make_dt_interval(days=F.lit(1))
    later = rows.where("kafka_offset % 40 = 7").withColumns({
        "event_timestamp": F.col("event_timestamp") + day, "event_date": F.date_add("event_date", 1),
        "amount": F.col("amount") + 1, "ingestion_timestamp": F.col("ingestion_timestamp") + day,
    })
    merge.merge_streaming(spark, path, rows.where("kafka_offset % 40 = 7").unionByName(later))
    return spark.read.parquet(path).select(*_SILVER.split(", "))


def _strict_run(spark, d):
    def run(path):
        config = _config(spark, d, "stream-strict")
        runner.start_stream(spark, config, profile="strict", available_now=True)
        spark.createDataFrame([(config.root,)], "root string").write.json(path)

    folder = table_once(spark, d, "strict-run", run)
    return spark.read.schema("root string").json(folder).first()["root"]


@query("t10_strict_stream_events", f"SELECT {_STRICT_EVENT} FROM strict_valid")
def t10(spark, d):
    return spark.read.parquet(f"{_strict_run(spark, d)}/events/batch_id=*").drop("processing_timestamp")


@query(
    "k12_strict_stream_outputs",
    """SELECT 'events' AS layer, COUNT(*) AS row_count FROM strict_valid
       UNION ALL SELECT 'quarantine_strict', COUNT(*) FROM strict WHERE len(errors) > 0
       UNION ALL SELECT 'observations', COUNT(*) FROM strict""",
)
def k12(spark, d):
    root = _strict_run(spark, d)
    layers = [
        spark.read.parquet(f"{root}/{name}/batch_id=*").agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count"))
        for name in ("events", "quarantine_strict", "observations")
    ]
    return strict.flatten(*layers)


@query("s11_jsonl_events", "SELECT raw_json FROM records")
def s11(spark, d):
    path = work_folder(spark, "jsonl")
    decoded(spark, d).select(F.col("raw_json").alias("value")).write.text(path)
    return decode_records(read_events_jsonl(spark, path)).select("raw_json")


@query("d3_dedup_latest_events", f"SELECT {_SILVER} FROM silver")
def d3_events(spark, d):
    valid = basic.split_valid(bronze(spark, d))[0]
    return dedup_latest(valid, ["transaction_id"], ["ingestion_timestamp", "kafka_offset"]).select(*_SILVER.split(", "))
