import json
from datetime import datetime, timezone

import pytest

from riskloom.generate.events import as_records, generate_events
from riskloom.observe import alerts, observations
from riskloom.operators.merge import merge_streaming
from riskloom.schemas import BATCH_METRICS, CHECK_RESULT
from riskloom.sources.events import SourceSpec
from riskloom.schemas import BATCH_METRICS
from riskloom.sources.results import LOAD_STATUS, read_batch_metrics, tolerant
from riskloom.streaming import live, metrics, runner, strict

EVENT = {
    "transaction_id": "t1", "event_timestamp": "2026-07-15T23:30:00-02:00", "customer_id": "c", "merchant_id": "m",
    "amount": 10.5, "currency": "USD", "country": "US", "merchant_category": "fuel", "payment_method": "credit_card",
    "device_id": "d", "event_type": "purchase", "ingestion_timestamp": "2026-07-16T01:31:00Z",
}


def _errors(spark, payload):
    text = payload if isinstance(payload, (bytes, bytearray)) else json.dumps(payload).encode()
    return strict.judge(spark.createDataFrame([(bytearray(text),)], "value binary")).first()


@pytest.mark.parametrize(
    "change, wanted",
    [
        ({}, []),
        ({"amount": -2}, ["invalid_amount"]),
        ({"amount": True}, ["invalid_amount"]),
        ({"amount": 1_000_001, "customer_id": 42}, ["invalid_amount", "invalid_customer_id"]),
        ({"transaction_id": ""}, ["missing_transaction_id"]),
        ({"device_id": None}, ["invalid_device_id", "missing_device_id"]),
        ({"event_type": "gift"}, ["invalid_event_type"]),
        ({"event_timestamp": "2026-07-15T10:00:00"}, ["invalid_event_timestamp"]),
        ({"event_timestamp": "2026-07-17T10:00:00Z"}, ["event_timestamp_after_ingestion_timestamp"]),
        ({"new_uncontracted_field": 1}, ["unexpected_fields:new_uncontracted_field"]),
        ({"b": {"amount": "x"}, "a, amount: STRING": 2}, ["unexpected_fields:a, amount: STRING,b"]),
    ],
)
def test_strict_contract(spark, change, wanted):
    assert _errors(spark, {**EVENT, **change})["errors"] == wanted


def test_undecodable_payloads(spark):
    assert _errors(spark, b"{not-json")["errors"] == ["invalid_json"]
    assert _errors(spark, b"[1]")["errors"] == ["event_not_json_object"]
    assert _errors(spark, b"\xff{")["raw_payload"] == "�{"


def test_date_and_hour_follow_the_text_offset(spark):
    row = _errors(spark, EVENT)
    assert (str(row["event_date"]), row["event_hour"]) == ("2026-07-15", 23)


def _stream(spark, tmp_path, files=4, **options):
    events = generate_events(spark, 200, 5, invalid_every=10, duplicate_every=7, late_every=9)
    source = str(tmp_path / "records")
    as_records(events).repartition(files).write.parquet(source)
    root = str(tmp_path / "out")
    return runner.StreamConfig(
        root, SourceSpec("parquet", source, max_files_per_trigger=options.pop("per_trigger", files)), "run-1",
        dead_letters=runner.file_messages(f"{root}/dead-letters"), **options,
    )


@pytest.mark.parametrize("per_trigger", [4, 1])
def test_basic_stream_reconciles_and_restarts(spark, tmp_path, per_trigger):
    config = _stream(spark, tmp_path, per_trigger=per_trigger)
    runner.start_stream(spark, config, available_now=True)
    found = read_batch_metrics(spark, config.path("metrics"))
    total = metrics.validate_stream(found, 0.2)
    assert total["input_count"] == 200 and total["invalid_count"] == 19 and total["batch_count"] == 4 // per_trigger
    assert total["dlq_count"] == 19 and total["late_count"] > 0 and total["risk_alert_count"] == 0
    before = metrics.fingerprint(spark, config.path("metrics"))
    runner.start_stream(spark, config, available_now=True)
    metrics.verify_restart(before, metrics.fingerprint(spark, config.path("metrics")))
    ids = runner.read_layer(spark, config, "silver").select("transaction_id").distinct().count()
    target = str(tmp_path / "target")
    for _ in range(2):
        assert merge_streaming(spark, target, runner.read_layer(spark, config, "silver")) == {"row_count": ids, "unique_ids": ids}


def test_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    config = _stream(spark, tmp_path)
    rows = runner.prepare_basic(spark.read.parquet(config.source.location), config)
    first, second = runner.fan_out_basic(rows, 3, config), runner.fan_out_basic(rows, 3, config)
    assert first["reconciliation"] and {k: v for k, v in first.items() if k.endswith("_count")} == {
        k: v for k, v in second.items() if k.endswith("_count")
    }
    assert runner.read_layer(spark, config, "bronze").count() == 200


def test_strict_stream_routes_every_record(spark, tmp_path):
    config = _stream(spark, tmp_path, per_trigger=2)
    runner.start_stream(spark, config, profile="strict", available_now=True)
    count = lambda layer: spark.read.parquet(f"{config.path(layer)}/batch_id=*").count()
    assert (count("events"), count("quarantine_strict"), count("observations")) == (181, 19, 200)


def _metrics(spark, *rows):
    base = dict.fromkeys(BATCH_METRICS.fieldNames(), 0) | {
        "pipeline_name": "p", "processing_run_id": "r", "processing_timestamp": "2026-07-15T12:00:00+00:00",
        "processing_duration_seconds": 1.5, "reconciliation": True,
    }
    return spark.createDataFrame([tuple((base | r)[n] for n in BATCH_METRICS.fieldNames()) for r in rows], BATCH_METRICS)


def test_stream_validation(spark):
    good = {"input_count": 10, "clean_count": 8, "invalid_count": 1, "duplicate_count": 1}
    assert metrics.validate_stream(_metrics(spark, good), 0.1)["invalid_rate"] == 0.1
    for bad in ({"reconciliation": False}, {"dlq_count": 2}, {"clean_count": 7}, {"invalid_count": 9, "clean_count": 0}):
        with pytest.raises(RuntimeError):
            metrics.validate_stream(_metrics(spark, good | bad), 0.1)
    with pytest.raises(RuntimeError):
        metrics.validate_stream(_metrics(spark).limit(0))


def test_gauges_and_their_alerts(spark):
    from pyspark.sql import functions as F

    load, checks = spark.createDataFrame([], LOAD_STATUS), spark.createDataFrame([], CHECK_RESULT)
    row = {"input_count": 10, "clean_count": 8, "invalid_count": 2, "dlq_count": 2}
    gauges = alerts.metric_gauges(_metrics(spark, row), load, checks)
    assert gauges.first()["streaming_invalid_record_ratio"] == 0.2 and len(gauges.columns) == 19
    now = F.lit("2026-07-15 12:01:00").cast("timestamp")
    names = {r["alert_name"] for r in alerts.gauge_alerts(gauges, now).collect()}
    assert names == {"StreamingInvalidRecordRateHigh", "StreamingDlqEventsDetected"}
    empty = alerts.metric_gauges(_metrics(spark), load, checks)
    assert {r["alert_name"] for r in alerts.gauge_alerts(empty, now).collect()} == {"NoStreamingBatchMetrics"}


def test_observation_alerts(spark):
    schema = "pipeline_name string, table_name string, metric_name string, metric_value double, status string, severity string, details string"
    make = lambda status, severity: ("p", "t", status.lower(), 1.0, status, severity, "")
    rows = spark.createDataFrame([make("PASS", "INFO"), make("WARN", "WARNING"), make("FAIL", "CRITICAL"), make("WARN", "INFO")], schema)
    names = lambda level: sorted(r["metric_name"] for r in alerts.evaluate_alerts(rows, min_severity=level).collect())
    assert names("warning") == ["fail", "warn"] and names("CRITICAL") == ["fail"]
    with pytest.raises(ValueError):
        alerts.evaluate_alerts(rows, min_severity="LOUD")
    fixed = observations.normalize_observations(spark.createDataFrame([make("FAIL", "ERROR")], schema)).first()
    assert fixed["severity"] == "CRITICAL" and fixed["observation_timestamp"] is not None


def test_empty_alert_payload(spark):
    payload = spark.createDataFrame([('{"status": "firing", "alerts": []}',), ("{}",)], "value string")
    assert alerts.normalize_alert_payload(payload).count() == 0


def test_cut_off_metrics_file_is_an_error(spark, tmp_path):
    good = '{"batch_id": 0, "input_count": 10, "clean_count": 10, "invalid_count": 0, "duplicate_count": 0, "reconciliation": true}'
    for batch, text in enumerate([good, good[:60]]):
        folder = tmp_path / f"batch_id={batch}"
        folder.mkdir()
        (folder / "part.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED"):
        metrics.validate_stream(read_batch_metrics(spark, str(tmp_path)), 1.0)
    read = tolerant(spark, f"{tmp_path}/*", BATCH_METRICS)
    assert read.where("_broken is not null").count() == 1 and read.where("_broken is null").first()["input_count"] == 10
    assert tolerant(spark, f"{tmp_path}/absent", "a string, b struct<c: int, d: array<string>>").count() == 0


def _samples(spark, rows):
    return spark.createDataFrame(
        [(job, metric, datetime(2026, 1, 1, 10, minute, tzinfo=timezone.utc), value) for job, metric, minute, value in rows],
        "job string, metric_name string, at timestamp, value long")


def test_counters_that_begin_anew_lose_nothing(spark):
    rows = _samples(spark, [("j", "m", 0, 5), ("j", "m", 1, 9), ("j", "m", 2, 2), ("j", "m", 3, 2), ("k", "m", 2, 4)])
    found = alerts.increases(rows).orderBy("job", "at").collect()
    assert [r["increase"] for r in found] == [5, 4, 2, 0, 4]


def test_each_window_rule_fires_once(spark):
    valid = [("j", "valid_records", m, 10 * (m + 1)) for m in (*range(8), *range(20, 31))]
    bad = [("j", "invalid_records", m, 1 + 5 * max(0, m - 22)) for m in range(20, 31)]     # more than a tenth of a window from minute 25 on
    failed = [("j", "sink_write_failures", 25, 1)]
    fired = alerts.windowed_alerts(_samples(spark, valid + bad + failed)).orderBy("fired_at").collect()
    minute = lambda t: t.minute
    assert [(r["alert_name"], minute(r["fired_at"]), minute(r["ended_at"])) for r in fired] == [
        ("no_recent_valid_records", 18, 19), ("sink_write_failure", 25, 29), ("invalid_record_rate_high", 30, 30)]
    assert alerts.windowed_alerts(_samples(spark, valid).limit(0)).count() == 0


@pytest.mark.parametrize("profile", ["basic", "strict"])
def test_live_counters_go_on_after_a_killed_batch(spark, tmp_path, profile):
    broken = [1]

    def stored(batch_id):
        if batch_id in broken:
            broken.remove(batch_id)
            raise RuntimeError("killed")

    config = _stream(spark, tmp_path, files=3, per_trigger=1, batch_stored=stored)
    first = live.LiveCounters(spark, config.root, profile)
    with pytest.raises(Exception, match="killed"):
        runner.start_stream(spark, config, profile, available_now=True, live=first)
    second = live.LiveCounters(spark, config.root, profile)
    assert sum(second.totals().values()) > sum(first.totals().values()) > 0     # the killed batch is stored, not committed
    runner.start_stream(spark, config, profile, available_now=True, live=second)
    rows = {"basic": {"input_count": 200, "invalid_count": 19, "schema_drift_count": second.totals().get("schema_drift_count")},
            "strict": {"valid_records": 181, "invalid_records": 19, "sink_write_failures": 0}}[profile]
    assert second.totals() == rows
    stored_now = live.stored_counts(spark, config.root, profile).drop("batch_id").groupBy().sum().first()
    assert list(stored_now) == [rows[n] for n in (live.BASIC if profile == "basic" else live.STRICT)]
    assert live.LiveCounters(spark, config.root, profile).totals() == rows
