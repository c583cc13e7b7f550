"""Streaming queries and their per-batch fan-out.

A micro-batch is parsed once and stored (bronze, or routed records in the strict
profile). Everything else of the batch is derived from those stored rows: no cached
block has to survive an executor, the source is read once, and counts state what is
on storage. Each output is overwritten under its batch number, so a replayed batch
leaves the same files.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.risk import HIGH_VALUE
from riskloom.schemas import (
    BATCH_METRICS,
    BRONZE,
    EVENT_TYPES,
    SILVER,
    STRICT_EVENT,
    STRICT_REQUIRED,
)
from riskloom.sources.events import SourceSpec, decode_records, open_stream
from riskloom.streaming import basic, strict
from riskloom.streaming.live import LiveCounters

MessageSink = Callable[[DataFrame, int], None]
PIPELINE_NAME = "transaction_event_stream"  # fixed value of the metrics


@dataclass(frozen=True)
class StreamConfig:
    root: str
    source: SourceSpec
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    allowed_types: tuple[str, ...] = tuple(EVENT_TYPES)
    late_hours: int = 24
    risk_amount: float = HIGH_VALUE
    dead_letters: MessageSink | None = None
    risk_messages: MessageSink | None = None
    batch_stored: Callable[[int], None] | None = None  # called when a batch's outputs are stored, before its commit

    def __post_init__(self):
        if self.late_hours < 0:
            raise ValueError("late_hours must not be negative")
        if self.risk_amount <= 0:
            raise ValueError("risk_amount must be positive")

    def path(self, layer: str, batch_id: int | None = None) -> str:
        folder = f"{self.root}/{layer}"
        return folder if batch_id is None else f"{folder}/batch_id={batch_id}"


def kafka_messages(servers: str, topic: str, **options: str) -> MessageSink:
    """Publish key and value to a topic (needs the connector jar on the cluster)."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        writer = messages.write.format("kafka").options(**options)
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return publish


def file_messages(path: str) -> MessageSink:
    """Store key and value per batch."""

    def store(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return store


def read_layer(spark: SparkSession, config: StreamConfig, layer: str) -> DataFrame:
    """All batches of a layer."""
    schema = {"bronze": BRONZE, "quarantine": BRONZE, "silver": SILVER}.get(layer)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{config.path(layer)}/batch_id=*")


# --- basic profile -----------------------------------------------------------------------


def prepare_basic(records: DataFrame, config: StreamConfig) -> DataFrame:
    typed = basic.type_events(basic.parse_events(decode_records(records)))
    return basic.mark(typed, list(config.allowed_types), config.late_hours)


def batch_counts(bronze: DataFrame, silver: DataFrame, risk_amount: float) -> DataFrame:
    """Counts of a batch: one pass over bronze flags, one over silver flags."""
    taken = bronze.agg(
        F.count(F.lit(1)).alias("input_count"),
        F.count_if("is_valid").alias("valid_count"),
        F.count_if(~F.col("is_valid")).alias("invalid_count"),
        F.count_if(F.col("unexpected_field_count") > 0).alias("schema_drift_count"),
    )
    kept = silver.agg(
        F.count(F.lit(1)).alias("clean_count"),
        F.count_if("is_late").alias("late_count"),
        F.count_if(F.col("amount") >= F.lit(float(risk_amount))).alias("risk_detected_count"),
    )
    # Two one-row tables side by side.
    return taken.crossJoin(kept).withColumn("duplicate_count", F.col("valid_count") - F.col("clean_count"))


def fan_out_basic(batch: DataFrame, batch_id: int, config: StreamConfig) -> dict:
    """Store bronze, silver and quarantine, publish messages, record the batch metrics."""
    started = time.monotonic()
    spark = batch.sparkSession
    at = lambda layer: config.path(layer, batch_id)

    batch.write.mode("overwrite").parquet(at("bronze"))
    bronze = spark.read.schema(BRONZE).parquet(at("bronze"))
    valid, invalid = basic.split_valid(bronze)
    clean = basic.dedup_in_batch(valid)
    basic.stamp_batch(clean, batch_id, config.run_id).write.mode("overwrite").parquet(at("silver"))
    silver = spark.read.schema(SILVER).parquet(at("silver"))
    invalid.write.mode("overwrite").parquet(at("quarantine"))

    counts = batch_counts(bronze, silver, config.risk_amount).first().asDict()
    counts["dlq_count"] = counts["risk_alert_count"] = 0
    if config.dead_letters and counts["invalid_count"]:
        quarantined = spark.read.schema(BRONZE).parquet(at("quarantine"))
        config.dead_letters(basic.as_messages(quarantined), batch_id)
        counts["dlq_count"] = counts["invalid_count"]
    if config.risk_messages and counts["risk_detected_count"]:
        config.risk_messages(basic.as_messages(basic.risk_alerts(silver, config.risk_amount)), batch_id)
        counts["risk_alert_count"] = counts["risk_detected_count"]

    accounted = counts["clean_count"] + counts["invalid_count"] + counts["duplicate_count"]
    metrics = {
        **counts,
        "pipeline_name": PIPELINE_NAME,
        "processing_run_id": config.run_id,
        "batch_id": int(batch_id),
        "processing_timestamp": datetime.now(timezone.utc).isoformat(),
        "processing_duration_seconds": round(time.monotonic() - started, 6),
        "reconciliation": counts["input_count"] == accounted,
    }
    row = spark.createDataFrame([tuple(metrics[f] for f in BATCH_METRICS.fieldNames())], BATCH_METRICS)
    row.coalesce(1).write.mode("overwrite").json(at("metrics"))
    return metrics


# --- strict profile ------------------------------------------------------------------------


def fan_out_strict(batch: DataFrame, batch_id: int, config: StreamConfig) -> None:
    """Store valid events, quarantined payloads and one observation per record.

    Valid rows that their table could not hold join the quarantine.
    """
    spark = batch.sparkSession
    at = lambda layer: config.path(layer, batch_id)
    batch.write.mode("overwrite").parquet(at("routed"))
    judged = spark.read.schema(batch.schema).parquet(at("routed"))
    moment = F.lit(datetime.now(timezone.utc))

    events = strict.valid_rows(judged, config.run_id, moment)
    accepted, rejected, failures = strict.route_sink_failures(
        events, STRICT_EVENT, STRICT_REQUIRED["events"], config.run_id, moment
    )
    quarantine = strict.flatten(strict.quarantine_rows(judged, config.run_id, moment), rejected)
    observations = strict.flatten(strict.observation_rows(judged, config.run_id, moment), failures)
    for layer, rows in (("events", accepted), ("quarantine_strict", quarantine), ("observations", observations)):
        rows.write.mode("overwrite").parquet(at(layer))


def start_stream(
    spark: SparkSession,
    config: StreamConfig,
    profile: str = "basic",
    available_now: bool = False,
    interval: str = "5 seconds",
    max_runtime: int | None = None,
    live: LiveCounters | None = None,
) -> StreamingQuery:
    """Run the stream.

    available_now  process what is there and end
    max_runtime    with interval triggers: stop after so many seconds
    live           counters that follow the run; they stay registered while it goes on
    Offsets are kept under the root, so a restart continues where the last run ended.
    """
    if max_runtime is not None and max_runtime < 1:
        raise ValueError("max_runtime must be at least 1")
    records = open_stream(spark, config.source)
    if profile == "basic":
        rows, fan_out = prepare_basic(records, config), fan_out_basic
    elif profile == "strict":
        rows, fan_out = strict.judge(records, list(config.allowed_types)), fan_out_strict
    else:
        raise ValueError(f"unknown profile {profile!r}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, batch_id, config)
        if config.batch_stored:
            config.batch_stored(batch_id)

    if live is not None:
        rows = live.on_rows(rows)
        spark.streams.addListener(live)
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", config.path(f"checkpoint-{profile}"))
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    query = writer.trigger(**trigger).start()
    if not available_now and max_runtime is None:
        return query
    try:
        if available_now:
            query.awaitTermination()
        else:
            query.awaitTermination(max_runtime)
            if query.isActive:
                query.stop()
    finally:
        if live is not None:
            live.wait()
            spark.streams.removeListener(live)
    return query
