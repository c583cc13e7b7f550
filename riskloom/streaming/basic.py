"""Basic profile: schema-on-read parsing and one validity flag per event.

All functions take and give DataFrames, so a batch test and a micro-batch run the same code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.predicates import all_of
from riskloom.functions.risk import HIGH_VALUE
from riskloom.functions.times import is_late, parse_instant
from riskloom.schemas import BRONZE, EVENT, EVENT_FIELDS, EVENT_TYPES

# Fixed value: label of every row the profile rejects.
CONTRACT_ERROR = "schema_or_value_contract_failed"

_REQUIRED = [f for f in EVENT_FIELDS if f not in ("amount", "event_type")]


def parse_events(decoded: DataFrame) -> DataFrame:
    """Event fields as columns and the number of keys outside the contract.

    Malformed JSON leaves every field and the key count null.
    """
    foreign = F.array_except(F.json_object_keys("raw_json"), F.array(*[F.lit(f) for f in EVENT_FIELDS]))
    read = F.struct(F.size(foreign).alias("foreign"), F.from_json("raw_json", EVENT).alias("event"))
    # Explode of a one-element array: a filter on the fields stays above it, so the text is
    # parsed once per row and not again for every field a pushed-down filter mentions.
    parsed = decoded.select("*", F.explode(F.array(read)).alias("_read"))
    count = F.col("_read.foreign")
    return parsed.select(
        *decoded.columns,
        F.when(count >= 0, count).alias("unexpected_field_count"),  # null also where size(null) is -1
        "_read.event.*",
    )


def type_events(parsed: DataFrame) -> DataFrame:
    """Both timestamps typed (null where unreadable), date and hour of the event."""
    typed = parsed.withColumns(
        {name: parse_instant(name) for name in ("event_timestamp", "ingestion_timestamp")}
    )
    return typed.withColumns({"event_date": F.to_date("event_timestamp"), "event_hour": F.hour("event_timestamp")})


def basic_valid(allowed_types: list[str] = EVENT_TYPES) -> Column:
    """Positive amount, no foreign key, all required fields, known event type; null counts as invalid."""
    condition = all_of(
        F.col("amount") > 0,
        F.col("unexpected_field_count") == 0,
        F.col("event_type").isin(*allowed_types),
        *[F.col(name).isNotNull() for name in _REQUIRED],
    )
    return F.coalesce(condition, F.lit(False))


def mark(typed: DataFrame, allowed_types: list[str] = EVENT_TYPES, late_hours: int = 24) -> DataFrame:
    """Add is_valid, validation_error and is_late; columns as in bronze."""
    flagged = typed.withColumn("is_valid", basic_valid(allowed_types)).withColumns(
        {
            "validation_error": F.when(~F.col("is_valid"), CONTRACT_ERROR),
            "is_late": is_late(late_hours),
        }
    )
    return flagged.select(*BRONZE.fieldNames())


def split_valid(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return marked.where("is_valid"), marked.where("not is_valid")


def drifted(marked: DataFrame) -> DataFrame:
    """Events with foreign keys; malformed JSON is not drift."""
    return marked.where("unexpected_field_count > 0")


def risk_alerts(clean: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return clean.where(F.col("amount") >= F.lit(float(threshold)))


def dedup_in_batch(valid: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One event per id inside a micro-batch: the last to arrive."""
    from riskloom.operators.clean import dedup_latest

    return dedup_latest(valid, keys or ["transaction_id"], ["ingestion_timestamp", "kafka_offset"])


def stamp_batch(clean: DataFrame, batch_id: int, run_id: str) -> DataFrame:
    """Silver columns: batch and run recorded, validity columns gone."""
    return clean.drop("is_valid", "validation_error").withColumns(
        {
            "processing_batch_id": F.lit(batch_id).cast("long"),
            "processing_run_id": F.lit(run_id),
        }
    )


def as_messages(rows: DataFrame) -> DataFrame:
    """Key and value for a message topic."""
    return rows.select(F.col("transaction_id").cast("string").alias("key"), F.col("raw_json").alias("value"))
