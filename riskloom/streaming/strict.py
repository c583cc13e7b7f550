"""Strict profile: every violation of the event contract by name.

JSON types are read from the parsed variant, so a number in a text field is found;
no Python function runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.predicates import any_of
from riskloom.functions.times import is_plain_instant, local_date, local_hour, parse_instant_strict
from riskloom.operators.compare import union_all
from riskloom.plans.models import MAX_EVENT_AMOUNT
from riskloom.schemas import (
    EVENT_FIELDS,
    EVENT_TYPES,
    STRICT_EVENT,
    STRICT_OBSERVATION,
    STRICT_QUARANTINE,
)

# Fixed values of the strict tables.
SOURCE_SYSTEM = "gcp_pubsub"
VALID_METRIC, INVALID_METRIC = "valid_records", "invalid_records"
SINK_FAILURE, SINK_FAILURE_METRIC = "sink_write_failure", "sink_write_failures"
UNKNOWN_ERROR = "unknown_validation_error"
DETAIL_LENGTH = 1000

_TEXT_FIELDS = [
    "transaction_id", "customer_id", "merchant_id", "currency", "country", "merchant_category",
    "payment_method", "device_id",
]
_MOMENTS = ("event_timestamp", "ingestion_timestamp")


def decode_payload(value: Column) -> Column:
    """Bytes as text; invalid UTF-8 becomes the replacement character."""
    return F.make_valid_utf8(value.cast("string"))


# The schema of a payload that holds the contract's fields, each of its kind, and nothing else; keys are in order there.
_USUAL = "^OBJECT<" + ", ".join(
    f"{name}: " + (r"(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))" if name == "amount" else "STRING") for name in sorted(EVENT_FIELDS)
) + ">$"
_EVENT = "struct<" + ", ".join(f"{name}: string" for name in EVENT_FIELDS if name != "amount") + ">"


def read_json(records: DataFrame, value: str = "value") -> DataFrame:
    """Add raw_payload, and per contract field its JSON kind and its text.

    Most payloads have the usual shape, which the schema of the parsed variant shows at a glance; the kinds of
    single fields are looked up for the others alone.  Several projections on purpose: each expensive result is
    computed once and then referred to as a column.
    """
    parsed = records.withColumn("raw_payload", decode_payload(F.col(value)))
    parsed = parsed.withColumn("_json", F.try_parse_json("raw_payload"))
    parsed = parsed.withColumn("_schema", F.schema_of_variant("_json"))
    parsed = parsed.withColumns({
        "_usual": F.coalesce(F.col("_schema").rlike(_USUAL), F.lit(False)),
        "_is_object": F.coalesce(F.col("_schema").startswith("OBJECT"), F.lit(False)),
        "_event": F.try_variant_get("_json", "$", _EVENT),
        "_amount": F.try_variant_get("_json", "$.amount", "double"),
    })
    fields = F.when(F.col("_is_object") & ~F.col("_usual"), F.try_variant_get("_json", "$", "map<string, variant>"))
    parsed = parsed.withColumn("_kinds", F.transform_values(fields, lambda _, field: F.schema_of_variant(field)))

    def kind(name: str) -> Column:
        return F.when(F.col("_usual"), "DOUBLE" if name == "amount" else "STRING").otherwise(F.try_element_at("_kinds", F.lit(name)))

    parsed = parsed.withColumns({f"_kind_{name}": kind(name) for name in EVENT_FIELDS})
    # The text of a string field; null for every other kind.
    texts = {f"_text_{n}": F.when(F.col(f"_kind_{n}") == "STRING", F.col(f"_event.{n}")) for n in EVENT_FIELDS if n != "amount"}
    parsed = parsed.withColumns({"amount": F.when(_is_number(F.col("_kind_amount")), F.col("_amount")), **texts})
    parsed = parsed.withColumns({f"_plain_{n}": is_plain_instant(F.col(f"_text_{n}")) for n in _MOMENTS})
    return parsed.withColumns({f"_at_{n}": parse_instant_strict(F.col(f"_text_{n}"), F.col(f"_plain_{n}")) for n in _MOMENTS})


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def strict_errors(allowed_types: list[str] = EVENT_TYPES) -> Column:
    """Sorted distinct violation codes of a row of `read_json`; empty when valid."""
    kind = {name: F.col(f"_kind_{name}") for name in EVENT_FIELDS}
    foreign = F.array_except(F.map_keys("_kinds"), F.array(*[F.lit(f) for f in EVENT_FIELDS]))
    absent = {
        name: kind[name].isNull() | (kind[name] == "VOID")
        | (F.col(f"_text_{name}").eqNullSafe("") if name != "amount" else F.lit(False))
        for name in EVENT_FIELDS
    }
    good_amount = (F.col("amount") > 0) & (F.col("amount") <= MAX_EVENT_AMOUNT)
    known_type = F.col("_text_event_type").isin(*allowed_types)
    happened, arrived = (F.col(f"_at_{name}") for name in _MOMENTS)

    def code(problem: Column, name: str) -> Column:
        return F.when(problem, F.lit(name))

    codes = [
        F.when(F.size(foreign) > 0, F.concat(F.lit("unexpected_fields:"), F.array_join(F.sort_array(foreign), ","))),
        *[code(problem, f"missing_{name}") for name, problem in absent.items()],
        *[code(kind[name] != "STRING", f"invalid_{name}") for name in _TEXT_FIELDS],
        code(~F.coalesce(good_amount, F.lit(False)), "invalid_amount"),
        code(~F.coalesce(known_type, F.lit(False)), "invalid_event_type"),
        code(happened.isNull(), "invalid_event_timestamp"),
        code(arrived.isNull(), "invalid_ingestion_timestamp"),
        code(happened > arrived, "event_timestamp_after_ingestion_timestamp"),
    ]
    # Most rows are valid: find that out without building and sorting an array.
    filled = F.concat_ws("", *[F.when(F.col(f"_text_{n}") == "", "x") for n in EVENT_FIELDS if n != "amount"]) == ""
    valid = F.col("_usual") & filled & good_amount & known_type & happened.isNotNull() & (happened <= arrived)
    listed = F.when(F.coalesce(valid, F.lit(False)), F.array().cast("array<string>")).otherwise(
        F.sort_array(F.array_distinct(F.array_compact(F.array(*codes))))
    )
    return (
        F.when(F.col("raw_payload").isNull(), F.array(F.lit("event_not_json_object")))
        .when(F.col("_json").isNull(), F.array(F.lit("invalid_json")))
        .when(~F.col("_is_object"), F.array(F.lit("event_not_json_object")))
        .otherwise(listed)
    )


def judge(records: DataFrame, allowed_types: list[str] = EVENT_TYPES, value: str = "value") -> DataFrame:
    """Records with raw_payload, `errors` and the typed event fields."""
    read = read_json(records, value)
    texts = [F.col(f"_text_{n}").alias(n) for n in EVENT_FIELDS if n not in ("amount", *_MOMENTS)]
    judged = F.struct(
        F.coalesce("raw_payload", F.lit("null")).alias("raw_payload"),
        strict_errors(allowed_types).alias("errors"),
        *texts,
        "amount",
        *[F.col(f"_at_{n}").alias(n) for n in _MOMENTS],
        local_date(F.col("_text_event_timestamp"), F.col("_plain_event_timestamp")).alias("event_date"),
        local_hour(F.col("_text_event_timestamp"), F.col("_plain_event_timestamp")).alias("event_hour"),
    )
    # Explode of a one-element array keeps every later filter above this point; pushed
    # below it, a filter would repeat the parsing once for each column it mentions.
    return read.select(F.explode(F.array(judged)).alias("_judged")).select("_judged.*")


def is_valid() -> Column:
    return F.size("errors") == 0


def error_field(errors: Column) -> Column:
    """Field the first (alphabetically least) error is about; null when it names none."""
    first = F.get(errors, F.lit(0))
    return (
        F.when(first.rlike("^(missing|invalid)_"), F.regexp_replace(first, "^(missing|invalid)_", ""))
        .when(first.startswith("unexpected_fields:"), F.regexp_extract(first, "^unexpected_fields:([^,]*)", 1))
        .when(first == "event_timestamp_after_ingestion_timestamp", "event_timestamp")
    )


def _now() -> Column:
    return F.current_timestamp()


def valid_rows(judged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Valid events in the layout of their table; date and hour are those of the text's own offset."""
    return judged.where(is_valid()).withColumns(
        {
            "processing_timestamp": _now() if at is None else at,
            "run_id": F.lit(run_id),
            "source_system": F.lit(SOURCE_SYSTEM),
            "validation_status": F.lit("valid"),
        }
    ).select(*STRICT_EVENT.fieldNames())


def quarantine_rows(judged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    reason = F.array_join("errors", ";")
    return judged.where(~is_valid()).select(
        "raw_payload",
        F.when(reason == "", UNKNOWN_ERROR).otherwise(reason).alias("error_reason"),
        error_field(F.col("errors")).alias("error_field"),
        "ingestion_timestamp",
        (_now() if at is None else at).alias("processing_timestamp"),
        F.lit(run_id).alias("run_id"),
    )


def observation_rows(judged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """One metric row per record: PASS for valid ones, WARN with the errors for the others."""
    good = is_valid()
    return judged.select(
        (_now() if at is None else at).alias("observation_timestamp"),
        F.lit(run_id).alias("run_id"),
        F.when(good, VALID_METRIC).otherwise(INVALID_METRIC).alias("metric_name"),
        F.lit(1.0).alias("metric_value"),
        F.when(good, "PASS").otherwise("WARN").alias("status"),
        F.when(good, "INFO").otherwise("WARNING").alias("severity"),
        F.array_join("errors", ",").alias("details"),
    )


def counters(observations: DataFrame) -> DataFrame:
    """Valid, invalid and rejected-at-write record counts."""
    return observations.groupBy("metric_name").agg(F.sum("metric_value").cast("long").alias("records"))


def conforms(rows: DataFrame, schema: T.StructType, required: list[str]) -> Column:
    """The row can be stored: every value casts to its target type, no required one is null."""
    bad = [
        F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema
        if rows.schema[f.name].dataType != f.dataType
    ]
    bad += [F.col(name).isNull() for name in required]
    return ~any_of(*bad)


def route_sink_failures(
    rows: DataFrame, schema: T.StructType, required: list[str], run_id: str, at: Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows the table accepts; quarantine and observation rows for those it would reject."""
    stamp = _now() if at is None else at
    checked = rows.withColumn("_fits", conforms(rows, schema, required))
    accepted = checked.where("_fits").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    )
    details = F.to_json(F.struct(*sorted(rows.columns)))
    rejected = checked.where("not _fits").select(details.alias("details"))
    quarantine = rejected.select(
        F.col("details").alias("raw_payload"),
        F.lit(SINK_FAILURE).alias("error_reason"),
        F.lit(None).cast("string").alias("error_field"),
        F.lit(None).cast("timestamp").alias("ingestion_timestamp"),
        stamp.alias("processing_timestamp"),
        F.lit(run_id).alias("run_id"),
    )
    observations = rejected.select(
        stamp.alias("observation_timestamp"),
        F.lit(run_id).alias("run_id"),
        F.lit(SINK_FAILURE_METRIC).alias("metric_name"),
        F.lit(1.0).alias("metric_value"),
        F.lit("FAIL").alias("status"),
        F.lit("CRITICAL").alias("severity"),
        F.substring("details", 1, DETAIL_LENGTH).alias("details"),
    )
    return accepted, quarantine.select(*STRICT_QUARANTINE.fieldNames()), observations.select(
        *STRICT_OBSERVATION.fieldNames()
    )


flatten = union_all
