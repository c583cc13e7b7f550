"""Synthetic streaming events with planned faults."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.ids import padded_id, uuid5
from riskloom.generate.draws import choice, integer, uniform
from riskloom.schemas import EVENT_FIELDS, EVENT_TYPES

# Fixed values of the event stream.
FIRST_INGESTION = "2026-07-15 12:00:00"
CURRENCIES = ["USD", "CAD"]
COUNTRIES = ["US", "CA"]
CATEGORIES = ["fuel", "grocery", "restaurant", "travel"]
METHODS = ["bank_transfer", "credit_card", "debit_card"]
LATE_DAYS = 2


def generate_events(
    spark: SparkSession, count: int, seed: int, invalid_every: int = 0, duplicate_every: int = 0, late_every: int = 0
) -> DataFrame:
    """`count` events in the contract's fields.

    Every n-th event (never the first) is invalid (amount -1), repeats the id before it,
    or happened two days earlier; 0 switches a fault off.
    """
    for name, value in {"count": count, "invalid_every": invalid_every,
                        "duplicate_every": duplicate_every, "late_every": late_every}.items():
        if value < 0:
            raise ValueError(f"{name} must not be negative")
    n = F.col("id")

    def hits(every: int) -> Column:
        return (n > 0) & (n % every == 0) if every else F.lit(False)

    # With a repeat at every row the whole stream carries the first id.
    source = F.lit(0).cast("long") if duplicate_every == 1 else F.when(hits(duplicate_every), n - 1).otherwise(n)
    arrived = F.lit(FIRST_INGESTION).cast("timestamp") + F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    happened = arrived - F.make_dt_interval(
        days=F.when(hits(late_every), LATE_DAYS).otherwise(0),
        secs=integer(seed, n, "delay", 0, 120).cast("decimal(18,6)"),
    )
    amount = F.round(uniform(seed, n, "amount") * 2499.0 + 1.0, 2)

    def iso(value: Column) -> Column:
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")

    fields = {
        "transaction_id": uuid5(uuid.NAMESPACE_URL, F.concat(F.lit(f"stream:{seed}:"), source.cast("string"))),
        "event_timestamp": iso(happened),
        "customer_id": padded_id("CUST", integer(seed, n, "customer", 1, 500)),
        "merchant_id": padded_id("MERCH", integer(seed, n, "merchant", 1, 100)),
        "amount": F.when(hits(invalid_every), -1.0).otherwise(amount),
        "currency": choice(seed, n, "currency", CURRENCIES),
        "country": choice(seed, n, "country", COUNTRIES),
        "merchant_category": choice(seed, n, "category", CATEGORIES),
        "payment_method": choice(seed, n, "method", METHODS),
        "device_id": padded_id("DEV", integer(seed, n, "device", 1, 1000)),
        "event_type": choice(seed, n, "type", EVENT_TYPES),
        "ingestion_timestamp": iso(arrived),
    }
    return spark.range(count).select(*[fields[name].alias(name) for name in EVENT_FIELDS])


def as_records(events: DataFrame, topic: str = "transaction-events") -> DataFrame:
    """Events as broker records (one partition, offset in order of ingestion time)."""
    body = F.to_json(F.struct(*sorted(events.columns)))
    moment = F.col("ingestion_timestamp").cast("timestamp")
    return events.select(
        F.encode(body, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (F.unix_timestamp(moment) - F.unix_timestamp(F.lit(FIRST_INGESTION).cast("timestamp"))).alias("offset"),
        moment.alias("timestamp"),
    )
