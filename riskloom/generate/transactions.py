"""Synthetic raw transactions."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.ids import padded_id, uuid5
from riskloom.generate.draws import choice, integer, lognormal, uniform
from riskloom.schemas import COUNTRY_CURRENCY, MERCHANT_CATEGORIES, PAYMENT_METHODS, RAW_TRANSACTION

# Fixed value: namespace of the transaction ids.
NAMESPACE = uuid.UUID("b68dbb32-b9d8-4d3a-a38d-13f956f71f9e")
CUSTOMERS, MERCHANTS, DEVICES = 500, 100, 750
LARGEST = 5000.0


def generate_transactions(
    spark: SparkSession, rows: int, seed: int, start: date, dates: int, partitions: int | None = None
) -> DataFrame:
    """`rows` raw transactions over `dates` days from `start`."""
    if rows < 1 or dates < 1:
        raise ValueError("rows and dates must be positive")
    n = F.col("id")
    amount = F.round(F.least(lognormal(seed, n, "amount", 3.5, 1.0), F.lit(LARGEST)), 2)
    base = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    drawn = base.select(
        n,
        amount.alias("amount"),
        choice(seed, n, "country", list(COUNTRY_CURRENCY)).alias("country"),
        choice(seed, n, "category", MERCHANT_CATEGORIES).alias("merchant_category"),
        choice(seed, n, "method", PAYMENT_METHODS).alias("payment_method"),
    )
    probability = (
        F.lit(0.01)
        + F.when(F.col("amount") > 1000, 0.12).otherwise(0.0)
        + F.when(F.col("merchant_category").isin("electronics", "gift_cards"), 0.05).otherwise(0.0)
        + F.when(F.col("payment_method") == "bank_transfer", 0.03).otherwise(0.0)
    )
    currency = F.element_at(
        F.create_map(*[F.lit(x) for pair in COUNTRY_CURRENCY.items() for x in pair]), F.col("country")
    )
    moment = F.lit(start).cast("timestamp") + F.make_dt_interval(
        days=integer(seed, n, "day", 0, dates - 1).cast("int"),
        secs=integer(seed, n, "second", 0, 86399).cast("decimal(18,6)"),
    )
    name = F.concat(F.lit(f"seed={seed};row="), n.cast("string"))
    return drawn.withColumns(
        {
            "transaction_id": uuid5(NAMESPACE, name),
            "event_timestamp": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
            "customer_id": padded_id("CUST", integer(seed, n, "customer", 1, CUSTOMERS)),
            "merchant_id": padded_id("MERCH", integer(seed, n, "merchant", 1, MERCHANTS)),
            "device_id": padded_id("DEV", integer(seed, n, "device", 1, DEVICES)),
            "currency": currency,
            "is_fraud": uniform(seed, n, "fraud") < probability,
        }
    ).select(*RAW_TRANSACTION.fieldNames())
