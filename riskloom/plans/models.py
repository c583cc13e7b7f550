"""Staging views, fact, dimensions and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.amounts import cents, money_avg, money_sum
from riskloom.functions.risk import HIGH_VALUE, is_high_value, risk_tier
from riskloom.functions.times import delay_seconds, is_late_whole_hours
from riskloom.operators.clean import sort_by_risk
from riskloom.operators.rank import percent_rank
from riskloom.schemas import PROCESSED, STAGING

# Largest amount a streaming event may carry.
MAX_EVENT_AMOUNT = 1_000_000

# Labels of the local stream in its staging view, fixed values.
LOCAL_SOURCE_SYSTEM = "local_redpanda_spark"
VALID = "valid"

_RANKED = [
    "transaction_count", "total_amount", "fraud_count", "fraud_rate", "high_value_transaction_count",
]


def staging(name: str, source: DataFrame) -> DataFrame:
    """Declared columns of a source, in declared order; audit columns may be absent in samples."""
    audit = {"source_file", "processed_at", "feature_generated_at"}
    have = set(source.columns)
    return source.select(*[c for c in STAGING[name] if c in have or c not in audit])


def fct_select(stg: DataFrame) -> DataFrame:
    return stg.select(*PROCESSED.fieldNames())


# --- dimensions -------------------------------------------------------------------


def _activity() -> list:
    return [
        F.min("event_timestamp").alias("first_seen_at"),
        F.max("event_timestamp").alias("last_seen_at"),
        F.count(F.lit(1)).alias("transaction_count"),
    ]


def _uniques(**columns: str) -> list:
    return [F.count_distinct(column).alias(alias) for alias, column in columns.items()]


def dim_customer(fct: DataFrame) -> DataFrame:
    uniques = _uniques(distinct_countries="country", distinct_merchants="merchant_id")
    return fct.groupBy("customer_id").agg(*_activity(), *uniques)


def dim_merchant(fct: DataFrame) -> DataFrame:
    uniques = _uniques(
        distinct_customers="customer_id",
        distinct_categories="merchant_category",
        distinct_countries="country",
    )
    return fct.groupBy("merchant_id").agg(*_activity(), *uniques)


def dim_date(fct: DataFrame) -> DataFrame:
    """Observed dates only; day_of_week 1 is Sunday."""
    dates = fct.groupBy("event_date").agg(F.count(F.lit(1)).alias("transaction_count"))
    return dates.selectExpr(
        "event_date",
        "year(event_date) as calendar_year",
        "quarter(event_date) as calendar_quarter",
        "month(event_date) as calendar_month",
        "dayofmonth(event_date) as day_of_month",
        "dayofweek(event_date) as day_of_week",
        "date_format(event_date, 'EEEE') as day_name",
        "transaction_count",
    )


# --- batch marts ------------------------------------------------------------------


def _ranking(features: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    slim = features.select(*keys, *_RANKED, *extra)
    return percent_rank(slim, ["fraud_rate", "transaction_count"])


def customer_ranking(features: DataFrame) -> DataFrame:
    ranked = _ranking(features, ["customer_id"], ["active_days"])
    return sort_by_risk(ranked.withColumn("risk_tier", risk_tier()))


def merchant_ranking(features: DataFrame) -> DataFrame:
    ranked = _ranking(features, ["merchant_id"], ["active_days"])
    return sort_by_risk(ranked.withColumn("risk_tier", risk_tier()))


def segment_ranking(features: DataFrame) -> DataFrame:
    keys = ["country", "merchant_category", "payment_method"]
    return sort_by_risk(_ranking(features, keys, ["distinct_customers", "distinct_merchants"]))


def daily_kpis(daily: DataFrame) -> DataFrame:
    """Change of two counts against the previous observed date; null on the first.

    The window has no partition, which is safe here: the input holds one row per
    calendar date, so it cannot grow with the number of transactions.
    """
    by_date = Window.orderBy("event_date")

    def change(name: str):
        return (F.col(name) - F.lag(name).over(by_date)).alias(f"{name}_change")

    measures = [
        "transaction_count", "total_amount", "avg_amount", "fraud_count", "fraud_rate",
        "high_value_transaction_count",
    ]
    changes = [change("transaction_count"), change("fraud_count")]
    return daily.select("event_date", *measures, *changes).orderBy("event_date")


def high_risk_daily_trends(high_risk: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    fraud, high = F.col("is_fraud"), is_high_value(threshold)
    return (
        high_risk.groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("high_risk_transaction_count"),
            F.count_if(fraud).alias("known_fraud_count"),
            F.count_if(~fraud & high).alias("high_value_only_count"),
            F.count_if(fraud & high).alias("combined_fraud_and_high_value_count"),
            money_sum("amount").alias("total_high_risk_amount"),
        )
        .orderBy("event_date")
    )


# --- streaming staging and marts -----------------------------------------------------

_EVENT_COLUMNS = [
    "transaction_id", "event_timestamp", "event_date", "event_hour", "customer_id", "merchant_id",
    "amount", "currency", "country", "merchant_category", "payment_method", "device_id",
    "event_type", "ingestion_timestamp",
]


def stg_stream_filter(events: DataFrame) -> DataFrame:
    return events.where("transaction_id is not null and amount > 0")


def stg_stream(events: DataFrame, variant: str = "local") -> DataFrame:
    """One view over either stream: `local` (basic profile) or `strict`."""
    if variant == "local":
        tail = [
            F.col("is_late"),
            F.col("processing_batch_id").cast("long").alias("processing_batch_id"),
            F.col("processing_run_id"),
            F.col("processing_run_id").cast("string").alias("run_id"),
            F.lit(LOCAL_SOURCE_SYSTEM).alias("source_system"),
            F.lit(VALID).alias("validation_status"),
            F.col("ingestion_timestamp").alias("processing_timestamp"),
        ]
    elif variant == "strict":
        tail = [
            is_late_whole_hours().alias("is_late"),
            F.lit(None).cast("long").alias("processing_batch_id"),
            F.col("run_id").alias("processing_run_id"),
            F.col("run_id"),
            F.col("source_system"),
            F.col("validation_status"),
            F.col("processing_timestamp"),
        ]
    else:
        raise ValueError(f"unknown staging variant {variant!r}")
    return stg_stream_filter(events).select(*_EVENT_COLUMNS, *tail)


def _amounts() -> list:
    return [
        cents(money_sum("amount")).alias("total_amount"),
        cents(money_avg("amount")).alias("average_amount"),
    ]


def realtime_trends(stg: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return stg.groupBy("event_date", "event_hour", "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(is_high_value(threshold)).alias("high_value_event_count"),
        *_amounts(),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.max("processing_timestamp").alias("latest_processing_timestamp"),
    )


def event_quality(stg: DataFrame) -> DataFrame:
    amount = F.col("amount")
    bad_amount = amount.isNull() | (amount <= 0) | (amount > MAX_EVENT_AMOUNT)
    return stg.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_id_count"),
        F.count_if(bad_amount).alias("invalid_amount_count"),
        F.count_if("is_late").alias("late_event_count"),
        F.count_distinct("processing_batch_id").alias("processing_batch_count"),
        F.count_distinct("processing_run_id").alias("processing_run_count"),
        cents(F.avg(delay_seconds())).alias("average_ingestion_delay_seconds"),
        F.max("ingestion_timestamp").alias("latest_ingestion_timestamp"),
    )


def streaming_risk_summary(stg: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return stg.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if("is_late").alias("late_event_count"),
        F.count_if(is_high_value(threshold)).alias("high_value_event_count"),
        *_amounts(),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
    )
