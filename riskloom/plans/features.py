"""Risk feature tables, each declared by its keys and its measures.

Distinct counts stay exact. Spark turns them into one Expand over narrow rows
(keys and the counted value only) and removes repeats inside each map task before
the shuffle, so a hot key is spread over (key, value) pairs first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.risk import HIGH_VALUE, is_high_risk, measure, risk_reason
from riskloom.schemas import STAGING

_COMMON = ["transaction_count", "total_amount", "avg_amount"]
_FRAUD = ["fraud_count", "fraud_rate", "high_value_transaction_count"]
_BREADTH = ["distinct_categories", "distinct_countries", "distinct_payment_methods"]
_ACTIVITY = ["active_days", "first_seen_at", "last_seen_at"]


@dataclass(frozen=True)
class FeatureTable:
    name: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]

    def build(self, transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
        columns = [measure(name, threshold) for name in self.measures]
        return transactions.groupBy(*self.keys).agg(*columns)


DAILY = FeatureTable(
    "daily_transaction_summary", ("event_date",), (*_COMMON, "min_amount", "max_amount", *_FRAUD)
)
SEGMENT = FeatureTable(
    "segment_risk_summary",
    ("country", "merchant_category", "payment_method"),
    (*_COMMON, "max_amount", *_FRAUD, "distinct_customers", "distinct_merchants"),
)
CUSTOMER = FeatureTable(
    "customer_risk_features",
    ("customer_id",),
    (*_COMMON, "max_amount", *_FRAUD, "distinct_merchants", *_BREADTH, *_ACTIVITY),
)
MERCHANT = FeatureTable(
    "merchant_risk_features",
    ("merchant_id",),
    (*_COMMON, "max_amount", *_FRAUD, "distinct_customers", *_BREADTH, *_ACTIVITY),
)
FEATURE_TABLES = {t.name: t for t in (DAILY, SEGMENT, CUSTOMER, MERCHANT)}


def daily_summary(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return DAILY.build(transactions, threshold).orderBy("event_date")


def segment_summary(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return SEGMENT.build(transactions, threshold)


def customer_features(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return CUSTOMER.build(transactions, threshold)


def merchant_features(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return MERCHANT.build(transactions, threshold)


def fraud_measures(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """The three fraud measures over the whole table."""
    return transactions.agg(*[measure(name, threshold) for name in _FRAUD])


def high_risk_filter(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    return transactions.where(is_high_risk(threshold))


def high_risk(transactions: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """High-risk rows with the reason; columns in the order of the stored table."""
    rows = high_risk_filter(transactions, threshold).withColumn("risk_reason", risk_reason(threshold))
    return rows.select(*[c for c in STAGING["high_risk_transactions"] if c in rows.columns])


def add_generated_at(features: DataFrame) -> DataFrame:
    return features.withColumn("feature_generated_at", F.current_timestamp())
