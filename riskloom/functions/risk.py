"""Risk measures and predicates shared by features, marts and contracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.amounts import money_avg, money_sum

HIGH_VALUE = 1000.0  # default threshold; every operator takes its own

_DISTINCT = {
    "distinct_customers": "customer_id",
    "distinct_merchants": "merchant_id",
    "distinct_categories": "merchant_category",
    "distinct_countries": "country",
    "distinct_payment_methods": "payment_method",
    "active_days": "event_date",
}


def is_high_value(threshold: float = HIGH_VALUE) -> Column:
    return F.col("amount") >= F.lit(float(threshold))


def is_high_risk(threshold: float = HIGH_VALUE) -> Column:
    """Known fraud or a high amount."""
    return F.col("is_fraud") | is_high_value(threshold)


def risk_reason(threshold: float = HIGH_VALUE) -> Column:
    """Label of a row that satisfies `is_high_risk`."""
    high = is_high_value(threshold)
    return F.when(~F.col("is_fraud"), "high_value").otherwise(
        F.when(high, "known_fraud_and_high_value").otherwise("known_fraud")
    )


def risk_tier(rate: str = "fraud_rate") -> Column:
    """high from 10 %, medium from 5 %, otherwise low."""
    return F.when(F.col(rate) >= 0.10, "high").when(F.col(rate) >= 0.05, "medium").otherwise("low")


def measure(name: str, threshold: float = HIGH_VALUE) -> Column:
    """Aggregate expression behind one feature column."""
    if name in _DISTINCT:
        return F.count_distinct(_DISTINCT[name]).alias(name)
    fraud = F.sum(F.col("is_fraud").cast("int"))
    table = {
        "transaction_count": lambda: F.count(F.lit(1)),
        "total_amount": lambda: money_sum("amount"),
        "avg_amount": lambda: money_avg("amount"),
        "min_amount": lambda: F.min("amount"),
        "max_amount": lambda: F.max("amount"),
        "fraud_count": lambda: fraud,
        "fraud_rate": lambda: F.try_divide(fraud, F.count("is_fraud")),
        "high_value_transaction_count": lambda: F.count_if(is_high_value(threshold)),
        "first_seen_at": lambda: F.min("event_timestamp"),
        "last_seen_at": lambda: F.max("event_timestamp"),
    }
    return table[name]().alias(name)
