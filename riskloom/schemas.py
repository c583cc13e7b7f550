"""Table layouts. Column names, order and types are the data contract."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), "date": T.DateType(), "int": T.IntegerType(),
    "long": T.LongType(), "binary": T.BinaryType(),
}


def _struct(spec: str) -> T.StructType:
    """Build a schema from one `name type` pair per comma (works without a session)."""
    fields = [pair.split() for pair in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_TRANSACTION = _struct(
    "transaction_id string, event_timestamp string, customer_id string, merchant_id string,"
    "amount double, currency string, country string, merchant_category string,"
    "payment_method string, device_id string, is_fraud boolean"
)

# The raw contract must see the text of every field, also of the typed ones.
RAW_TRANSACTION_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_TRANSACTION])

PROCESSED = _struct(
    "transaction_id string, event_timestamp timestamp, event_date date, event_hour int,"
    "customer_id string, merchant_id string, amount double, currency string, country string,"
    "merchant_category string, payment_method string, device_id string, is_fraud boolean,"
    "source_file string, processed_at timestamp"
)

# Streaming JSON event: twelve fields, no others allowed.
EVENT = _struct(
    "transaction_id string, event_timestamp string, customer_id string, merchant_id string,"
    "amount double, currency string, country string, merchant_category string,"
    "payment_method string, device_id string, event_type string, ingestion_timestamp string"
)
EVENT_FIELDS = EVENT.fieldNames()

# One record as a message broker delivers it.
RECORD = _struct("value binary, topic string, partition int, offset long, timestamp timestamp")

BRONZE = _struct(
    "raw_json string, topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp,"
    "unexpected_field_count int, transaction_id string, event_timestamp timestamp, customer_id string,"
    "merchant_id string, amount double, currency string, country string, merchant_category string,"
    "payment_method string, device_id string, event_type string, ingestion_timestamp timestamp,"
    "event_date date, event_hour int, is_valid boolean, validation_error string, is_late boolean"
)
SILVER = T.StructType(
    [f for f in BRONZE if f.name not in ("is_valid", "validation_error")]
).add("processing_batch_id", T.LongType()).add("processing_run_id", T.StringType())

# Strict-profile tables; a name in STRICT_REQUIRED may not hold null.
STRICT_EVENT = _struct(
    "transaction_id string, event_timestamp timestamp, ingestion_timestamp timestamp,"
    "processing_timestamp timestamp, customer_id string, merchant_id string, amount double,"
    "currency string, country string, merchant_category string, payment_method string,"
    "device_id string, event_type string, event_date date, event_hour int, run_id string,"
    "source_system string, validation_status string"
)
STRICT_QUARANTINE = _struct(
    "raw_payload string, error_reason string, error_field string, ingestion_timestamp timestamp,"
    "processing_timestamp timestamp, run_id string"
)
STRICT_OBSERVATION = _struct(
    "observation_timestamp timestamp, run_id string, metric_name string, metric_value double,"
    "status string, severity string, details string"
)
STRICT_REQUIRED = {
    "events": STRICT_EVENT.fieldNames(),
    "quarantine": ["raw_payload", "error_reason", "processing_timestamp", "run_id"],
    "observations": [n for n in STRICT_OBSERVATION.fieldNames() if n != "details"],
}

BATCH_METRICS = _struct(
    "pipeline_name string, processing_run_id string, batch_id long, input_count long, valid_count long,"
    "clean_count long, invalid_count long, duplicate_count long, late_count long,"
    "schema_drift_count long, dlq_count long, risk_alert_count long, risk_detected_count long,"
    "processing_timestamp string, processing_duration_seconds double, reconciliation boolean"
)

OBSERVATION = _struct(
    "pipeline_name string, run_id string, table_name string, metric_name string, metric_value double,"
    "expected_min double, expected_max double, status string, severity string, details string,"
    "observation_timestamp timestamp"
)

CHECK_RESULT = _struct("table_name string, check string, failures long, status string")

# Columns each staging view exposes, in order.
_FEATURE_TAIL = ["active_days", "first_seen_at", "last_seen_at", "feature_generated_at"]
STAGING = {
    "processed_transactions": PROCESSED.fieldNames(),
    "daily_transaction_summary": [
        "event_date", "transaction_count", "total_amount", "avg_amount", "min_amount", "max_amount",
        "fraud_count", "fraud_rate", "high_value_transaction_count", "feature_generated_at",
    ],
    "segment_risk_summary": [
        "country", "merchant_category", "payment_method", "transaction_count", "total_amount",
        "avg_amount", "max_amount", "fraud_count", "fraud_rate", "high_value_transaction_count",
        "distinct_customers", "distinct_merchants", "feature_generated_at",
    ],
    "customer_risk_features": [
        "customer_id", "transaction_count", "total_amount", "avg_amount", "max_amount", "fraud_count",
        "fraud_rate", "high_value_transaction_count", "distinct_merchants", "distinct_categories",
        "distinct_countries", "distinct_payment_methods", *_FEATURE_TAIL,
    ],
    "merchant_risk_features": [
        "merchant_id", "transaction_count", "total_amount", "avg_amount", "max_amount", "fraud_count",
        "fraud_rate", "high_value_transaction_count", "distinct_customers", "distinct_categories",
        "distinct_countries", "distinct_payment_methods", *_FEATURE_TAIL,
    ],
    "high_risk_transactions": [
        *PROCESSED.fieldNames()[:13], "risk_reason", "source_file", "processed_at", "feature_generated_at",
    ],
}

# Fixed values of the raw contract and the generator.
COUNTRY_CURRENCY = {"US": "USD", "CA": "CAD", "GB": "GBP", "IN": "INR", "DE": "EUR"}
MERCHANT_CATEGORIES = [
    "grocery", "restaurant", "travel", "electronics", "fuel", "entertainment", "gift_cards",
]
PAYMENT_METHODS = ["credit_card", "debit_card", "digital_wallet", "bank_transfer"]
EVENT_TYPES = ["authorization", "purchase", "refund"]
RISK_REASONS = ["known_fraud_and_high_value", "known_fraud", "high_value"]
