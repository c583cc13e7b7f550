"""Independent SQL for the checks: shared common table expressions and their composer.

Only what a query mentions is put in front of it.
"""

from __future__ import annotations

import re

_SECONDS = "((l_partkey * 7919 + l_suppkey * 104729) % 86400)"
_PART = "(source_offset >> 32)"
_ISO = "'%Y-%m-%dT%H:%M:%S'"

CTES: dict[str, str] = {}

CTES["tx"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
       CAST(l_shipdate AS TIMESTAMP) + to_seconds({_SECONDS}) AS event_timestamp,
       CAST(l_shipdate AS DATE) AS event_date,
       CAST({_SECONDS} // 3600 AS INTEGER) AS event_hour,
       printf('CUST_%06d', o_custkey) AS customer_id,
       printf('MERCH_%06d', l_suppkey) AS merchant_id,
       l_extendedprice AS amount,
       CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'GBP'
                        WHEN 3 THEN 'INR' WHEN 4 THEN 'EUR' END AS currency,
       n_name AS country, p_type AS merchant_category, o_orderpriority AS payment_method,
       printf('DEV_%06d', l_partkey % 750 + 1) AS device_id,
       (l_returnflag = 'R' AND l_quantity > 40) AS is_fraud,
       l_partkey * 4294967296 + l_suppkey AS source_offset
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN part ON l_partkey = p_partkey"""

CTES["processed"] = """
SELECT * FROM tx
QUALIFY row_number() OVER (PARTITION BY transaction_id
                           ORDER BY event_timestamp DESC, source_offset DESC) = 1"""

CTES["raw"] = f"""
SELECT CASE WHEN {_PART} % 97 != 0 THEN transaction_id END AS transaction_id,
       CASE WHEN {_PART} % 79 = 0 THEN 'not-a-timestamp'
            ELSE strftime(event_timestamp, {_ISO}) || '+00:00' END AS event_timestamp,
       customer_id, merchant_id,
       CASE WHEN {_PART} % 89 = 0 THEN NULL WHEN {_PART} % 83 = 0 THEN -amount ELSE amount END AS amount,
       currency, country, merchant_category, payment_method, device_id, is_fraud, source_offset
FROM tx"""

CTES["typed"] = """
SELECT transaction_id, CAST(try_cast(event_timestamp AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS event_timestamp,
       CAST(CAST(try_cast(event_timestamp AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS DATE) AS event_date,
       CAST(hour(CAST(try_cast(event_timestamp AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP)) AS INTEGER) AS event_hour,
       customer_id, merchant_id, amount, currency, country, merchant_category, payment_method,
       device_id, is_fraud, source_offset
FROM raw"""

CTES["clean"] = """
SELECT * FROM typed
WHERE transaction_id IS NOT NULL AND event_timestamp IS NOT NULL AND amount > 0"""

CTES["clean_latest"] = """
SELECT * FROM clean
QUALIFY row_number() OVER (PARTITION BY transaction_id
                           ORDER BY event_timestamp DESC, source_offset DESC) = 1"""

_TOTAL = "CAST(SUM(CAST(amount AS DECIMAL(22,4))) AS DOUBLE)"
_MONEY = f"""CAST(COUNT(*) AS BIGINT) AS transaction_count,
       {_TOTAL} AS total_amount, {_TOTAL} / COUNT(amount) AS avg_amount"""
_FRAUD = """CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_count,
       CAST(SUM(CAST(is_fraud AS INTEGER)) AS DOUBLE) / COUNT(is_fraud) AS fraud_rate,
       CAST(SUM(CASE WHEN amount >= 90000 THEN 1 ELSE 0 END) AS BIGINT) AS high_value_transaction_count"""
_BREADTH = """COUNT(DISTINCT merchant_category) AS distinct_categories,
       COUNT(DISTINCT country) AS distinct_countries,
       COUNT(DISTINCT payment_method) AS distinct_payment_methods,
       COUNT(DISTINCT event_date) AS active_days,
       MIN(event_timestamp) AS first_seen_at, MAX(event_timestamp) AS last_seen_at"""

CTES["daily"] = f"""
SELECT event_date, {_MONEY}, MIN(amount) AS min_amount, MAX(amount) AS max_amount, {_FRAUD}
FROM processed GROUP BY event_date"""
CTES["segment"] = f"""
SELECT country, merchant_category, payment_method, {_MONEY}, MAX(amount) AS max_amount, {_FRAUD},
       COUNT(DISTINCT customer_id) AS distinct_customers, COUNT(DISTINCT merchant_id) AS distinct_merchants
FROM processed GROUP BY country, merchant_category, payment_method"""
CTES["customer_features"] = f"""
SELECT customer_id, {_MONEY}, MAX(amount) AS max_amount, {_FRAUD},
       COUNT(DISTINCT merchant_id) AS distinct_merchants, {_BREADTH}
FROM processed GROUP BY customer_id"""
CTES["merchant_features"] = f"""
SELECT merchant_id, {_MONEY}, MAX(amount) AS max_amount, {_FRAUD},
       COUNT(DISTINCT customer_id) AS distinct_customers, {_BREADTH}
FROM processed GROUP BY merchant_id"""
CTES["high_risk"] = """
SELECT transaction_id, event_timestamp, event_date, event_hour, customer_id, merchant_id, amount,
       currency, country, merchant_category, payment_method, device_id, is_fraud,
       CASE WHEN is_fraud AND amount >= 90000 THEN 'known_fraud_and_high_value'
            WHEN is_fraud THEN 'known_fraud' ELSE 'high_value' END AS risk_reason
FROM processed WHERE is_fraud OR amount >= 90000"""

# --- events -------------------------------------------------------------------------

_N = "event_id"
_EVENT_ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
CTES["event_times"] = f"""
SELECT *, CAST(ts AS TIMESTAMP) + to_days(CASE WHEN {_N} % 30 = 0 THEN 2 ELSE 0 END)
          + to_seconds({_N} % 120) AS arrived
FROM events"""
CTES["event_moments"] = f"""
SELECT *, CASE WHEN {_N} % 139 = 0 THEN arrived + to_hours(1) ELSE CAST(ts AS TIMESTAMP) END AS happened
FROM event_times"""
CTES["records"] = f"""
SELECT CASE WHEN {_N} % 101 = 0 THEN '{{not-json ' || CAST({_N} AS VARCHAR)
            WHEN {_N} % 127 = 0 THEN '[' || CAST({_N} AS VARCHAR) || ']'
            ELSE '{{"transaction_id": "EVT_' || CAST(CASE WHEN {_N} % 25 = 0 AND {_N} > 0 THEN {_N} - 1 ELSE {_N} END AS VARCHAR)
      || '", "event_timestamp": "' || strftime(happened, {_EVENT_ISO}) || CASE WHEN {_N} % 113 = 0 THEN '' ELSE '+00:00' END
      || '", "customer_id": ' || CASE WHEN {_N} % 107 = 0 THEN CAST({_N} AS VARCHAR) ELSE printf('"CUST_%06d"', user_id) END
      || ', "merchant_id": "' || CASE WHEN {_N} % 137 = 0 THEN '' ELSE printf('MERCH_%06d', {_N} % 100 + 1) END
      || '", "amount": ' || CASE WHEN {_N} % 109 = 0 THEN '-1.00' WHEN {_N} % 149 = 0 THEN '1000001.00'
                                ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END
      || ', "currency": "' || CASE WHEN user_id % 2 = 0 THEN 'USD' ELSE 'CAD' END
      || '", "country": "' || CASE WHEN user_id % 2 = 0 THEN 'US' ELSE 'CA' END
      || '", "merchant_category": "' || CASE {_N} % 4 WHEN 0 THEN 'fuel' WHEN 1 THEN 'grocery' WHEN 2 THEN 'restaurant' ELSE 'travel' END
      || '", "payment_method": "' || CASE {_N} % 3 WHEN 0 THEN 'bank_transfer' WHEN 1 THEN 'credit_card' ELSE 'debit_card' END
      || '"' || CASE WHEN {_N} % 131 = 0 THEN '' ELSE printf(', "device_id": "DEV_%06d"', {_N} % 1000 + 1) END
      || ', "event_type": "' || event_type
      || '", "ingestion_timestamp": "' || strftime(arrived, {_EVENT_ISO}) || '+00:00"'
      || CASE WHEN {_N} % 103 = 0 THEN ', "promo_code": "X1"' ELSE '' END || '}}' END AS raw_json,
       'transaction-events' AS topic, CAST({_N} % 3 AS INTEGER) AS kafka_partition,
       {_N} AS kafka_offset, arrived AS kafka_timestamp
FROM event_moments"""

_FIELDS = [
    "transaction_id", "event_timestamp", "customer_id", "merchant_id", "amount", "currency", "country",
    "merchant_category", "payment_method", "device_id", "event_type", "ingestion_timestamp",
]
_FIELD_LIST = "[" + ", ".join(f"'{f}'" for f in _FIELDS) + "]"


def _text(field: str) -> str:
    return f"CASE WHEN is_object THEN raw_json ->> '$.{field}' END AS {field}"


CTES["json_kind"] = """
SELECT *, json_valid(raw_json) AS is_json,
       COALESCE(CASE WHEN json_valid(raw_json) THEN json_type(raw_json) = 'OBJECT' END, false) AS is_object
FROM records"""
CTES["parsed"] = f"""
SELECT raw_json, topic, kafka_partition, kafka_offset, kafka_timestamp,
       CASE WHEN is_object THEN CAST(len(list_filter(json_keys(raw_json), lambda k: NOT list_contains({_FIELD_LIST}, k))) AS INTEGER) END
           AS unexpected_field_count,
       {", ".join(_text(f) for f in _FIELDS if f != "amount")},
       CASE WHEN is_object THEN try_cast(raw_json ->> '$.amount' AS DOUBLE) END AS amount
FROM json_kind"""


def _instant(field: str) -> str:
    return f"CAST(try_cast({field} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP)"


CTES["typed_events"] = f"""
SELECT raw_json, topic, kafka_partition, kafka_offset, kafka_timestamp, unexpected_field_count,
       transaction_id, {_instant("event_timestamp")} AS event_timestamp, customer_id, merchant_id, amount,
       currency, country, merchant_category, payment_method, device_id, event_type,
       {_instant("ingestion_timestamp")} AS ingestion_timestamp,
       CAST({_instant("event_timestamp")} AS DATE) AS event_date,
       CAST(hour({_instant("event_timestamp")}) AS INTEGER) AS event_hour
FROM parsed"""
CTES["bronze"] = """
SELECT *, CASE WHEN NOT is_valid THEN 'schema_or_value_contract_failed' END AS validation_error
FROM (SELECT *, COALESCE(amount > 0 AND unexpected_field_count = 0 AND transaction_id IS NOT NULL
        AND event_timestamp IS NOT NULL AND ingestion_timestamp IS NOT NULL AND customer_id IS NOT NULL
        AND merchant_id IS NOT NULL AND currency IS NOT NULL AND country IS NOT NULL
        AND merchant_category IS NOT NULL AND payment_method IS NOT NULL AND device_id IS NOT NULL
        AND event_type IN ('click', 'view', 'purchase', 'signup'), false) AS is_valid,
        event_timestamp < ingestion_timestamp - INTERVAL 24 HOURS AS is_late
      FROM typed_events)"""
CTES["silver"] = """
SELECT * EXCLUDE (is_valid, validation_error) FROM bronze WHERE is_valid
QUALIFY row_number() OVER (PARTITION BY transaction_id
                           ORDER BY ingestion_timestamp DESC, kafka_offset DESC) = 1"""
CTES["stg_local"] = """
SELECT transaction_id, event_timestamp, event_date, event_hour, customer_id, merchant_id, amount, currency,
       country, merchant_category, payment_method, device_id, event_type, ingestion_timestamp, is_late,
       CAST(0 AS BIGINT) AS processing_batch_id, 'run-1' AS processing_run_id, 'run-1' AS run_id,
       'local_redpanda_spark' AS source_system, 'valid' AS validation_status,
       ingestion_timestamp AS processing_timestamp
FROM silver WHERE transaction_id IS NOT NULL AND amount > 0"""

# Strict profile: error codes as a sorted list.
_STRINGS = [
    "transaction_id", "customer_id", "merchant_id", "currency", "country", "merchant_category",
    "payment_method", "device_id",
]


def _kind(field: str) -> str:
    return f"json_type(raw_json, '$.{field}')"


_ERRORS = [
    f"CASE WHEN len(list_filter(json_keys(raw_json), lambda k: NOT list_contains({_FIELD_LIST}, k))) > 0 "
    f"THEN 'unexpected_fields:' || array_to_string(list_sort(list_filter(json_keys(raw_json), "
    f"lambda k: NOT list_contains({_FIELD_LIST}, k))), ',') END"
]
_ERRORS += [
    f"CASE WHEN COALESCE({_kind(f)}, 'NULL') = 'NULL' OR ({_kind(f)} = 'VARCHAR' AND raw_json ->> '$.{f}' = '') "
    f"THEN 'missing_{f}' END"
    for f in _FIELDS
]
_ERRORS += [
    f"CASE WHEN {_kind(f)} IS NOT NULL AND {_kind(f)} != 'VARCHAR' THEN 'invalid_{f}' END" for f in _STRINGS
]
_ERRORS += [
    f"CASE WHEN NOT COALESCE({_kind('amount')} IN ('DOUBLE', 'BIGINT', 'UBIGINT') AND amount_value > 0 "
    f"AND amount_value <= 1000000, false) THEN 'invalid_amount' END",
    f"CASE WHEN NOT COALESCE({_kind('event_type')} = 'VARCHAR' AND raw_json ->> '$.event_type' IN "
    f"('click', 'view', 'purchase', 'signup'), false) THEN 'invalid_event_type' END",
    "CASE WHEN happened_at IS NULL THEN 'invalid_event_timestamp' END",
    "CASE WHEN arrived_at IS NULL THEN 'invalid_ingestion_timestamp' END",
    "CASE WHEN happened_at > arrived_at THEN 'event_timestamp_after_ingestion_timestamp' END",
]


def _offset_instant(field: str) -> str:
    value = f"raw_json ->> '$.{field}'"
    return (
        f"CASE WHEN {_kind(field)} = 'VARCHAR' AND regexp_matches({value}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$') "
        f"THEN CAST(try_cast({value} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) END"
    )


CTES["json_values"] = f"""
SELECT *, CASE WHEN is_object THEN try_cast(raw_json ->> '$.amount' AS DOUBLE) END AS amount_value,
       CASE WHEN is_object THEN {_offset_instant("event_timestamp")} END AS happened_at,
       CASE WHEN is_object THEN {_offset_instant("ingestion_timestamp")} END AS arrived_at
FROM json_kind"""
CTES["strict"] = f"""
SELECT *, CASE WHEN NOT is_json THEN ['invalid_json']
               WHEN NOT is_object THEN ['event_not_json_object']
               ELSE list_sort(list_distinct(list_filter([{", ".join(_ERRORS)}], lambda e: e IS NOT NULL))) END AS errors
FROM json_values"""
CTES["strict_valid"] = f"""
SELECT {", ".join(f"raw_json ->> '$.{f}' AS {f}" for f in _FIELDS if f not in ("amount", "event_timestamp", "ingestion_timestamp"))},
       happened_at AS event_timestamp, arrived_at AS ingestion_timestamp, amount_value AS amount,
       CAST(happened_at AS DATE) AS event_date, CAST(hour(happened_at) AS INTEGER) AS event_hour,
       'run-1' AS run_id, 'gcp_pubsub' AS source_system, 'valid' AS validation_status
FROM strict WHERE len(errors) = 0"""



def compose(sql: str) -> str:
    """Put the mentioned expressions, and those they mention, in front of the query."""
    order: list[str] = []

    def visit(text: str) -> None:
        # Names count only where a table may stand: after FROM, JOIN or a comma list.
        for name in re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", text):
            if name in CTES and name not in order:
                visit(CTES[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {head},\n{sql.lstrip()[5:]}"
    return f"WITH {head}\n{sql.strip()}"
