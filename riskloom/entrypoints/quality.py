"""Contract, comparison and reconciliation queries.

The given tables are clean, so most queries here check tables into which faults were
put by plain arithmetic; the same expressions stand in the SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.entrypoints.inputs import (
    LIMIT,
    discard,
    feature,
    high_risk,
    processed,
    stored,
    stored_feature,
    stored_processed,
    typed,
)
from riskloom.entrypoints.oracle import CTES
from riskloom.entrypoints.registry import query
from riskloom.operators import compare
from riskloom.plans import features, models
from riskloom.quality import rulesets
from riskloom.quality.rules import evaluate, row_rule, total_equals
from riskloom.session import shuffles_end_with_the_run
from riskloom.sources import star_schema as star

# Faults for feature tables: valid in Spark SQL and in the oracle alike.
SPOILED = {
    "fraud_count": "CASE WHEN transaction_count % 7 = 0 THEN -1 ELSE fraud_count END",
    "fraud_rate": "CASE WHEN transaction_count % 11 = 0 THEN 1.5 WHEN transaction_count % 13 = 0 THEN NULL ELSE fraud_rate END",
    "high_value_transaction_count": "CASE WHEN transaction_count % 5 = 0 THEN transaction_count + 1 ELSE high_value_transaction_count END",
    "active_days": "CASE WHEN transaction_count % 17 = 0 THEN 0 ELSE active_days END",
    "first_seen_at": "CASE WHEN transaction_count % 19 = 0 THEN NULL ELSE first_seen_at END",
    "min_amount": "CASE WHEN transaction_count % 3 = 0 THEN avg_amount + 1 ELSE min_amount END",
    "distinct_customers": "CASE WHEN transaction_count % 23 = 0 THEN 0 ELSE distinct_customers END",
}


def spoil(frame):
    return frame.withColumns({c: F.expr(SPOILED[c].replace("1.5", "1.5D")) for c in SPOILED if c in frame.columns})


def _spoiled(table: str, columns: list[str]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{SPOILED[c]} AS {c}' for c in columns)}) FROM {table}"


_BASE = ["fraud_count", "fraud_rate", "high_value_transaction_count"]
CTES["bad_customers"] = _spoiled("customer_features", [*_BASE, "active_days", "first_seen_at"])
CTES["bad_merchants"] = _spoiled("merchant_features", [*_BASE, "active_days", "first_seen_at", "distinct_customers"])
CTES["bad_daily"] = _spoiled("daily", [*_BASE, "min_amount"])
CTES["bad_segments"] = _spoiled("segment", [*_BASE, "distinct_customers"])


def _result(table_name: str, source: str, rules: dict[str, str]) -> str:
    """Oracle for a contract: a count per rule, from plain SQL conditions or aggregates."""
    parts = [
        f"SELECT '{table_name}' AS table_name, '{name}' AS \"check\", CAST({agg} AS BIGINT) AS failures FROM {source}"
        for name, agg in rules.items()
    ]
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
        + " UNION ALL ".join(parts) + ") AS checks"
    )


def _bad(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def _shared(keys: list[str]) -> dict[str, str]:
    nulls = " OR ".join(f"{k} IS NULL" for k in keys)
    key = ", ".join(keys)
    rules = {
        "null_key": _bad(nulls),
        "grain_" + "_".join(keys): f"COUNT(*) - COUNT(DISTINCT ({key}))" if len(keys) > 1 else f"COUNT(*) - COUNT(DISTINCT {key})",
        "transaction_count_not_positive": _bad("transaction_count IS NULL OR transaction_count <= 0"),
        "range_fraud_count": _bad("fraud_count IS NULL OR fraud_count < 0 OR fraud_count > transaction_count"),
        "range_fraud_rate": _bad("fraud_rate IS NULL OR fraud_rate < 0 OR fraud_rate > 1"),
        "fraud_rate_inconsistent": _bad("abs(fraud_rate - fraud_count / transaction_count) > 0.000001"),
        "range_high_value_transaction_count": _bad(
            "high_value_transaction_count IS NULL OR high_value_transaction_count < 0 "
            "OR high_value_transaction_count > transaction_count"
        ),
    }
    return rules


def _party(key: str) -> dict[str, str]:
    return {
        **_shared([key]),
        "range_active_days": _bad("active_days IS NULL OR active_days < 1 OR active_days > transaction_count"),
        "activity_window": _bad("first_seen_at IS NULL OR last_seen_at IS NULL OR first_seen_at > last_seen_at"),
    }


# --- raw, processed ------------------------------------------------------------------------

_P = "(source_offset >> 32)"
CTES["raw_text"] = f"""
SELECT transaction_id,
       CASE WHEN {_P} % 73 = 0 THEN replace(event_timestamp, '+00:00', '') ELSE event_timestamp END AS event_timestamp,
       CASE WHEN {_P} % 71 = 0 THEN 'n/a' ELSE CAST(amount AS VARCHAR) END AS amount,
       CASE WHEN {_P} % 67 = 0 THEN 'XXX' ELSE currency END AS currency,
       CASE WHEN {_P} % 61 = 0 THEN 'ATLANTIS' ELSE country END AS country,
       CASE WHEN {_P} % 59 = 0 THEN 'gambling' ELSE merchant_category END AS merchant_category,
       CASE WHEN {_P} % 53 = 0 THEN NULL ELSE payment_method END AS payment_method,
       CASE WHEN {_P} % 47 = 0 THEN 'yes' WHEN is_fraud THEN 'True' ELSE 'False' END AS is_fraud
FROM raw"""
CTES["conformity"] = """
SELECT n_name AS country, CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'GBP'
       WHEN 3 THEN 'INR' WHEN 4 THEN 'EUR' END AS expected_currency FROM nation"""
CTES["conformed"] = "SELECT * FROM raw_text LEFT JOIN conformity USING (country)"

_CATEGORIES = ["ECONOMY", "SMALL", "MEDIUM", "LARGE", "STANDARD", "PROMO"]
_METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def raw_text(spark, d):
    """Raw rows as text with more faults than `raw_transactions` has."""
    p = F.shiftright("source_offset", 32)

    def fault(divisor: int, value, column: str):
        return F.when(p % divisor == 0, value).otherwise(F.col(column)).alias(column)

    rows = star.raw_transactions(spark, d).withColumns(
        {"is_fraud": F.when(F.col("is_fraud"), "True").otherwise("False"), "amount": F.col("amount").cast("string")}
    )
    return rows.select(
        "transaction_id",
        fault(73, F.replace("event_timestamp", F.lit("+00:00"), F.lit("")), "event_timestamp"),
        fault(71, F.lit("n/a"), "amount"),
        fault(67, F.lit("XXX"), "currency"),
        fault(61, F.lit("ATLANTIS"), "country"),
        fault(59, F.lit("gambling"), "merchant_category"),
        fault(53, F.lit(None), "payment_method"),
        fault(47, F.lit("yes"), "is_fraud"),
    )


def conformity(spark, d):
    return star.table(spark, d, "nation").select(F.col("n_name").alias("country"), star._currency().alias("expected_currency"))


_STAMP = "regexp_matches(event_timestamp, '^[0-9]{4}-')"
_RAW_BAD = {
    "id_empty": "COALESCE(transaction_id, '') = ''",
    "timestamp_unparseable": f"NOT {_STAMP}",
    "timestamp_without_offset": f"{_STAMP} AND NOT suffix(event_timestamp, '+00:00')",
    "amount_not_numeric": "try_cast(amount AS DOUBLE) IS NULL",
    "amount_not_positive": "try_cast(amount AS DOUBLE) <= 0",
    "country_unknown": "expected_currency IS NULL",
    "currency_mismatch": "expected_currency IS NOT NULL AND currency IS DISTINCT FROM expected_currency",
    "category_unknown": f"COALESCE(merchant_category NOT IN ({str(_CATEGORIES)[1:-1]}), true)",
    "payment_method_unknown": f"COALESCE(payment_method NOT IN ({str(_METHODS)[1:-1]}), true)",
    "is_fraud_not_boolean": "is_fraud NOT IN ('True', 'False')",
}
_BROKEN = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in _RAW_BAD.items())


@query(
    "q1_raw_contract",
    _result("raw_transactions", "conformed", {
        **{name: _bad(bad) for name, bad in _RAW_BAD.items()},
        "id_duplicate": "COUNT(transaction_id) - COUNT(DISTINCT transaction_id)",
        "not_empty": "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END",
    }),
)
def q1(spark, d):
    return rulesets.raw_contract(raw_text(spark, d), conformity(spark, d), categories=_CATEGORIES, methods=_METHODS)


@query(
    "q1_raw_summary",
    """SELECT COUNT(*) AS row_count, COUNT(DISTINCT transaction_id) AS unique_ids,
              COUNT(*) FILTER (WHERE is_fraud = 'True') AS fraud_rows FROM raw_text""",
)
def q1_summary(spark, d):
    return rulesets.raw_summary(raw_text(spark, d))


@query(
    "q1_first_errors",
    f"""SELECT transaction_id, broken_rules FROM (
          SELECT transaction_id, list_sort(list_filter([{_BROKEN}], lambda r: r IS NOT NULL)) AS broken_rules FROM conformed)
        WHERE len(broken_rules) > 0 ORDER BY transaction_id NULLS FIRST, broken_rules LIMIT 20""",
)
def q1_errors(spark, d):
    return rulesets.first_errors(raw_text(spark, d), conformity(spark, d), categories=_CATEGORIES, methods=_METHODS)


@query(
    "j11_currency_mismatch",
    """SELECT transaction_id, country, currency,
              CASE WHEN expected_currency IS NULL THEN 'unknown_country' ELSE 'currency_mismatch' END AS problem
       FROM conformed WHERE expected_currency IS NULL OR currency IS DISTINCT FROM expected_currency""",
)
def j11(spark, d):
    found = compare.currency_mismatch(raw_text(spark, d), conformity(spark, d))
    return found.select("transaction_id", "country", "currency", "problem")


@query(
    "q2_processed_contract",
    _result("processed_transactions", "typed", {
        "not_empty": "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END",
        "grain_transaction_id": "COUNT(*) - COUNT(DISTINCT transaction_id) - MAX(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END)",
        "not_null_transaction_id": _bad("transaction_id IS NULL"),
        "not_null_event_timestamp": _bad("event_timestamp IS NULL"),
        "not_null_event_date": _bad("event_date IS NULL"),
        "amount_not_positive": _bad("amount IS NULL OR amount <= 0"),
        "hour_out_of_range": _bad("event_hour IS NULL OR event_hour NOT BETWEEN 0 AND 23"),
        "expected_rows": "CASE WHEN COUNT(*) != 100350 THEN 1 ELSE 0 END",
        "expected_dates": "CASE WHEN COUNT(DISTINCT event_date) != 31 THEN 1 ELSE 0 END",
    }),
)
def q2(spark, d):
    return rulesets.processed_contract(typed(spark, d), rows=100350, dates=31, source_file=False)


@query(
    "a13_contract_row",
    """SELECT COUNT(*) AS row_count, COUNT(DISTINCT transaction_id) AS unique_transaction_ids,
              COUNT(*) FILTER (WHERE transaction_id IS NULL) AS null_transaction_ids,
              COUNT(*) FILTER (WHERE event_timestamp IS NULL) AS null_event_timestamps,
              COUNT(*) FILTER (WHERE event_date IS NULL) AS null_event_dates,
              COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_customer_ids,
              COUNT(*) FILTER (WHERE merchant_id IS NULL) AS null_merchant_ids,
              COUNT(*) FILTER (WHERE amount IS NULL OR amount <= 0) AS invalid_amount_rows,
              COUNT(*) FILTER (WHERE event_hour IS NULL OR event_hour < 0 OR event_hour > 23) AS invalid_event_hour_rows,
              COUNT(*) FILTER (WHERE is_fraud) AS fraud_rows, COUNT(DISTINCT event_date) AS distinct_event_dates,
              MIN(event_date) AS min_event_date, MAX(event_date) AS max_event_date FROM typed""",
)
def a13(spark, d):
    return rulesets.contract_row(typed(spark, d))


@query(
    "a15_date_bounds",
    """SELECT MIN(event_date) AS min_event_date, MAX(event_date) AS max_event_date,
              COUNT(DISTINCT event_date) AS event_date_count FROM tx""",
)
def a15(spark, d):
    return rulesets.date_bounds(star.transactions(spark, d, ["event_date"]))


# --- feature contracts ---------------------------------------------------------------------------


_ROWS = "CASE WHEN COUNT(*) != {} THEN 1 ELSE 0 END"


@query("q3_customer_contract", _result("customer_risk_features", "bad_customers", {**_party("customer_id"), "expected_rows": _ROWS.format(15_000)}))
def q3(spark, d):
    return rulesets.customer_contract(spoil(feature(spark, d, "customer_risk_features")), 15_000)


@query("q4_merchant_contract", _result("merchant_risk_features", "bad_merchants", {**_party("merchant_id"), "expected_rows": _ROWS.format(100)}))
def q4(spark, d):
    return rulesets.merchant_contract(spoil(feature(spark, d, "merchant_risk_features")), 100)


_TOTAL_CHECK = "CASE WHEN COALESCE(SUM(transaction_count), 0) != 100350 THEN 1 ELSE 0 END"


@query(
    "q5_daily_contract",
    _result("daily_transaction_summary", "bad_daily", {
        **_shared(["event_date"]),
        "amount_order": _bad("NOT COALESCE(min_amount > 0 AND min_amount <= avg_amount AND avg_amount <= max_amount, false)"),
        "total_transaction_count": _TOTAL_CHECK, "expected_rows": _ROWS.format(31),
    }),
)
def q5(spark, d):
    return rulesets.daily_contract(spoil(feature(spark, d, "daily_transaction_summary")), 31, 100350)


_SEGMENT_RULES = {
    **_shared(rulesets.SEGMENT_KEY),
    "range_distinct_customers": _bad("distinct_customers IS NULL OR distinct_customers < 1 OR distinct_customers > transaction_count"),
    "range_distinct_merchants": _bad("distinct_merchants IS NULL OR distinct_merchants < 1 OR distinct_merchants > transaction_count"),
}


@query(
    "q6_segment_contract",
    _result("segment_risk_summary", "bad_segments", {**_SEGMENT_RULES, "total_transaction_count": _TOTAL_CHECK, "expected_rows": _ROWS.format(140)}),
)
def q6(spark, d):
    return rulesets.segment_contract(spoil(feature(spark, d, "segment_risk_summary")), 140, 100350)


def _high_risk_rules(limit: int) -> dict[str, str]:
    return {
        "not_null_transaction_id": _bad("transaction_id IS NULL"),
        "grain_transaction_id": "COUNT(*) - COUNT(DISTINCT transaction_id)",
        "rule_does_not_hold": _bad(f"is_fraud IS NULL OR amount IS NULL OR NOT (is_fraud OR amount >= {limit})"),
        "reason_unknown": _bad("COALESCE(risk_reason NOT IN ('known_fraud_and_high_value', 'known_fraud', 'high_value'), true)"),
        "reason_known_fraud_and_high_value": _bad(f"risk_reason = 'known_fraud_and_high_value' AND NOT (is_fraud AND amount >= {limit})"),
        "reason_known_fraud": _bad(f"risk_reason = 'known_fraud' AND NOT (is_fraud AND amount < {limit})"),
        "reason_high_value": _bad(f"risk_reason = 'high_value' AND NOT (NOT is_fraud AND amount >= {limit})"),
        "not_null_event_date": _bad("event_date IS NULL"),
    }


# Rows labelled at 90,000 are checked at 95,000, so some labels must be found wrong.
@query("q7_high_risk_contract", _result("high_risk_transactions", "high_risk", {**_high_risk_rules(95000), "expected_rows": _ROWS.format(2_000)}))
def q7(spark, d):
    return rulesets.high_risk_contract(high_risk(spark, d), 95000.0, 2_000)


@query(
    "q10d_high_risk_violations",
    """SELECT transaction_id FROM high_risk WHERE NOT (is_fraud OR amount >= 95000)
       OR (risk_reason = 'known_fraud_and_high_value' AND (NOT is_fraud OR amount < 95000))
       OR (risk_reason = 'known_fraud' AND (NOT is_fraud OR amount >= 95000))
       OR (risk_reason = 'high_value' AND (is_fraud OR amount < 95000))""",
)
def q10d(spark, d):
    return rulesets.high_risk_violations(high_risk(spark, d), 95000.0)


def _settled(results):
    """Results of checks, stored when they are found: what was shuffled for them goes before the next checks begin."""
    return stored(results, "checks")


def _clean_tables(spark, d):
    """The six stored tables, each written once from one stored fact."""
    fact = stored_processed(spark, d)
    tables = {"processed_transactions": fact}
    tables |= {name: stored_feature(fact, name) for name in features.FEATURE_TABLES}
    return tables | {"high_risk_transactions": stored(features.high_risk(fact, LIMIT), "high_risk")}


_PROCESSED_RULES = {
    "not_empty": "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END",
    "grain_transaction_id": "COUNT(*) - COUNT(DISTINCT transaction_id)",
    "not_null_transaction_id": _bad("transaction_id IS NULL"),
    "not_null_event_timestamp": _bad("event_timestamp IS NULL"),
    "not_null_event_date": _bad("event_date IS NULL"),
    "amount_not_positive": _bad("amount IS NULL OR amount <= 0"),
    "hour_out_of_range": _bad("event_hour IS NULL OR event_hour NOT BETWEEN 0 AND 23"),
    "expected_rows": "CASE WHEN COUNT(*) != 100350 THEN 1 ELSE 0 END",
    "expected_dates": "CASE WHEN COUNT(DISTINCT event_date) != 31 THEN 1 ELSE 0 END",
    "expected_fraud_rows": "CASE WHEN COUNT(*) FILTER (WHERE is_fraud) != 500 THEN 1 ELSE 0 END",
    "expected_unique_ids": "CASE WHEN COUNT(DISTINCT transaction_id) != COUNT(*) THEN 1 ELSE 0 END",
    "expected_first_date": "CASE WHEN MIN(event_date) != DATE '1992-01-02' THEN 1 ELSE 0 END",
    "expected_last_date": "CASE WHEN MAX(event_date) != DATE '1998-07-04' THEN 1 ELSE 0 END",
}
_WAREHOUSE = [
    _result("processed_transactions", "processed", _PROCESSED_RULES),
    _result("daily_transaction_summary", "daily", {
        **_shared(["event_date"]),
        "amount_order": _bad("NOT COALESCE(min_amount > 0 AND min_amount <= avg_amount AND avg_amount <= max_amount, false)"),
        "total_transaction_count": _TOTAL_CHECK,
    }),
    _result("customer_risk_features", "customer_features", _party("customer_id")),
    _result("merchant_risk_features", "merchant_features", _party("merchant_id")),
    _result("segment_risk_summary", "segment", {**_SEGMENT_RULES, "expected_rows": "CASE WHEN COUNT(*) != 140 THEN 1 ELSE 0 END"}),
    _result("high_risk_transactions", "high_risk", _high_risk_rules(90000)),
]


@query("q8_warehouse_contract", " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in _WAREHOUSE))
def q8(spark, d):
    with shuffles_end_with_the_run(spark):
        unique = processed(spark, d, "transaction_id").count()
    expect = {
        "processed_transactions": {
            "rows": 100350, "dates": 31, "source_file": False, "fraud_rows": 500, "unique_ids": unique,
            "first_date": "1992-01-02", "last_date": "1998-07-04",
        },
        "daily_transaction_summary": {"transactions": 100350},
        "segment_risk_summary": {"rows": 140},
    }
    tables = _clean_tables(spark, d)
    results = rulesets.warehouse_contract(tables, expect, LIMIT, _settled)
    discard(*tables.values())
    return results


# Dimensions in which keys ending in 7 are missing and those ending in 3 are one; dates by their day of the month.
_KEY = "CASE right({0}, 1) WHEN '7' THEN NULL WHEN '3' THEN 'SAME' ELSE {0} END"
_DATE_KEY = "CASE dayofmonth(event_date) WHEN 7 THEN NULL WHEN 3 THEN DATE '1900-01-01' ELSE event_date END"
CTES["bad_dim_customer"] = f"SELECT {_KEY.format('customer_id')} AS customer_id FROM (SELECT DISTINCT customer_id FROM processed)"
CTES["bad_dim_merchant"] = f"SELECT {_KEY.format('merchant_id')} AS merchant_id FROM (SELECT DISTINCT merchant_id FROM processed)"
CTES["bad_dim_date"] = f"SELECT {_DATE_KEY} AS event_date FROM (SELECT DISTINCT event_date FROM processed)"
CTES["bad_high_risk"] = "SELECT * REPLACE (CASE WHEN right(transaction_id, 1) = '1' THEN 'a whim' ELSE risk_reason END AS risk_reason) FROM high_risk"


def _nulls(*columns: str) -> dict[str, str]:
    return {f"not_null_{c}": _bad(f"{c} IS NULL") for c in columns}


def _unique(column: str) -> dict[str, str]:
    return {f"unique_{column}": f"COUNT({column}) - COUNT(DISTINCT {column})"}


def _spoiled_date(frame):
    return frame.withColumns({
        "event_date": F.when(F.col("transaction_count") % 29 == 0, F.lit(None)).when(
            F.col("transaction_count") % 31 == 0, F.lit("1900-01-01").cast("date")).otherwise(F.col("event_date"))})


CTES["bad_dates"] = """SELECT * REPLACE (CASE WHEN transaction_count % 29 = 0 THEN NULL WHEN transaction_count % 31 = 0
                                         THEN DATE '1900-01-01' ELSE event_date END AS event_date) FROM bad_daily"""


@query(
    "q9_model_checks",
    " UNION ALL ".join(
        f"SELECT * FROM ({sql})"
        for sql in [
            _result("dim_customer", "bad_dim_customer", {**_nulls("customer_id"), **_unique("customer_id")}),
            _result("dim_merchant", "bad_dim_merchant", {**_nulls("merchant_id"), **_unique("merchant_id")}),
            _result("dim_date", "bad_dim_date", {**_nulls("event_date"), **_unique("event_date")}),
            _result("fct_transactions", "typed", {
                **_nulls("transaction_id", "event_date", "customer_id", "merchant_id"), **_unique("transaction_id"),
            }),
            _result("stg_high_risk_transactions", "bad_high_risk", {
                **_nulls("transaction_id"), **_unique("transaction_id"), "accepted_risk_reason": _bad("risk_reason = 'a whim'"),
            }),
            _result("stg_customer_risk_features", "bad_customers", {**_nulls("customer_id", "fraud_rate"), **_unique("customer_id")}),
            _result("stg_merchant_risk_features", "bad_merchants", {**_nulls("merchant_id", "fraud_rate"), **_unique("merchant_id")}),
            _result("stg_daily_transaction_summary", "bad_dates", {**_nulls("event_date", "fraud_rate"), **_unique("event_date")}),
            _result("stg_segment_risk_summary", "bad_segments", _nulls(*rulesets.SEGMENT_KEY, "fraud_rate")),
        ]
    ),
)
def q9(spark, d):
    """Every declared check of the nine models, on tables with faults."""
    def checks(some):
        return rulesets.model_checks(some, {name: rulesets.MODEL_RULES[name]() for name in some}, _settled)

    # Copies of ids and missing values are left in on purpose; checked before the fact is stored, as it reads the lines.
    of_lines = checks({"fct_transactions": typed(spark, d)})
    fact = stored_processed(spark, d)
    made = {name: stored_feature(fact, name) for name in features.FEATURE_TABLES}
    risky = features.high_risk(fact, LIMIT)
    key = lambda dim, name: dim.select(F.expr(_KEY.format(name)).alias(name))
    tables = {
        "dim_customer": key(models.dim_customer(fact), "customer_id"),
        "dim_merchant": key(models.dim_merchant(fact), "merchant_id"),
        "dim_date": models.dim_date(fact).select(F.expr(_DATE_KEY).alias("event_date")),
        "stg_high_risk_transactions": risky.withColumn(
            "risk_reason", F.when(F.right("transaction_id", F.lit(1)) == "1", "a whim").otherwise(F.col("risk_reason"))),
        "stg_customer_risk_features": spoil(made["customer_risk_features"]),
        "stg_merchant_risk_features": spoil(made["merchant_risk_features"]),
        "stg_daily_transaction_summary": _spoiled_date(spoil(made["daily_transaction_summary"])),
        "stg_segment_risk_summary": spoil(made["segment_risk_summary"]),
    }
    results = compare.union_all(of_lines, checks(tables))
    discard(fact, *made.values())
    return results


# --- comparisons ---------------------------------------------------------------------------------


@query("q10a_daily_total", _result("daily_transaction_summary", "daily", {"total_transaction_count": _TOTAL_CHECK}))
def q10a(spark, d):
    daily = feature(spark, d, "daily_transaction_summary")
    return evaluate(daily, "daily_transaction_summary", total_equals("transaction_count", 100350))


@query("q10a_segment_total", _result("segment_risk_summary", "segment", {"total_transaction_count": _TOTAL_CHECK}))
def q10a_segment(spark, d):
    segments = feature(spark, d, "segment_risk_summary")
    return evaluate(segments, "segment_risk_summary", total_equals("transaction_count", 100350))


def _mart_with_faults(daily):
    """A mart without the Sundays and with other counts where the count divides by seven."""
    return daily.where(F.dayofweek("event_date") != 1).withColumn(
        "fraud_count", F.when(F.col("transaction_count") % 7 == 0, F.lit(None)).otherwise(F.col("fraud_count"))
    )


@query(
    "j2_daily_reconciliation",
    """SELECT COALESCE(s.event_date, m.event_date) AS event_date
       FROM daily s FULL JOIN (SELECT * REPLACE (CASE WHEN transaction_count % 7 = 0 THEN NULL ELSE fraud_count END AS fraud_count)
                               FROM daily WHERE dayofweek(event_date) != 0) m ON s.event_date = m.event_date
       WHERE s.event_date IS NULL OR m.event_date IS NULL OR s.fraud_count IS DISTINCT FROM m.fraud_count""",
)
def j2(spark, d):
    daily = stored(feature(spark, d, "daily_transaction_summary"), "daily")
    return rulesets.reconcile_daily(daily, _mart_with_faults(models.daily_kpis(daily)))


@query("q10b_daily_mart_reconciles", "SELECT event_date FROM daily WHERE event_date IS NULL")
def q10b(spark, d):
    daily = stored(feature(spark, d, "daily_transaction_summary"), "daily")
    return rulesets.reconcile_daily(daily, models.daily_kpis(daily))


@query(
    "j5_row_count_difference",
    """SELECT source_rows, fact_rows FROM (SELECT COUNT(*) AS source_rows FROM tx),
              (SELECT COUNT(*) AS fact_rows FROM processed) WHERE source_rows != fact_rows""",
)
def j5(spark, d):
    return rulesets.reconcile_fact(star.transactions(spark, d, ["transaction_id"]), processed(spark, d, "transaction_id"))


@query(
    "q10c_rate_bounds",
    """SELECT CAST(event_date AS VARCHAR) AS record_key FROM bad_daily WHERE fraud_rate IS NULL OR fraud_rate > 1 OR fraud_rate < 0
       UNION ALL SELECT customer_id FROM bad_customers WHERE fraud_rate IS NULL OR fraud_rate > 1 OR fraud_rate < 0
       UNION ALL SELECT merchant_id FROM bad_merchants WHERE fraud_rate IS NULL OR fraud_rate > 1 OR fraud_rate < 0
       UNION ALL SELECT country || '|' || merchant_category || '|' || payment_method FROM bad_segments
                 WHERE fraud_rate IS NULL OR fraud_rate > 1 OR fraud_rate < 0""",
)
def q10c(spark, d):
    fact = stored(processed(spark, d), "processed")
    names = ["daily_transaction_summary", "customer_risk_features", "merchant_risk_features", "segment_risk_summary"]
    return rulesets.rate_bounds(*[spoil(features.FEATURE_TABLES[n].build(fact, LIMIT)) for n in names])


@query("u1_union_keys", "SELECT customer_id AS record_key FROM processed UNION ALL SELECT merchant_id FROM processed")
def u1(spark, d):
    fact = processed(spark, d, "customer_id", "merchant_id")
    return compare.union_all(
        fact.select(F.col("customer_id").alias("record_key")), fact.select(F.col("merchant_id").alias("record_key"))
    )


@query(
    "q10e_segment_grain",
    """SELECT country, merchant_category, payment_method, COUNT(*) AS duplicate_count
       FROM (SELECT country, merchant_category, payment_method FROM segment
             UNION ALL SELECT country, merchant_category, payment_method FROM segment WHERE transaction_count % 3 = 0)
       GROUP BY ALL HAVING COUNT(*) > 1""",
)
def q10e(spark, d):
    segments = stored(feature(spark, d, "segment_risk_summary"), "segments")
    return compare.duplicate_keys(segments.unionAll(segments.where("transaction_count % 3 = 0")), rulesets.SEGMENT_KEY)


@query(
    "f12_duplicate_keys",
    "SELECT transaction_id, COUNT(*) AS duplicate_count FROM tx GROUP BY transaction_id HAVING COUNT(*) > 1",
)
def f12(spark, d):
    return compare.duplicate_keys(star.transactions(spark, d, ["transaction_id"]), ["transaction_id"])


@query(
    "j6_count_mismatch",
    """SELECT s.event_date, s.event_count FROM (
           SELECT event_date, CASE WHEN transaction_count % 5 = 0 THEN 0 WHEN transaction_count % 7 = 0 THEN transaction_count + 1
                  ELSE transaction_count END AS event_count FROM daily) s
       WHERE event_count <= 0 OR event_count != (SELECT COUNT(*) FROM processed p WHERE p.event_date = s.event_date)""",
)
def j6(spark, d):
    detail = processed(spark, d, "event_date")
    mart = feature(spark, d, "daily_transaction_summary").selectExpr(
        "event_date",
        "CASE WHEN transaction_count % 5 = 0 THEN 0 WHEN transaction_count % 7 = 0 THEN transaction_count + 1 "
        "ELSE transaction_count END AS event_count",
    )
    return compare.count_mismatch(mart, detail, "event_date")


@query(
    "j7_orphans",
    """SELECT merchant_id, COUNT(*) AS row_count FROM tx WHERE merchant_id NOT IN
         (SELECT printf('MERCH_%06d', s_suppkey) FROM supplier WHERE s_acctbal >= 0) GROUP BY merchant_id""",
)
def j7(spark, d):
    from riskloom.functions.ids import padded_id

    known = star.table(spark, d, "supplier").where("s_acctbal >= 0").select(padded_id("MERCH", F.col("s_suppkey")).alias("merchant_id"))
    return compare.orphans(star.transactions(spark, d, ["merchant_id"]), known, "merchant_id")


@query(
    "q9_relationships",
    """SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
         SELECT 'fct_transactions' AS table_name, 'relationship_merchant_id' AS "check", COUNT(*) AS failures FROM tx
           WHERE merchant_id NOT IN (SELECT printf('MERCH_%06d', s_suppkey) FROM supplier WHERE s_acctbal >= 0)
         UNION ALL SELECT 'fct_transactions', 'relationship_customer_id', COUNT(*) FROM tx
           WHERE customer_id NOT IN (SELECT printf('CUST_%06d', c_custkey) FROM customer))""",
)
def q9_relationships(spark, d):
    from riskloom.functions.ids import padded_id

    known = star.table(spark, d, "supplier").where("s_acctbal >= 0").select(padded_id("MERCH", F.col("s_suppkey")).alias("merchant_id"))
    customers = star.table(spark, d, "customer").select(padded_id("CUST", F.col("c_custkey")).alias("customer_id"))
    return compare.union_all(
        rulesets.relationship(star.transactions(spark, d, ["merchant_id"]), known, "merchant_id", "fct_transactions"),
        rulesets.relationship(star.transactions(spark, d, ["customer_id"]), customers, "customer_id", "fct_transactions"),
    )


@query(
    "j9_scalar_row",
    """SELECT (SELECT COUNT(*) FROM segment) AS row_count,
              (SELECT COUNT(*) FROM (SELECT DISTINCT country, payment_method FROM segment)) AS combinations,
              CAST((SELECT SUM(transaction_count) FROM segment) AS BIGINT) AS total_transaction_count""",
)
def j9(spark, d):
    segments = feature(spark, d, "segment_risk_summary")
    return segments.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("country", "payment_method").alias("combinations"),
        F.sum("transaction_count").alias("total_transaction_count"),
    )


@query(
    "j10_first_source_row",
    """SELECT transaction_id, event_timestamp, amount FROM raw WHERE transaction_id =
         (SELECT MIN(transaction_id) FROM typed WHERE event_date = DATE '1998-07-04')""",
)
def j10(spark, d):
    from riskloom.operators.clean import first_id

    ids = first_id(typed(spark, d), "1998-07-04")
    return compare.first_source_row(star.raw_transactions(spark, d), ids).select("transaction_id", "event_timestamp", "amount")


@query(
    "u3_set_difference",
    """SELECT event_date, 'missing' AS difference FROM (SELECT DISTINCT event_date FROM tx EXCEPT
              SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)
       UNION ALL SELECT event_date, 'extra' FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS event_date FROM orders
              EXCEPT SELECT DISTINCT event_date FROM tx)""",
)
def u3(spark, d):
    order_dates = star.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("event_date"))
    return compare.set_diff(star.transactions(spark, d, ["event_date"]), order_dates)


@query(
    "a12_table_metrics",
    "SELECT COUNT(*) AS row_count, COUNT(DISTINCT transaction_id) AS unique_ids FROM tx",
)
def a12(spark, d):
    from riskloom.operators.merge import table_metrics

    return table_metrics(star.transactions(spark, d, ["transaction_id"]))
