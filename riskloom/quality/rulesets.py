"""The contracts of every table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.predicates import any_of, in_unit_range, is_blank
from riskloom.functions.risk import HIGH_VALUE, is_high_risk, is_high_value
from riskloom.functions.times import has_offset, parse_iso
from riskloom.operators.compare import (
    sent_if_small,
    count_mismatch,
    diff_full_outer,
    file_inventory,
    orphans,
    row_count_diff,
    set_diff,
    union_all,
)
from riskloom.plans.models import MAX_EVENT_AMOUNT
from riskloom.quality.rules import (
    Rule,
    accepted,
    evaluate,
    expected_rows,
    expected_value,
    grain,
    not_empty,
    not_null,
    row_rule,
    total_equals,
    unique,
)
from riskloom.schemas import (
    COUNTRY_CURRENCY,
    EVENT_TYPES,
    MERCHANT_CATEGORIES,
    PAYMENT_METHODS,
    PROCESSED,
    RISK_REASONS,
)

RATE_TOLERANCE = 0.000001
Settle = Callable[[DataFrame], DataFrame]
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


# --- raw text ------------------------------------------------------------------------


def conformity_table(spark: SparkSession, mapping: Mapping[str, str] = COUNTRY_CURRENCY) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), "country string, expected_currency string")


def raw_rules(
    categories: list[str] = MERCHANT_CATEGORIES, methods: list[str] = PAYMENT_METHODS
) -> list[Rule]:
    """Rules on the rows of `_readable`."""
    identifier = F.coalesce(F.col("transaction_id"), F.lit(""))
    parsed, number = F.col("_instant"), F.col("_number")
    known_country = F.col("expected_currency").isNotNull()
    return [
        row_rule("id_empty", identifier == ""),
        Rule(
            "id_duplicate",
            F.count_if(identifier != "") - F.count_distinct(F.when(identifier != "", identifier)),
        ),
        row_rule("timestamp_unparseable", parsed.isNull()),
        row_rule("timestamp_without_offset", parsed.isNotNull() & ~has_offset(F.col("event_timestamp"))),
        row_rule("amount_not_numeric", number.isNull()),
        row_rule("amount_not_positive", number <= 0),
        row_rule("country_unknown", ~known_country),
        row_rule("currency_mismatch", known_country & ~F.col("currency").eqNullSafe(F.col("expected_currency"))),
        row_rule("category_unknown", ~_listed("merchant_category", categories)),
        row_rule("payment_method_unknown", ~_listed("payment_method", methods)),
        row_rule("is_fraud_not_boolean", ~_listed("is_fraud", ["True", "False"])),
        not_empty(),
    ]


def _listed(column: str, values: list[str]) -> Column:
    return F.coalesce(F.col(column).isin(*values), F.lit(False))


def _readable(rows: DataFrame, conformity: DataFrame) -> DataFrame:
    """Text rows with their expected currency and with timestamp and amount parsed once."""
    number = F.when(F.col("amount").rlike(_NUMBER), F.trim("amount").try_cast("double"))
    return rows.join(sent_if_small(conformity), "country", "left").withColumns(
        {"_instant": parse_iso(F.col("event_timestamp")), "_number": number}
    )


def raw_contract(rows: DataFrame, conformity: DataFrame, **lists) -> DataFrame:
    """Failures per rule over text rows, in one pass."""
    return evaluate(_readable(rows, conformity), "raw_transactions", raw_rules(**lists))


def raw_summary(rows: DataFrame) -> DataFrame:
    """Rows, unique non-empty ids and fraud rows."""
    identifier = F.when(F.col("transaction_id") != "", F.col("transaction_id"))
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(identifier).alias("unique_ids"),
        F.count_if(F.col("is_fraud") == "True").alias("fraud_rows"),
    )


def first_errors(rows: DataFrame, conformity: DataFrame, limit: int | None = 20, **lists) -> DataFrame:
    """The first `limit` violating rows by id with their broken rules, for a report; None gives all."""
    from riskloom.quality.rules import violations

    readable = _readable(rows, conformity)
    broken = violations(readable, raw_rules(**lists)).select("transaction_id", "broken_rules")
    return broken if limit is None else broken.orderBy("transaction_id", "broken_rules").limit(limit)


def header_problems(found: list[str], expected: list[str]) -> list[str]:
    return [] if found == expected else [f"expected {expected}, found {found}"]


# --- processed -----------------------------------------------------------------------


def schema_problems(found: T.StructType, expected: T.StructType = PROCESSED) -> list[str]:
    """Missing, extra and wrongly typed columns; order does not count."""
    have = {f.name: f.dataType.simpleString() for f in found}
    want = {f.name: f.dataType.simpleString() for f in expected}
    return (
        [f"missing {n}" for n in want if n not in have]
        + [f"extra {n}" for n in have if n not in want]
        + [f"{n} is {have[n]}, not {want[n]}" for n in want if n in have and have[n] != want[n]]
    )


def processed_rules(
    rows: int | None = None, dates: int | None = None, source_file: bool = True, fraud_rows: int | None = None,
    unique_ids: int | None = None, first_date: str | None = None, last_date: str | None = None,
) -> list[Rule]:
    """Rules of every processed table, and the exact numbers and date bounds one of them should have."""
    checks = [
        not_empty(),
        grain("transaction_id"),
        not_null("transaction_id"),
        not_null("event_timestamp"),
        not_null("event_date"),
        row_rule("amount_not_positive", F.col("amount").isNull() | (F.col("amount") <= 0)),
        row_rule("hour_out_of_range", ~F.coalesce(F.col("event_hour").between(0, 23), F.lit(False))),
        *expected_rows(rows),
    ]
    if source_file:
        checks.append(not_null("source_file"))
    if dates is not None:
        checks.append(expected_value("expected_dates", F.count_distinct("event_date"), dates))
    exact = {
        "expected_fraud_rows": (F.count_if("is_fraud"), fraud_rows),
        "expected_unique_ids": (F.count_distinct("transaction_id"), unique_ids),
        "expected_first_date": (F.min("event_date").cast("string"), first_date),
        "expected_last_date": (F.max("event_date").cast("string"), last_date),
    }
    return checks + [expected_value(name, found, value) for name, (found, value) in exact.items() if value is not None]


def processed_contract(transactions: DataFrame, **expect) -> DataFrame:
    return evaluate(transactions, "processed_transactions", processed_rules(**expect))


def date_bounds(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.min("event_date").alias("min_event_date"),
        F.max("event_date").alias("max_event_date"),
        F.count_distinct("event_date").alias("event_date_count"),
    )


def folder_dates(spark: SparkSession, root: str) -> DataFrame:
    """Dates the folder names show."""
    name = F.regexp_extract("path", r"event_date=([0-9-]+)", 1)
    return (
        file_inventory(spark, root, with_size=False)
        .select(F.to_date(F.when(name != "", name)).alias("event_date"))
        .where("event_date is not null")
        .distinct()
    )


def partition_mismatch(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Dates with rows but no folder (missing), or a folder but no rows (extra)."""
    return set_diff(rows.select("event_date").distinct(), folder_dates(spark, root))


def partition_counts(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Logical dates, physical dates and data files."""
    logical = rows.agg(F.count_distinct("event_date").alias("logical_dates"))
    physical = folder_dates(spark, root).agg(F.count(F.lit(1)).alias("physical_dates"))
    files = file_inventory(spark, root, with_size=False).agg(F.count(F.lit(1)).alias("file_count"))
    # Three one-row tables side by side.
    return logical.crossJoin(physical).crossJoin(files)


def inventory_contract(
    spark: SparkSession, root: str, files: int | None = None, partitions: int | None = None, flat: bool = False
) -> DataFrame:
    """Before publishing: files exist, expected numbers hold, no date folders in a flat table."""
    has_date = F.col("path").contains("event_date=")
    date = F.when(has_date, F.regexp_extract("path", r"event_date=([^/]+)", 1))
    rules = [not_empty()]
    if files is not None:
        rules.append(expected_value("expected_files", F.count(F.lit(1)), files))
    if partitions is not None:
        rules.append(expected_value("expected_partitions", F.count_distinct(date), partitions))
    if flat:
        rules.append(row_rule("date_folder_in_flat_table", has_date))
    return evaluate(file_inventory(spark, root, with_size=False), root.rstrip("/").rsplit("/", 1)[-1], rules)


# --- feature tables --------------------------------------------------------------------


def _between(column: str, low: int, high: str = "transaction_count") -> Rule:
    """Not null, at least `low`, at most another column."""
    inside = (F.col(column) >= low) & (F.col(column) <= F.col(high))
    return row_rule(f"range_{column}", ~F.coalesce(inside, F.lit(False)))


def _shared(keys: list[str]) -> list[Rule]:
    count, rate = F.col("transaction_count"), F.col("fraud_rate")
    drift = F.abs(rate - F.try_divide(F.col("fraud_count"), count)) > RATE_TOLERANCE
    return [
        row_rule("null_key", any_of(*[F.col(k).isNull() for k in keys])),
        grain(*keys),
        row_rule("transaction_count_not_positive", ~F.coalesce(count > 0, F.lit(False))),
        _between("fraud_count", 0),
        row_rule("range_fraud_rate", ~in_unit_range("fraud_rate")),
        row_rule("fraud_rate_inconsistent", drift),
        _between("high_value_transaction_count", 0),
    ]


def _party(key: str) -> list[Rule]:
    order = F.coalesce(F.col("first_seen_at") <= F.col("last_seen_at"), F.lit(False))
    return [*_shared([key]), _between("active_days", 1), row_rule("activity_window", ~order)]


def customer_contract(features: DataFrame, rows: int | None = None) -> DataFrame:
    return evaluate(features, "customer_risk_features", _party("customer_id") + expected_rows(rows))


def merchant_contract(features: DataFrame, rows: int | None = None) -> DataFrame:
    return evaluate(features, "merchant_risk_features", _party("merchant_id") + expected_rows(rows))


def daily_contract(daily: DataFrame, rows: int | None = None, transactions: int | None = None) -> DataFrame:
    low, mean, high = F.col("min_amount"), F.col("avg_amount"), F.col("max_amount")
    ordered = F.coalesce((low > 0) & (low <= mean) & (mean <= high), F.lit(False))
    rules = [*_shared(["event_date"]), row_rule("amount_order", ~ordered)]
    rules += expected_rows(rows) + total_equals("transaction_count", transactions)
    return evaluate(daily, "daily_transaction_summary", rules)


SEGMENT_KEY = ["country", "merchant_category", "payment_method"]


def segment_contract(segments: DataFrame, rows: int | None = None, transactions: int | None = None) -> DataFrame:
    rules = [*_shared(SEGMENT_KEY), _between("distinct_customers", 1), _between("distinct_merchants", 1)]
    rules += expected_rows(rows) + total_equals("transaction_count", transactions)
    return evaluate(segments, "segment_risk_summary", rules)


def high_risk_rules(threshold: float = HIGH_VALUE) -> list[Rule]:
    fraud, high, reason = F.col("is_fraud"), is_high_value(threshold), F.col("risk_reason")
    meaning = dict(zip(RISK_REASONS, [fraud & high, fraud & ~high, ~fraud & high]))
    return [
        not_null("transaction_id"),
        grain("transaction_id"),
        row_rule("rule_does_not_hold", fraud.isNull() | F.col("amount").isNull() | ~is_high_risk(threshold)),
        row_rule("reason_unknown", ~_listed("risk_reason", RISK_REASONS)),
        *[row_rule(f"reason_{name}", (reason == name) & ~holds) for name, holds in meaning.items()],
        not_null("event_date"),
    ]


def high_risk_contract(rows: DataFrame, threshold: float = HIGH_VALUE, count: int | None = None) -> DataFrame:
    return evaluate(rows, "high_risk_transactions", high_risk_rules(threshold) + expected_rows(count))


def high_risk_violations(rows: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """Ids of high-risk rows that break a row rule."""
    bad = [r.bad for r in high_risk_rules(threshold) if r.bad is not None and r.name != "not_null_event_date"]
    return rows.where(any_of(*[F.coalesce(b, F.lit(False)) for b in bad])).select("transaction_id")


# --- warehouse ----------------------------------------------------------------------------

# Columns no processed transaction may lack.
REQUIRED = ["transaction_id", "event_timestamp", "event_date", "customer_id", "merchant_id"]


def contract_row(rows: DataFrame) -> DataFrame:
    """What the contract of processed transactions looks at, as numbers in one row: counts, distinct values, gaps, bounds."""
    broken = {
        "invalid_amount_rows": ~F.coalesce(F.col("amount") > 0, F.lit(False)),
        "invalid_event_hour_rows": ~F.coalesce(F.col("event_hour").between(0, 23), F.lit(False)),
        **{f"null_{name}s": F.col(name).isNull() for name in REQUIRED},
    }
    seen = {"unique_transaction_ids": "transaction_id", "distinct_event_dates": "event_date"}
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("is_fraud").alias("fraud_rows"),
        *[F.count_if(bad).alias(name) for name, bad in broken.items()],
        *[F.count_distinct(column).alias(name) for name, column in seen.items()],
        *[bound("event_date").alias(f"{bound.__name__}_event_date") for bound in (F.min, F.max)],
    )


def warehouse_contract(
    tables: Mapping[str, DataFrame], expect: Mapping[str, Mapping], threshold: float, settle: Settle = lambda results: results,
) -> DataFrame:
    """All six table contracts; `expect` holds the exact numbers per table (may be empty).

    `settle` can store the results of a table, so that the checks of one table are done before those of the next.
    """
    build = {
        "processed_transactions": lambda t, e: processed_contract(t, **e),
        "daily_transaction_summary": lambda t, e: daily_contract(t, e.get("rows"), e.get("transactions")),
        "customer_risk_features": lambda t, e: customer_contract(t, e.get("rows")),
        "merchant_risk_features": lambda t, e: merchant_contract(t, e.get("rows")),
        "segment_risk_summary": lambda t, e: segment_contract(t, e.get("rows"), e.get("transactions")),
        "high_risk_transactions": lambda t, e: high_risk_contract(t, threshold, e.get("rows")),
    }
    return union_all(*[settle(build[name](table, expect.get(name, {}))) for name, table in tables.items()])


# --- declared model checks ----------------------------------------------------------------

# Column checks of the models; event types are those of the stream profile.
MODEL_RULES = {
    "fct_transactions": lambda: [
        not_null("transaction_id"), unique("transaction_id"),
        not_null("event_date"), not_null("customer_id"), not_null("merchant_id"),
    ],
    "dim_customer": lambda: [not_null("customer_id"), unique("customer_id")],
    "dim_merchant": lambda: [not_null("merchant_id"), unique("merchant_id")],
    "dim_date": lambda: [not_null("event_date"), unique("event_date")],
    "stg_customer_risk_features": lambda: [not_null("customer_id"), unique("customer_id"), not_null("fraud_rate")],
    "stg_merchant_risk_features": lambda: [not_null("merchant_id"), unique("merchant_id"), not_null("fraud_rate")],
    "stg_daily_transaction_summary": lambda: [not_null("event_date"), unique("event_date"), not_null("fraud_rate")],
    "stg_segment_risk_summary": lambda: [not_null(c) for c in (*SEGMENT_KEY, "fraud_rate")],
    "stg_high_risk_transactions": lambda: [
        not_null("transaction_id"), unique("transaction_id"), accepted("risk_reason", RISK_REASONS),
    ],
}


def stream_model_rules(event_types: list[str] = EVENT_TYPES) -> dict[str, list[Rule]]:
    return {
        "stg_streaming_transaction_events": [
            not_null("transaction_id"), unique("transaction_id"), not_null("event_date"),
            accepted("event_type", event_types), not_null("amount"),
        ],
        "mart_streaming_risk_summary": [not_null("event_date"), unique("event_date")],
        "mart_streaming_event_quality": [not_null("event_date"), unique("event_date"), not_null("event_count")],
        "mart_realtime_risk_trends": [
            not_null("event_date"), not_null("event_hour"), not_null("event_type"),
            accepted("event_type", event_types), not_null("event_count"),
        ],
    }


def model_checks(
    tables: Mapping[str, DataFrame], rules: Mapping[str, list[Rule]], settle: Settle = lambda results: results,
) -> DataFrame:
    """The checks of every model; `settle` as in `warehouse_contract`."""
    return union_all(*[settle(evaluate(tables[name], name, rules[name])) for name in rules if name in tables])


def relationship(child: DataFrame, parent: DataFrame, key: str, table: str) -> DataFrame:
    """Rows whose non-null key has no parent, as a check result."""
    missing = orphans(child, parent, key).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("failures"))
    return missing.select(
        F.lit(table).alias("table_name"),
        F.lit(f"relationship_{key}").alias("check"),
        F.col("failures").cast("long").alias("failures"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


# --- reconciliation: violating rows, none when all is well -----------------------------------

DAILY_MEASURES = [
    "transaction_count", "total_amount", "avg_amount", "fraud_count", "fraud_rate",
    "high_value_transaction_count",
]


def reconcile_daily(staging: DataFrame, mart: DataFrame) -> DataFrame:
    return diff_full_outer(staging, mart, ["event_date"], DAILY_MEASURES).select("event_date")


def reconcile_fact(source: DataFrame, fact: DataFrame) -> DataFrame:
    return row_count_diff(source, fact, "source_rows", "fact_rows")


def rate_bounds(daily: DataFrame, customer: DataFrame, merchant: DataFrame, segment: DataFrame) -> DataFrame:
    """Keys of all rows in four tables whose fraud rate is null or outside [0, 1]."""
    bad = ~in_unit_range("fraud_rate")
    keys = {
        "daily": (daily, F.col("event_date").cast("string")),
        "customer": (customer, F.col("customer_id")),
        "merchant": (merchant, F.col("merchant_id")),
        "segment": (segment, F.concat_ws("|", *SEGMENT_KEY)),
    }
    return union_all(*[table.where(bad).select(key.alias("record_key")) for table, key in keys.values()])


def bad_amounts(stg: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return stg.where((amount <= 0) | (amount > MAX_EVENT_AMOUNT)).select("transaction_id")


def impossible_times(stg: DataFrame) -> DataFrame:
    happened, arrived, handled = (F.col(f"{n}_timestamp") for n in ("event", "ingestion", "processing"))
    return stg.where((happened > arrived) | (arrived > handled)).select("transaction_id")


def blank_reasons(quarantine: DataFrame) -> DataFrame:
    return quarantine.where(F.col("error_reason").isNull() | is_blank("error_reason")).select("raw_payload")


def _event_counts(stg: DataFrame, keys: list[str]) -> DataFrame:
    return stg.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"))


def reconcile_trends(stg: DataFrame, mart: DataFrame) -> DataFrame:
    keys = ["event_date", "event_hour", "event_type"]
    return diff_full_outer(_event_counts(stg, keys), mart, keys, ["event_count"]).select(*keys)


def reconcile_quality(stg: DataFrame, mart: DataFrame) -> DataFrame:
    diff = diff_full_outer(_event_counts(stg, ["event_date"]), mart, ["event_date"], ["event_count"])
    return diff.select(
        "event_date",
        F.col("left_event_count").alias("expected_event_count"),
        F.col("right_event_count").alias("event_count"),
    )


def reconcile_summary(stg: DataFrame, mart: DataFrame) -> DataFrame:
    return count_mismatch(mart, stg, "event_date")
