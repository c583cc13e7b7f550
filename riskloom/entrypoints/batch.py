"""Batch queries: scans, cleaning, features, models, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.entrypoints.inputs import KEY, LIMIT, NEWEST, clean, feature, high_risk, processed, stored, typed
from riskloom.entrypoints.registry import query
from riskloom.functions.ids import uuid5
from riskloom.operators import clean as ops
from riskloom.plans import features, models
from riskloom.sources import star_schema as star

# --- typing, filters, dedup ----------------------------------------------------------

_TX = (
    "transaction_id, event_timestamp, event_date, event_hour, customer_id, merchant_id, amount, currency, "
    "country, merchant_category, payment_method, device_id, is_fraud"
)


@query("p1_transform", f"SELECT {_TX}, source_offset FROM typed")
def p1(spark, d):
    return typed(spark, d)


@query("f1_clean_filter", f"SELECT {_TX}, source_offset FROM clean")
def f1(spark, d):
    return ops.clean_filter(typed(spark, d))


@query("d1_dedup_any_keys", "SELECT DISTINCT transaction_id FROM clean")
def d1(spark, d):
    return ops.dedup_any(ops.clean_filter(typed(spark, d)), KEY).select("transaction_id")


@query("d3_dedup_latest", f"SELECT {_TX}, source_offset FROM clean_latest")
def d3(spark, d):
    return clean(spark, d)


@query(
    "d4_distinct_count",
    "SELECT COUNT(*) AS distinct_count FROM (SELECT DISTINCT country, merchant_category, payment_method FROM tx)",
)
def d4(spark, d):
    from riskloom.operators.compare import distinct_count

    columns = ["country", "merchant_category", "payment_method"]
    return distinct_count(star.transactions(spark, d, columns), columns)


@query("d5_distinct_dates", "SELECT DISTINCT event_date FROM tx")
def d5(spark, d):
    from riskloom.operators.compare import distinct_dates

    return distinct_dates(star.transactions(spark, d, ["event_date"]))


@query("f2_select_event_date", f"SELECT {_TX}, source_offset FROM typed WHERE event_date = DATE '1998-07-04'")
def f2(spark, d):
    return ops.select_event_date(typed(spark, d), "1998-07-04")


@query("f3_high_risk_filter", f"SELECT {_TX}, source_offset FROM tx WHERE is_fraud OR amount >= 90000")
def f3(spark, d):
    return features.high_risk_filter(star.transactions(spark, d), LIMIT)


@query("f13_amount_above", "SELECT transaction_id, amount FROM tx WHERE amount > 30000")
def f13(spark, d):
    return ops.amount_above(star.transactions(spark, d, ["transaction_id", "amount"]), 30_000)


@query(
    "a14_cleaning_metrics",
    """SELECT raw_count, clean_count, raw_count - clean_count AS rejected_count,
              CAST(raw_count - clean_count AS DOUBLE) / raw_count AS rejection_rate
       FROM (SELECT COUNT(*) AS raw_count FROM raw), (SELECT COUNT(DISTINCT transaction_id) AS clean_count FROM clean)""",
)
def a14(spark, d):
    return ops.cleaning_metrics(typed(spark, d))


# --- features ---------------------------------------------------------------------------


@query(
    "a0_fraud_measures",
    """SELECT CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_count,
              CAST(SUM(CAST(is_fraud AS INTEGER)) AS DOUBLE) / COUNT(is_fraud) AS fraud_rate,
              CAST(SUM(CASE WHEN amount >= 90000 THEN 1 ELSE 0 END) AS BIGINT) AS high_value_transaction_count
       FROM processed""",
)
def a0(spark, d):
    return features.fraud_measures(processed(spark, d, "is_fraud", "amount"), LIMIT)


@query("a1_daily_summary", "SELECT * FROM daily ORDER BY event_date")
def a1(spark, d):
    return features.daily_summary(processed(spark, d, "event_date", "amount", "is_fraud"), LIMIT)


@query("a2_segment_summary", "SELECT * FROM segment")
def a2(spark, d):
    return feature(spark, d, "segment_risk_summary")


@query("a3_customer_features", "SELECT * FROM customer_features")
def a3(spark, d):
    return feature(spark, d, "customer_risk_features")


@query("a4_merchant_features", "SELECT * FROM merchant_features")
def a4(spark, d):
    return feature(spark, d, "merchant_risk_features")


@query("p10_high_risk", "SELECT * FROM high_risk")
def p10(spark, d):
    return high_risk(spark, d)


# --- staging, fact, dimensions ---------------------------------------------------------

_AUDITED = """CAST(NULL AS VARCHAR) AS source_file, TIMESTAMP '2026-01-01 00:00:00' AS processed_at"""


def _audited(spark, d):
    return processed(spark, d).drop("source_offset").withColumns(
        {"source_file": F.lit(None).cast("string"), "processed_at": F.lit("2026-01-01").cast("timestamp")}
    )


@query("p2_stg_processed_transactions", f"SELECT {_TX}, {_AUDITED} FROM processed")
def p2_processed(spark, d):
    return models.staging("processed_transactions", _audited(spark, d))


@query("p2_stg_daily_summary", "SELECT * FROM daily")
def p2_daily(spark, d):
    return models.staging("daily_transaction_summary", feature(spark, d, "daily_transaction_summary"))


@query("p2_stg_segment_summary", "SELECT * FROM segment")
def p2_segment(spark, d):
    return models.staging("segment_risk_summary", feature(spark, d, "segment_risk_summary"))


@query("p2_stg_customer_features", "SELECT * FROM customer_features")
def p2_customer(spark, d):
    return models.staging("customer_risk_features", feature(spark, d, "customer_risk_features"))


@query("p2_stg_merchant_features", "SELECT * FROM merchant_features")
def p2_merchant(spark, d):
    return models.staging("merchant_risk_features", feature(spark, d, "merchant_risk_features"))


@query("p2_stg_high_risk", "SELECT * FROM high_risk")
def p2_high_risk(spark, d):
    return models.staging("high_risk_transactions", high_risk(spark, d))


@query("p3_fact_projection", f"SELECT {_TX}, {_AUDITED} FROM processed")
def p3(spark, d):
    return models.fct_select(_audited(spark, d))


@query(
    "a5_dim_customer",
    """SELECT customer_id, MIN(event_timestamp) AS first_seen_at, MAX(event_timestamp) AS last_seen_at,
              COUNT(*) AS transaction_count, COUNT(DISTINCT country) AS distinct_countries,
              COUNT(DISTINCT merchant_id) AS distinct_merchants
       FROM processed GROUP BY customer_id""",
)
def a5(spark, d):
    return models.dim_customer(processed(spark, d, "customer_id", "event_timestamp", "country", "merchant_id"))


@query(
    "a6_dim_merchant",
    """SELECT merchant_id, MIN(event_timestamp) AS first_seen_at, MAX(event_timestamp) AS last_seen_at,
              COUNT(*) AS transaction_count, COUNT(DISTINCT customer_id) AS distinct_customers,
              COUNT(DISTINCT merchant_category) AS distinct_categories, COUNT(DISTINCT country) AS distinct_countries
       FROM processed GROUP BY merchant_id""",
)
def a6(spark, d):
    columns = ["merchant_id", "event_timestamp", "customer_id", "merchant_category", "country"]
    return models.dim_merchant(processed(spark, d, *columns))


@query(
    "a7_dim_date",
    """SELECT event_date, CAST(year(event_date) AS INTEGER) AS calendar_year,
              CAST(quarter(event_date) AS INTEGER) AS calendar_quarter,
              CAST(month(event_date) AS INTEGER) AS calendar_month, CAST(day(event_date) AS INTEGER) AS day_of_month,
              CAST(dayofweek(event_date) + 1 AS INTEGER) AS day_of_week, dayname(event_date) AS day_name,
              COUNT(*) AS transaction_count
       FROM processed GROUP BY event_date""",
)
def a7(spark, d):
    return models.dim_date(processed(spark, d, "event_date"))


# --- marts -------------------------------------------------------------------------------


@query(
    "a8_high_risk_daily_trends",
    """SELECT event_date, COUNT(*) AS high_risk_transaction_count,
              CAST(SUM(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS known_fraud_count,
              CAST(SUM(CASE WHEN NOT is_fraud AND amount >= 90000 THEN 1 ELSE 0 END) AS BIGINT) AS high_value_only_count,
              CAST(SUM(CASE WHEN is_fraud AND amount >= 90000 THEN 1 ELSE 0 END) AS BIGINT)
                  AS combined_fraud_and_high_value_count,
              CAST(SUM(CAST(amount AS DECIMAL(22,4))) AS DOUBLE) AS total_high_risk_amount
       FROM high_risk GROUP BY event_date""",
)
def a8(spark, d):
    rows = features.high_risk_filter(processed(spark, d, "event_date", "is_fraud", "amount"), LIMIT)
    return models.high_risk_daily_trends(rows, LIMIT)


_RANK = "percent_rank() OVER (ORDER BY fraud_rate, transaction_count) AS risk_percentile"
_TIER = "CASE WHEN fraud_rate >= 0.1 THEN 'high' WHEN fraud_rate >= 0.05 THEN 'medium' ELSE 'low' END AS risk_tier"
_RANKED = "transaction_count, total_amount, fraud_count, fraud_rate, high_value_transaction_count"


@query("w1_customer_ranking", f"SELECT customer_id, {_RANKED}, active_days, {_RANK}, {_TIER} FROM customer_features")
def w1(spark, d):
    return models.customer_ranking(stored(feature(spark, d, "customer_risk_features"), "customer_features"))


@query("w2_merchant_ranking", f"SELECT merchant_id, {_RANKED}, active_days, {_RANK}, {_TIER} FROM merchant_features")
def w2(spark, d):
    return models.merchant_ranking(stored(feature(spark, d, "merchant_risk_features"), "merchant_features"))


@query(
    "w3_segment_ranking",
    f"""SELECT country, merchant_category, payment_method, {_RANKED}, distinct_customers, distinct_merchants, {_RANK}
        FROM segment""",
)
def w3(spark, d):
    return models.segment_ranking(stored(feature(spark, d, "segment_risk_summary"), "segments"))


@query(
    "w4_daily_kpis",
    """SELECT event_date, transaction_count, total_amount, avg_amount, fraud_count, fraud_rate,
              high_value_transaction_count,
              transaction_count - LAG(transaction_count) OVER (ORDER BY event_date) AS transaction_count_change,
              fraud_count - LAG(fraud_count) OVER (ORDER BY event_date) AS fraud_count_change
       FROM daily""",
)
def w4(spark, d):
    return models.daily_kpis(feature(spark, d, "daily_transaction_summary"))


@query(
    "w5_latest_by_row_number",
    "SELECT transaction_id, event_timestamp, amount FROM processed",
)
def w5(spark, d):
    return processed(spark, d, "transaction_id", "event_timestamp", "amount")


# --- order, limit ----------------------------------------------------------------------------


@query("o1_sort_by_date", "SELECT event_date, transaction_count FROM daily ORDER BY event_date")
def o1(spark, d):
    daily = features.daily_summary(processed(spark, d, "event_date", "amount", "is_fraud"), LIMIT)
    return ops.sort_by_date(daily.select("event_date", "transaction_count"))


@query(
    "o2_sort_by_risk",
    "SELECT merchant_id, fraud_rate, transaction_count FROM merchant_features ORDER BY fraud_rate DESC, transaction_count DESC",
)
def o2(spark, d):
    ranked = feature(spark, d, "merchant_risk_features").select("merchant_id", "fraud_rate", "transaction_count")
    return ops.sort_by_risk(ranked)


@query("o3_first_id", "SELECT MIN(transaction_id) AS transaction_id FROM tx WHERE event_date = DATE '1998-07-04'")
def o3(spark, d):
    return ops.first_id(star.transactions(spark, d, ["transaction_id", "event_date"]), "1998-07-04")


# --- scalar functions ------------------------------------------------------------------------

_NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"  # the public URL namespace of RFC 4122


@query(
    "x20_uuid5",
    f"""SELECT transaction_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
               || CASE WHEN substr(h, 17, 1) IN ('0', '4', '8', 'c') THEN '8'
                       WHEN substr(h, 17, 1) IN ('1', '5', '9', 'd') THEN '9'
                       WHEN substr(h, 17, 1) IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END
               || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid
        FROM (SELECT transaction_id,
                     sha1(unhex('{_NAMESPACE.replace("-", "")}') || encode(transaction_id)) AS h
              FROM tx)""",
)
def x20(spark, d):
    import uuid

    rows = star.transactions(spark, d, ["transaction_id"])
    return rows.select("transaction_id", uuid5(uuid.UUID(_NAMESPACE), F.col("transaction_id")).alias("uuid"))


@query(
    "x6_time_differences",
    """SELECT event_id, datesub('hour', CAST(ts AS TIMESTAMP), arrived) AS whole_hours,
              datesub('second', CAST(ts AS TIMESTAMP), arrived) AS whole_seconds
       FROM event_times""",
)
def x6(spark, d):
    records = star.event_records(spark, d)
    e = star.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    joined = e.join(records.select(F.col("offset").alias("event_id"), F.col("timestamp").alias("arrived")), "event_id")
    return joined.select(
        "event_id",
        F.timestamp_diff("HOUR", "ts", "arrived").alias("whole_hours"),
        F.timestamp_diff("SECOND", "ts", "arrived").alias("whole_seconds"),
    )


@query(
    "x10_rounding",
    """SELECT transaction_id, abs(amount - 50000) AS distance,
              CAST(round(CAST(amount / 7 AS DECIMAL(38,10)), 2) AS DOUBLE) AS rounded FROM tx""",
)
def x10(spark, d):
    from riskloom.functions.amounts import cents

    rows = star.transactions(spark, d, ["transaction_id", "amount"])
    return rows.select(
        "transaction_id", F.abs(F.col("amount") - 50000).alias("distance"), cents(F.col("amount") / 7).alias("rounded")
    )


@query(
    "x11_safe_divide",
    """SELECT transaction_id, CASE WHEN event_hour = 0 THEN NULL ELSE amount / event_hour END AS per_hour FROM tx""",
)
def x11(spark, d):
    rows = star.transactions(spark, d, ["transaction_id", "amount", "event_hour"])
    return rows.select("transaction_id", F.try_divide("amount", "event_hour").alias("per_hour"))


@query(
    "x23_sorted_sets",
    """SELECT customer_id, array_to_string(list_sort(list(DISTINCT merchant_category)), ',') AS categories
       FROM tx GROUP BY customer_id""",
)
def x23(spark, d):
    # Distinct pairs first, so a set only ever holds the few category names of a customer.
    pairs = star.transactions(spark, d, ["customer_id", "merchant_category"]).distinct()
    names = F.array_join(F.array_sort(F.array_distinct(F.collect_list("merchant_category"))), ",")
    return pairs.groupBy("customer_id").agg(names.alias("categories"))
