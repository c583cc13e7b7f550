"""Typing, cleaning and deduplication of transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.predicates import all_of
from riskloom.functions.times import iso_date, parse_instant

READABLE = ["transaction_id", "event_timestamp"]


def transform(raw: DataFrame) -> DataFrame:
    """Parse the timestamp and add date, hour, source file and processing time.

    File scans carry their file in `source_file` already; other inputs get null.
    """
    typed = raw.withColumn("event_timestamp", parse_instant("event_timestamp"))
    file = F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")
    return typed.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
            "source_file": file,
            "processed_at": F.current_timestamp(),
        }
    )


def is_clean() -> Column:
    """Id and timestamp present, amount present and positive."""
    known = [F.col(name).isNotNull() for name in READABLE]
    return all_of(*known, F.coalesce(F.col("amount") > 0, F.lit(False)))


def clean_filter(typed: DataFrame) -> DataFrame:
    return typed.where(is_clean())


def dedup_any(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; which copy survives is open."""
    return rows.dropDuplicates(keys)


def dedup_latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest `order` values (nulls are least).

    Spark limits each key to its best row inside every map task before the shuffle
    (window group limit), so a key holding a third of all rows still sends at most
    one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return (
        rows.withColumn("row_number", F.row_number().over(ranked))
        .where(F.col("row_number") == 1)
        .drop("row_number")
    )


def select_event_date(typed: DataFrame, event_date: str) -> DataFrame:
    """Rows of one date; refuses a date without rows before anything is written."""
    rows = typed.where(F.col("event_date") == F.lit(iso_date(event_date)).cast("date"))
    if rows.isEmpty():
        raise RuntimeError(f"no source rows for event_date={event_date}")
    return rows


def cleaning_metrics(typed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Raw, clean and rejected row counts and the rejection rate, in one pass.

    Clean rows are the distinct keys among the rows that pass the filter, so copies
    count as rejected. The rate is 0 for an empty input.
    """
    clean_key = [F.when(is_clean(), F.col(name)) for name in keys or ["transaction_id"]]
    counted = typed.agg(
        F.count(F.lit(1)).alias("raw_count"), F.count_distinct(*clean_key).alias("clean_count")
    )
    rejected = F.col("raw_count") - F.col("clean_count")
    return counted.select(
        "raw_count",
        "clean_count",
        rejected.alias("rejected_count"),
        F.coalesce(F.try_divide(rejected, F.col("raw_count")), F.lit(0.0)).alias("rejection_rate"),
    )


def amount_above(rows: DataFrame, limit: float) -> DataFrame:
    return rows.where(F.col("amount") > limit)


def preview(rows: DataFrame, n: int = 5) -> DataFrame:
    return rows.limit(n)


def first_id(rows: DataFrame, event_date: str, key: str = "transaction_id") -> DataFrame:
    """Least id of a date. Sort with limit keeps one row per task, so nothing is gathered."""
    return (
        rows.where(F.col("event_date") == F.lit(iso_date(event_date)).cast("date"))
        .where(F.col(key).isNotNull())
        .select(key)
        .orderBy(key)
        .limit(1)
    )


def drop_cols(rows: DataFrame, *names: str) -> DataFrame:
    return rows.drop(*names)


def sort_by_date(rows: DataFrame) -> DataFrame:
    return rows.orderBy("event_date")


def sort_by_risk(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("fraud_rate"), F.desc("transaction_count"))
