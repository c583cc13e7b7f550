"""Raw transactions to the processed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.clean import clean_filter, dedup_latest, select_event_date, transform
from riskloom.schemas import PROCESSED
from riskloom.sinks.tables import write_checked

# Newest copy of an id first; the other columns only settle exact ties.
NEWEST = ["event_timestamp", "amount", "device_id", "merchant_id", "customer_id"]


def clean_transactions(typed: DataFrame, newest: list[str] | None = None) -> DataFrame:
    return dedup_latest(clean_filter(typed), ["transaction_id"], newest or NEWEST)


def process(
    raw: DataFrame, path: str, event_date: str | None = None, strategy: str = "repartitioned",
    newest: list[str] | None = None,
) -> dict[str, float]:
    """Type, clean, deduplicate and store; with a date only that partition is replaced.

    Raw rows are counted over no columns (a bare line count for CSV), clean rows while they are
    written, so the cleaning plan itself runs once; the files must then hold just as many.
    """
    spark = raw.sparkSession
    typed = transform(raw)
    candidates = typed if event_date is None else select_event_date(typed, event_date)
    raw_count = candidates.count()
    started = spark.sql("select current_timestamp()").first()[0]
    rows = clean_transactions(candidates, newest).select(*PROCESSED.fieldNames())
    clean_count = write_checked(rows, path, event_date, strategy=strategy)
    if event_date is not None:
        _require_replaced(spark, path, event_date, started)
    rejected = raw_count - clean_count
    return {
        "raw_count": raw_count,
        "clean_count": clean_count,
        "rejected_count": rejected,
        "rejection_rate": rejected / raw_count if raw_count else 0.0,
    }


def _require_replaced(spark, path: str, event_date: str, started) -> None:
    """Dynamic overwrite leaves a date alone for which no row is written; do not take it for the new one."""
    stored = spark.read.schema(PROCESSED).parquet(path).where(F.col("event_date") == F.lit(event_date).cast("date"))
    oldest = stored.agg(F.min("processed_at")).first()[0]
    if oldest is None or oldest < started:
        raise RuntimeError(f"no row of event_date={event_date} passed the cleaning rules; its partition was not replaced")
