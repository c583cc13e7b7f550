"""Totals and checks over batch metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.quality.rules import Rule, evaluate, require_all, row_rule
from riskloom.sources.files import child_names
from riskloom.sources.results import read_batch_metrics

TOTALS = [
    "input_count", "clean_count", "invalid_count", "duplicate_count", "late_count",
    "schema_drift_count", "dlq_count", "risk_alert_count",
]


def summarize_metrics(metrics: DataFrame) -> DataFrame:
    """One row: totals (absent counts are 0), invalid rate, batches and unreconciled batches."""
    totals = metrics.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in TOTALS],
        F.count(F.lit(1)).alias("batch_count"),
        F.count_if(~F.coalesce("reconciliation", F.lit(False))).alias("unreconciled_batches"),
    )
    rate = F.coalesce(F.try_divide("invalid_count", "input_count"), F.lit(0.0))
    return totals.withColumn("invalid_rate", rate)


def stream_rules(max_invalid_rate: float) -> list[Rule]:
    """What the totals of a sound run satisfy."""
    handled = F.col("clean_count") + F.col("invalid_count") + F.col("duplicate_count")
    return [
        row_rule("some_batch", F.col("batch_count") == 0),
        row_rule("batches_reconcile", F.col("unreconciled_batches") > 0),
        row_rule("totals_reconcile", F.col("input_count") != handled),
        row_rule("dead_letters_are_invalid", F.col("dlq_count") > F.col("invalid_count")),
        row_rule("invalid_share", F.col("invalid_rate") > max_invalid_rate),
    ]


def validate_stream(metrics: DataFrame, max_invalid_rate: float = 0.10) -> dict:
    """Totals of a sound run; raises a ContractError for any other."""
    if max_invalid_rate < 0 or max_invalid_rate > 1:
        raise ValueError(f"a share is between 0 and 1, not {max_invalid_rate}")
    total = summarize_metrics(metrics).first()
    require_all(evaluate(metrics.sparkSession.createDataFrame([total]), "stream", stream_rules(max_invalid_rate)))
    return {**total.asDict(), "status": "PASS"}


def fingerprint(spark: SparkSession, root: str) -> dict:
    """Batches on storage and their totals, to compare before and after a restart."""
    total = validate_stream(read_batch_metrics(spark, root), 1.0)
    names = ("input_count", "clean_count", "invalid_count", "duplicate_count", "dlq_count", "risk_alert_count")
    batches = [n for n in child_names(spark, root) if n.startswith("batch_id=")]
    return {"metric_files": batches, "batch_count": total["batch_count"], **{n: total[n] for n in names}}


def verify_restart(before: dict, after: dict) -> None:
    if before != after:
        raise RuntimeError(f"restart changed finished batches: {before} / {after}")
