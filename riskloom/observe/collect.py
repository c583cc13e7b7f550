"""One collection of observations over everything a run leaves behind.

Each collector looks at one kind of result and works on its own: when it fails, the failure is an observation
like any other, so that alerts see it, and the others go on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.observe.observations import (
    evidence_observations,
    failure_observation,
    normalize_observations,
    run_observations,
    stream_observations,
    table_observations,
    write_observations,
)
from riskloom.operators.compare import union_all
from riskloom.sources.results import read_batch_metrics, read_check_results
from riskloom.sources.transactions import read_evidence

SCALE = "rows long, seconds double, status string"
MERGES = "event_date string, duplicate_rows long, late_rows long, corrected_rows long"


@dataclass(frozen=True)
class Collection:
    """Where the results lie; what is None is not collected."""

    transactions: str | None = None
    batch_metrics: str | None = None
    check_results: str | None = None
    scale_results: str | None = None
    merge_evidence: str | None = None
    expected_rows: int | None = None
    expected_dates: int | None = None


def collectors(spark: SparkSession, where: Collection, run_id: str) -> dict[str, Callable[[], DataFrame]]:
    found: dict[str, Callable[[], DataFrame]] = {}
    if where.transactions:
        found["processed_transactions"] = lambda: table_observations(
            spark.read.parquet(where.transactions), run_id, where.expected_rows, where.expected_dates)
    if where.batch_metrics:
        found["streaming_transaction_events"] = lambda: stream_observations(read_batch_metrics(spark, where.batch_metrics), run_id)
    if where.check_results:
        found["check_results"] = lambda: run_observations(read_check_results(spark, where.check_results), run_id)
    if where.scale_results and where.merge_evidence:
        found["stored_evidence"] = lambda: evidence_observations(
            read_evidence(spark, where.scale_results, SCALE), read_evidence(spark, where.merge_evidence, MERGES), run_id)
    return found


def collect(spark: SparkSession, where: Collection, run_id: str, out: str) -> DataFrame:
    """Append the observations of all collectors to `out` and return them as they are stored there."""
    parts = []
    for table, look in collectors(spark, where, run_id).items():
        try:
            rows = normalize_observations(look())
            # A few rows each; their plan runs here, so that a failure belongs to its collector.
            parts.append(spark.createDataFrame(rows.collect(), rows.schema))
        except Exception as error:
            parts.append(normalize_observations(failure_observation(spark, run_id, table, error)))
    if not parts:
        raise ValueError("nothing to collect")
    observed = union_all(*parts)
    write_observations(observed, out)
    return spark.read.schema(observed.schema).json(out)
