"""Table writers.

Date partitions are written through a rebalance shuffle: adaptive execution merges
small dates into one task and splits a date that is too large for one, so there is
one file for an ordinary date and no single writer for a hot one.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.times import iso_date
from riskloom.session import READ_AGAIN, in_part, parts_for, scanned_bytes, shuffles_end_with_the_run
from riskloom.sources.files import child_names, delete_folder, exists

STRATEGIES = ("baseline", "repartitioned")


def by_partition(rows: DataFrame, column: str) -> DataFrame:
    """Gather the rows of each partition value, splitting values that are too large."""
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    return rows.hint("rebalance", column) if adaptive else rows.repartition(column)


@contextmanager
def _small_write_tasks(spark: SparkSession):
    """Keep several tasks for small tables with many dates while a write runs.

    Opening a file costs far more than its few rows there, so tasks are merged down to
    64 KB instead of the usual 1 MB. Large tables are not affected.
    """
    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "64k")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_partitioned(
    rows: DataFrame,
    path: str,
    strategy: str = "repartitioned",
    dynamic: bool = False,
    partition_by: str = "event_date",
    cluster_by: list[str] | None = None,
) -> None:
    """Overwrite a table partitioned by date.

    baseline       every task writes every date it holds (many small files)
    repartitioned  dates are gathered first
    dynamic        replace only the dates present in `rows`
    cluster_by     order of the rows inside each file

    Many rows that are only read from files are gathered by parts of the dates, so that a part is shuffled at once.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown write strategy {strategy!r}")
    gathered = strategy == "repartitioned"
    parts = parts_for(scanned_bytes(rows) // READ_AGAIN) if gathered else 1
    kind = "dynamic" if dynamic else "static"
    with _small_write_tasks(rows.sparkSession), shuffles_end_with_the_run(rows.sparkSession):
        for i in range(parts):
            out = rows.where(in_part([partition_by], i, parts)) if parts > 1 else rows
            if gathered:
                out = by_partition(out, partition_by)
            if cluster_by:
                out = out.sortWithinPartitions(partition_by, *cluster_by)
            mode = "append" if i and not dynamic else "overwrite"
            out.write.mode(mode).option("partitionOverwriteMode", kind).partitionBy(partition_by).parquet(path)


def write_counted(rows: DataFrame, path: str, **options) -> int:
    """Write a partitioned table and return its row count.

    The count comes from the footers of the written files, not from a second run of
    the plan, so it states what is on storage.
    """
    write_partitioned(rows, path, **options)
    return rows.sparkSession.read.parquet(path).count()


def write_feature(rows: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Overwrite a feature table and return the number of rows written, from the same pass."""
    if partition_by:
        return write_counted(rows, path, partition_by=partition_by)
    seen = Observation("feature_rows")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def load_table(rows: DataFrame, name: str, path: str | None = None, partition_by: str | None = None) -> None:
    """Full-replace load of a named table."""
    out = by_partition(rows, partition_by) if partition_by else rows
    writer = out.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)


def verify_write(spark: SparkSession, path: str, expected: int, event_date: str | None = None) -> int:
    """Compare stored rows with the expected number; only file footers are read for a whole table."""
    found = stored_rows(spark, path, event_date)
    if found != expected:
        raise RuntimeError(f"{path}: expected {expected} rows, found {found}")
    return found


def stored_rows(spark: SparkSession, path: str, event_date: str | None = None) -> int:
    """Rows on storage, of one date or of all."""
    stored = spark.read.parquet(path)
    if event_date is not None:
        stored = stored.where(F.col("event_date") == F.lit(iso_date(event_date)).cast("date"))
    return stored.count()


def write_checked(rows: DataFrame, path: str, event_date: str | None = None, **options) -> int:
    """Write a partitioned table, or with a date that partition of it; returns the rows written.

    Two independent counts are compared: the rows that entered the write, observed while it ran, and the rows
    in the footers of the stored files.  A task that ran twice, because its executor was lost, is observed twice; so
    on a difference the rows are counted once more before the write is called wrong.
    """
    seen = Observation("rows_written")
    write_partitioned(rows.observe(seen, F.count(F.lit(1)).alias("n")), path, dynamic=event_date is not None, **options)
    spark, expected = rows.sparkSession, seen.get["n"]
    if not expected:
        return 0  # no file to read; a date that is replaced by nothing is the caller's matter
    if stored_rows(spark, path, event_date) != expected:
        expected = rows.count()
    return verify_write(spark, path, expected, event_date)


def within_retention(rows: DataFrame, date_col: str, days: int, as_of: str) -> DataFrame:
    """Rows whose date is at most `days` before `as_of`."""
    oldest = date.fromisoformat(iso_date(as_of)) - timedelta(days=days)
    return rows.where(F.col(date_col) >= F.lit(oldest))


def apply_retention(spark: SparkSession, path: str, date_col: str, days: int, as_of: str) -> list[str]:
    """Drop whole date folders older than the retention; no row is read or rewritten."""
    oldest = (date.fromisoformat(iso_date(as_of)) - timedelta(days=days)).isoformat()
    prefix = f"{date_col}="
    expired = [
        name
        for name in child_names(spark, path)
        if name.startswith(prefix) and "0000-00-00" < name.removeprefix(prefix) < oldest
    ]
    for name in expired:
        delete_folder(spark, f"{path}/{name}")
    return expired


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def write_status(spark: SparkSession, path: str, success: bool, details: object) -> None:
    """One status row, replacing the one before."""
    now = datetime.now(timezone.utc).isoformat()
    row = [(now, success, str(details))]
    frame = spark.createDataFrame(row, "observation_timestamp string, success boolean, details string")
    frame.coalesce(1).write.mode("overwrite").json(path)


def with_status(spark: SparkSession, path: str, load):
    """Run a load and record its outcome, also when it fails."""
    try:
        result = load()
    except Exception as error:
        write_status(spark, path, False, f"{type(error).__name__}: {error}")
        raise
    write_status(spark, path, True, result)
    return result


def write_evidence(spark: SparkSession, row: dict, path: str) -> None:
    """One result row as CSV with header."""
    frame = spark.createDataFrame([tuple(row.values())], list(row))
    frame.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_events_jsonl(events: DataFrame, path: str) -> None:
    """One JSON object per line with its keys in alphabetical order."""
    events.select(F.to_json(F.struct(*sorted(events.columns))).alias("value")).write.mode("overwrite").text(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return exists(spark, path)
