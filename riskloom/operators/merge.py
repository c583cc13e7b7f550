"""Upserts into date-partitioned Parquet tables.

Only the dates a merge touches are rewritten: those of the staged rows and those at
which their keys lie now. Merged rows are written once, into a hidden folder of the
table, and the finished date folders are then moved into place. A merge that breaks off
before they are all written leaves the table as it was; one that breaks off between the
moves is finished by the next merge.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.times import iso_date
from riskloom.quality.rules import (
    Rule,
    evaluate,
    grain,
    not_empty,
    not_null,
    require_all,
    row_rule,
)
from riskloom.session import parts_for, shuffles_end_with_the_run, work_folder
from riskloom.sinks.tables import write_partitioned
from riskloom.sources.files import child_names, delete_folder, exists, folder_bytes, move_folder

KEY = "transaction_id"
DATE = "event_date"
SENT_KEYS = 1_000_000   # staged ids sent to every task at most; more are joined by a shuffle
PENDING = "_merge-"     # folders that readers of a table do not see
FOLDERS = "folder string, filled boolean"


def table_metrics(rows: DataFrame, key: str = KEY) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("unique_ids"))


def stage_rules(event_date: str) -> list[Rule]:
    day = F.lit(iso_date(event_date)).cast("date")
    return [not_empty(), grain(KEY), not_null(KEY), row_rule("other_date", ~F.col(DATE).eqNullSafe(day))]


def stage_checks(stage: DataFrame, event_date: str) -> DataFrame:
    return evaluate(stage, "stage", stage_rules(event_date))


def validate_stage(stage: DataFrame, event_date: str) -> None:
    """Not empty, ids unique and known, only the requested date; raises otherwise."""
    require_all(stage_checks(stage, event_date))


def merge_upsert(target: DataFrame, stage: DataFrame, key: str = KEY) -> DataFrame:
    """Target rows without a staged successor, and all staged rows. Staged keys must be unique."""
    kept = target.join(stage.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(stage.select(*target.columns))


def touched_dates(target: DataFrame, stage: DataFrame, key: str = KEY) -> list:
    """Dates a merge changes. Of the target only key and date are read, and not shuffled for a stage of usual size.

    The list is bounded by the number of date partitions, which the driver knows anyway.
    """
    keys = stage.select(key)
    with shuffles_end_with_the_run(stage.sparkSession):
        if keys.count() <= SENT_KEYS:
            keys = F.broadcast(keys)
        old = target.select(key, DATE).join(keys, key, "left_semi").select(DATE)
        dates = old.unionByName(stage.select(DATE)).distinct()
        return sorted(row[0] for row in dates.collect())


def merge_into(spark: SparkSession, path: str, stage: DataFrame, key: str = KEY) -> list:
    """Merge staged rows into the table at `path`; returns the rewritten dates.

    Running the same merge again changes nothing, also after a run that broke off
    between the steps.
    """
    finish_merges(spark, path)
    staged_at = work_folder(spark, "merge-stage")
    with shuffles_end_with_the_run(spark):
        stage.write.parquet(staged_at)
    stage = spark.read.schema(stage.schema).parquet(staged_at)

    target = spark.read.parquet(path)
    dates = touched_dates(target, stage, key)
    pending = f"{path}/{PENDING}{uuid.uuid4().hex}"
    for i, some in enumerate(_groups(spark, path, dates)):
        # Literal dates prune the scan to the touched folders.
        here = F.col(DATE).isin(some)
        write_partitioned(merge_upsert(target.where(here), stage, key).where(here), f"{pending}/new" + (f"-{i}" if i else ""))
    # Once this list is complete the merge is decided; until then it has not happened.
    filled = set(_new_folders(spark, pending))
    folders = [f"{DATE}={day.isoformat()}" for day in dates]
    listed = spark.createDataFrame([(name, name in filled) for name in folders], FOLDERS)
    listed.coalesce(1).write.json(f"{pending}/folders")
    _move_in(spark, path, pending)
    delete_folder(spark, staged_at)
    return dates


def _groups(spark: SparkSession, path: str, dates: list) -> list[list]:
    """Dates whose rows are merged together: all of them, or of a large table as many as fit into a part."""
    if parts_for(folder_bytes(spark, path)) == 1:
        return [dates]
    groups, size = [[]], 0
    for day in dates:
        found = folder_bytes(spark, f"{path}/{DATE}={day.isoformat()}")
        if groups[-1] and parts_for(size + found) > 1:
            groups.append([])
            size = 0
        groups[-1].append(day)
        size += found
    return groups


def _new_folders(spark: SparkSession, pending: str) -> dict[str, str]:
    """Finished date folders of a merge and where they are."""
    written = [name for name in child_names(spark, pending) if name == "new" or name.startswith("new-")]
    return {name: f"{pending}/{at}/{name}" for at in written for name in child_names(spark, f"{pending}/{at}")}


def _move_in(spark: SparkSession, path: str, pending: str) -> None:
    """Replace each listed date folder by the new one, or by nothing if all its rows moved elsewhere.

    Can be repeated at any point: a folder to be filled that is not among the new ones any more is in place.
    """
    new = _new_folders(spark, pending)
    for name, filled in spark.read.schema(FOLDERS).json(f"{pending}/folders").collect():
        if name in new or not filled:
            delete_folder(spark, f"{path}/{name}")
        if name in new:
            move_folder(spark, new[name], f"{path}/{name}")
    delete_folder(spark, pending)


def finish_merges(spark: SparkSession, path: str) -> int:
    """Complete decided merges that broke off while folders were moved, drop undecided ones; returns how many there were."""
    found = [f"{path}/{name}" for name in child_names(spark, path) if name.startswith(PENDING)]
    for pending in found:
        if exists(spark, f"{pending}/folders/_SUCCESS"):
            _move_in(spark, path, pending)
        else:
            delete_folder(spark, pending)
    return len(found)


def require_unique(rows: DataFrame, table: str, key: str = KEY) -> None:
    require_all(evaluate(rows, table, [grain(key)]))


def merge_partition(spark: SparkSession, source_root: str, target_root: str, event_date: str) -> dict[str, int]:
    """Merge one date of a processed table into a target and check the outcome."""
    before = spark.read.parquet(target_root).count()
    stage = spark.read.parquet(source_root).where(F.col(DATE) == F.lit(iso_date(event_date)).cast("date"))
    validate_stage(stage, event_date)
    merge_into(spark, target_root, stage)
    after = table_metrics(spark.read.parquet(target_root)).first()
    if after["row_count"] != after["unique_ids"]:
        raise RuntimeError("merge target holds duplicate transaction ids")
    return {
        "before_rows": before,
        "staged_rows": stage.count(),
        "after_rows": after["row_count"],
        "unique_transaction_ids": after["unique_ids"],
    }


# --- incremental fact ------------------------------------------------------------------


def watermark(target: DataFrame | None, column: str = "processed_at"):
    """Greatest value of the target, or 1900-01-01 for an empty one."""
    newest = target.agg(F.max(column)).first()[0] if target is not None else None
    return F.coalesce(F.lit(newest), F.lit("1900-01-01").cast("timestamp"))


def since_watermark(rows: DataFrame, target: DataFrame | None, column: str = "processed_at") -> DataFrame:
    """Rows at or after the target's newest; all rows without a target.

    The value is fetched first and stands as a literal in the filter, so it reaches the
    scan as a pushed-down predicate.
    """
    return rows if target is None else rows.where(F.col(column) >= watermark(target, column))


def build_fct(spark: SparkSession, path: str, stg: DataFrame, full_refresh: bool = False) -> None:
    """Create the fact, or merge what is new since its last run; a schema change is refused."""
    if full_refresh or not exists(spark, path):
        write_partitioned(stg, path)
        return
    target = spark.read.parquet(path)
    have = {f.name: f.dataType for f in target.schema}
    want = {f.name: f.dataType for f in stg.schema}
    if have != want:
        raise RuntimeError(f"fact schema changed: {sorted(have)} / {sorted(want)}")
    merge_into(spark, path, since_watermark(stg, target))


# --- streaming target --------------------------------------------------------------------


def merge_streaming(spark: SparkSession, path: str, silver: DataFrame) -> dict[str, int]:
    """Merge silver events into their target, the latest copy of each id, and check uniqueness."""
    from riskloom.operators.clean import dedup_latest

    latest = dedup_latest(silver, [KEY], ["ingestion_timestamp", "kafka_offset"])
    if exists(spark, path):
        merge_into(spark, path, latest)
    else:
        write_partitioned(latest, path)
    metrics = table_metrics(spark.read.parquet(path)).first()
    if metrics["row_count"] != metrics["unique_ids"]:
        raise RuntimeError("streaming target holds duplicate transaction ids")
    return metrics.asDict()


def snapshot_partition(spark: SparkSession, source_root: str, target_root: str, event_date: str) -> int:
    """New table from one date of another; returns its rows."""
    day = F.col(DATE) == F.lit(iso_date(event_date)).cast("date")
    write_partitioned(spark.read.parquet(source_root).where(day), target_root)
    return spark.read.parquet(target_root).count()


def late_merge_row(target: DataFrame, late_id: str, corrected_id: str, corrected_amount: float) -> DataFrame:
    """Duplicates, late rows and corrected rows of a target, as one row."""
    right_amount = F.abs(F.col("amount") - corrected_amount) < 0.000001
    return target.agg(
        (F.count(F.lit(1)) - F.count_distinct(KEY)).alias("duplicate_rows"),
        F.count_if(F.col(KEY) == late_id).alias("late_rows"),
        F.count_if((F.col(KEY) == corrected_id) & right_amount).alias("corrected_rows"),
    )
