"""Inputs the registered queries share."""

from __future__ import annotations

from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.clean import clean_filter, dedup_latest, transform
from riskloom.plans import features
from riskloom.session import (
    READ_AGAIN,
    in_part,
    parts_for,
    scanned_bytes,
    shuffles_end_with_the_run,
    work_folder,
)
from riskloom.sources import star_schema as star
from riskloom.sources.files import delete_folder, exists, folder_bytes

LIMIT = star.TABLE_THRESHOLD
KEY = ["transaction_id"]
NEWEST = ["event_timestamp", "source_offset"]


def processed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Deduplicated transactions with the given columns (all without any)."""
    return star.latest_transactions(spark, sf_dir, columns or None)


def typed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Typed raw rows with the given raw columns (all without any); the timestamp is always there."""
    names = [*dict.fromkeys([*columns, "event_timestamp"])] if columns else None
    return transform(star.raw_transactions(spark, sf_dir, names)).drop("source_file", "processed_at")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows, the newest copy of each id; lines alone decide, so they are described when copies are gone."""
    lines = transform(star.raw_lines(spark, sf_dir)).drop("source_file", "processed_at")
    return described(spark, sf_dir, dedup_latest(clean_filter(lines), KEY, NEWEST), *star.RAW_COLUMNS, "event_date", "event_hour")


def described(spark: SparkSession, sf_dir: str, kept: DataFrame, *columns: str) -> DataFrame:
    """Columns of cleaned lines. An id that is left is the one its keys make, so only these are shuffled on."""
    return star.describe(spark, sf_dir, kept, columns, set(kept.columns) - {"transaction_id", "source_offset"}, once=True)


_DAILY = ["event_date", "amount", "is_fraud"]
_SEGMENT = ["country", "merchant_category", "payment_method", "amount", "is_fraud", "customer_id", "merchant_id"]
_PARTY = [*_SEGMENT, "event_date", "event_timestamp"]
_NEEDS = {
    "daily_transaction_summary": _DAILY,
    "segment_risk_summary": _SEGMENT,
    "customer_risk_features": _PARTY,
    "merchant_risk_features": _PARTY,
}


def feature(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return features.FEATURE_TABLES[name].build(processed(spark, sf_dir, *_NEEDS[name]), LIMIT)


def high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.high_risk(processed(spark, sf_dir), LIMIT)


_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(frame: DataFrame, label: str, *rest: DataFrame) -> DataFrame:
    """Write a table once, as the batch run does with its features, and read it back; the rest of its rows one after another."""
    spark, path = frame.sparkSession, work_folder(frame.sparkSession, label)
    with shuffles_end_with_the_run(spark):
        for rows in (frame, *rest):
            rows.write.mode("append").parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    _folders[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove the files of frames that `stored` returned and nothing reads any more."""
    for frame in frames:
        delete_folder(frame.sparkSession, _folders.pop(frame))


def stored_processed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """`processed`, stored. The newest lines of large tables are stored first, and described by parts of the orders."""
    parts = parts_for(folder_bytes(spark, f"{sf_dir}/lineitem.parquet"))
    if parts == 1:
        return stored(processed(spark, sf_dir, *columns), "processed")
    names = columns or star.TRANSACTION_COLUMNS
    lines = stored(star.newest_lines(spark, sf_dir, names), "newest-lines")

    def part(i: int) -> DataFrame:
        only = lambda key: in_part([F.col(key).cast("long")], i, parts)
        return star.describe(spark, sf_dir, lines.where(only("l_orderkey")), names, star.MADE, only=only)

    out = stored(part(0), "processed", *[part(i) for i in range(1, parts)])
    discard(lines)
    return out


@contextmanager
def processed_to_write(spark: SparkSession, sf_dir: str, *columns: str):
    """`processed` for one write; of large tables stored before, so that nothing else is shuffled beside that write."""
    if parts_for(folder_bytes(spark, f"{sf_dir}/lineitem.parquet")) == 1:
        yield processed(spark, sf_dir, *columns)
    else:
        yield (rows := stored_processed(spark, sf_dir, *columns))
        discard(rows)


def stored_feature(fact: DataFrame, name: str) -> DataFrame:
    """A feature table of a stored fact, stored; of a large fact by parts of the keys."""
    table = features.FEATURE_TABLES[name]
    parts = parts_for(scanned_bytes(fact) // READ_AGAIN)
    if parts == 1:
        return stored(table.build(fact, LIMIT), name)
    first, *rest = (table.build(fact.where(in_part(list(table.keys), i, parts)), LIMIT) for i in range(parts))
    return stored(first, name, *rest)


_tables: dict[tuple[str, str, str], str] = {}


def table_once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Folder of a table that several queries only read; `build(path)` writes it the first time."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables or not exists(spark, _tables[key]):
        path = work_folder(spark, name)
        build(path)
        _tables[key] = path
    return _tables[key]
