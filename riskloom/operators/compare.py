"""Joins and set operations that compare tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.predicates import any_of, distinct_from


def diff_full_outer(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Rows whose measures differ, or that only one side has; both values are shown.

    A row missing on one side differs even where the other side's measures are null.
    """
    a = left.select(*keys, *[F.col(m).alias(f"left_{m}") for m in measures], F.lit(True).alias("_in_left"))
    b = right.select(*keys, *[F.col(m).alias(f"right_{m}") for m in measures], F.lit(True).alias("_in_right"))
    joined = a.join(b, keys, "full_outer")
    differs = any_of(
        F.col("_in_left").isNull(),
        F.col("_in_right").isNull(),
        *[distinct_from(F.col(f"left_{m}"), F.col(f"right_{m}")) for m in measures],
    )
    return joined.where(differs).drop("_in_left", "_in_right")


def row_count_diff(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Both row counts when they differ, otherwise nothing. Only two one-row tables are paired."""
    a = left.agg(F.count(F.lit(1)).alias(left_name))
    b = right.agg(F.count(F.lit(1)).alias(right_name))
    return a.crossJoin(b).where(F.col(left_name) != F.col(right_name))


def count_mismatch(mart: DataFrame, detail: DataFrame, key: str, count: str = "event_count") -> DataFrame:
    """Mart rows whose count is not positive or not the number of detail rows with that key."""
    actual = detail.groupBy(key).agg(F.count(F.lit(1)).alias("_actual"))
    return (
        mart.join(actual, key, "left")
        .where((F.col(count) <= 0) | (F.col(count) != F.coalesce("_actual", F.lit(0))))
        .select(key, count)
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Non-null child keys without a parent, each once with its number of rows."""
    # Grouping first leaves one row per key for the join, however hot a key is.
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return keys.join(parent.select(key), key, "left_anti")


def first_source_row(raw: DataFrame, ids: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Raw rows that carry one of the given ids."""
    return raw.join(ids.select(key), key, "left_semi")


def sent_if_small(mapping: DataFrame, rows: int = 10_000) -> DataFrame:
    """A mapping of at most `rows` rows goes to every task, so the other side is not dealt out by its few keys."""
    return F.broadcast(mapping) if mapping.limit(rows + 1).count() <= rows else mapping


def currency_mismatch(rows: DataFrame, conformity: DataFrame) -> DataFrame:
    """Rows whose country is unknown or whose currency is not the country's.

    `conformity` holds one row per country (country, expected_currency).
    """
    joined = rows.join(sent_if_small(conformity), "country", "left")
    known = F.col("expected_currency").isNotNull()
    return joined.where(~known | distinct_from(F.col("currency"), F.col("expected_currency"))).withColumn(
        "problem", F.when(known, "currency_mismatch").otherwise("unknown_country")
    )


def distinct_count(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Number of distinct combinations, nulls included."""
    return rows.select(*columns).distinct().agg(F.count(F.lit(1)).alias("distinct_count"))


def distinct_dates(rows: DataFrame) -> DataFrame:
    return rows.select("event_date").distinct()


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)


def set_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of one set but not of the other, marked `missing` or `extra`."""
    columns = expected.columns
    marked = union_all(
        expected.distinct().withColumn("_side", F.lit(1)),
        actual.select(*columns).distinct().withColumn("_side", F.lit(2)),
    )
    sides = marked.groupBy(*columns).agg(F.sum("_side").alias("_sides"))
    return sides.where("_sides < 3").select(
        *columns, F.when(F.col("_sides") == 1, "missing").otherwise("extra").alias("difference")
    )


def file_inventory(spark, path: str, with_size: bool = True) -> DataFrame:
    """Data files below a folder: path, size, change time. Only the listing is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return listing.select("path", "length", "modificationTime") if with_size else listing.select("path")


def inventory_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that appeared, vanished or changed between two inventories."""
    return set_diff(before, after.select(*before.columns))
