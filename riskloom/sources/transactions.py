"""Batch scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.times import iso_date
from riskloom.schemas import RAW_TRANSACTION, RAW_TRANSACTION_TEXT


def read_raw(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """CSV with a header row; `path` may be a glob. `with_file` adds `source_file`."""
    rows = spark.read.csv(path, schema=RAW_TRANSACTION, header=True)
    return rows.select("*", F.col("_metadata.file_path").alias("source_file")) if with_file else rows


def read_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """The same files as text, with their header kept honest for the raw contract."""
    return spark.read.csv(path, schema=RAW_TRANSACTION_TEXT, header=True, enforceSchema=False)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names as the files state them; only the header is read."""
    return spark.read.csv(path, header=True).columns


def read_processed(spark: SparkSession, root: str) -> DataFrame:
    """Parquet tree; event_date comes from the folder names, as a date."""
    return spark.read.parquet(root).withColumn("event_date", F.col("event_date").cast("date"))


def read_partition(spark: SparkSession, root: str, event_date: str) -> DataFrame:
    """One date. The literal keeps the filter a partition filter, so no other folder is opened."""
    return spark.read.parquet(root).where(F.col("event_date") == F.lit(iso_date(event_date)).cast("date"))


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Query files in place under a name; the schema is inferred from the files."""
    frame = spark.read.parquet(path)
    frame.createOrReplaceTempView(name)
    return spark.table(name)


def from_rows(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Small literal rows as a table."""
    return spark.createDataFrame(rows, schema)


def read_evidence(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV result files of earlier runs."""
    return spark.read.csv(path, header=True, schema=schema)
