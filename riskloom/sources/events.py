"""Event sources. A broker topic and a folder of files open to the same record layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import RECORD


@dataclass(frozen=True)
class SourceSpec:
    """Where a stream comes from.

    format   kafka (needs the connector jar on the cluster), parquet (files in the
             record layout) or text (one JSON event per line)
    location topic name or folder
    """

    format: str
    location: str
    options: dict[str, str] = field(default_factory=dict)
    starting_offsets: str = "earliest"
    max_files_per_trigger: int | None = None


def open_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Unbounded table with the columns of `schemas.RECORD`."""
    reader = spark.readStream.format(spec.format).options(**spec.options)
    if spec.format == "kafka":
        if spec.starting_offsets not in ("earliest", "latest"):
            raise ValueError("starting_offsets must be earliest or latest")
        reader = (
            reader.option("subscribe", spec.location)
            .option("startingOffsets", spec.starting_offsets)
            .option("failOnDataLoss", "true")
        )
        return reader.load().select(*RECORD.fieldNames())
    if spec.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", spec.max_files_per_trigger)
    if spec.format == "text":
        return _as_records(reader.load(spec.location))
    return reader.schema(RECORD).load(spec.location)


def read_events_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of JSON lines as records."""
    return _as_records(spark.read.text(path))


def _as_records(lines: DataFrame) -> DataFrame:
    """Lines have no broker position: the file stands in for the topic, the rest is null."""
    return lines.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def decode_records(records: DataFrame) -> DataFrame:
    """Value as text, position columns under their own names."""
    return records.selectExpr(
        "cast(value as string) as raw_json",
        "topic",
        "partition as kafka_partition",
        "offset as kafka_offset",
        "timestamp as kafka_timestamp",
    )
