"""Results of earlier runs as tables: batch metrics, load status, check results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from riskloom.schemas import BATCH_METRICS, CHECK_RESULT

LOAD_STATUS = "observation_timestamp string, success boolean, details string"


def _json_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Missing files give an empty table; an unreadable document fails the read."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    try:
        return reader.json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def read_batch_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row per micro-batch, in batch order when shown."""
    return _json_or_empty(spark, f"{root}/*", BATCH_METRICS).orderBy("batch_id")


def read_load_status(spark: SparkSession, path: str) -> DataFrame:
    return _json_or_empty(spark, path, LOAD_STATUS)


def read_check_results(spark: SparkSession, path: str) -> DataFrame:
    return _json_or_empty(spark, path, CHECK_RESULT)


def tolerant(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """For a report that must not stop: every document, one that cannot be read with its text in `_broken`."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    schema = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
    read = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_broken"})
    return lines.where("trim(value) != ''").select(read.alias("r")).select("r.*")


def failed_checks(results: DataFrame) -> DataFrame:
    """One row: checks seen and checks that did not pass."""
    return results.agg(
        F.count(F.lit(1)).alias("checks_observed"),
        F.count_if(F.lower("status").isin("error", "fail")).alias("checks_failed"),
    )
