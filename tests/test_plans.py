"""Properties the physical plans must keep."""

import io
from contextlib import redirect_stdout
from datetime import date

import pytest

from __spark_entry__ import queries
from riskloom.operators.merge import since_watermark
from riskloom.plans.etl import process
from riskloom.schemas import RAW_TRANSACTION
from riskloom.sinks.tables import write_partitioned
from riskloom.sources.transactions import read_partition

SF_DIR = "/root/testdata/sf0.001"


def plan(frame) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def test_daily_summary_reads_one_table_and_limits_before_the_shuffle(spark):
    text = plan(queries()["a1_daily_summary"](spark, SF_DIR))
    assert "Join" not in text and text.count("Scan parquet") == 2  # node list and details
    assert "l_tax" not in text and "l_comment" not in text
    # Groups are limited below the exchange (partial) and above it (final).
    assert text.count("WindowGroupLimit") >= 4


def test_high_risk_keeps_python_out_and_broadcasts_nothing_by_hand(spark):
    text = plan(queries()["p10_high_risk"](spark, SF_DIR))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_one_date_read_prunes_folders_and_watermark_is_pushed(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("select '1' transaction_id, timestamp'2026-01-01 00:00:00' processed_at, date'2026-01-01' event_date")
    write_partitioned(rows, path)
    assert "PartitionFilters: [isnotnull(event_date" in plan(read_partition(spark, path, "2026-01-01"))
    table = spark.read.parquet(path)
    assert "PushedFilters: [IsNotNull(processed_at), GreaterThanOrEqual(processed_at" in plan(since_watermark(table, table))


def test_fully_rejected_date_is_not_taken_for_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    row = ("a", "2026-01-01T00:00:00+00:00", "c", "m", 5.0, "USD", "US", "fuel", "credit_card", "d", False)
    good = spark.createDataFrame([row], RAW_TRANSACTION)
    bad = spark.createDataFrame([(*row[:4], -5.0, *row[5:])], RAW_TRANSACTION)
    assert process(good, path, "2026-01-01")["clean_count"] == 1
    assert process(good, path, "2026-01-01")["clean_count"] == 1
    with pytest.raises(RuntimeError):
        process(bad, path, "2026-01-01")
    with pytest.raises(RuntimeError):  # nothing selected: refused before any write
        process(good, path, str(date(2026, 1, 2)))


def test_rank_join_back_gathers_no_hot_key(spark):
    """Nine rows in ten share one order key; after the shuffle no partition holds much more than its share."""
    from pyspark.sql import functions as F

    from riskloom.operators.rank import percent_rank

    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).cast("double").alias("rate"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = percent_rank(rows, ["rate"])
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
        hot = ranked.where("rate = -1").agg(F.min("risk_percentile"), F.max("risk_percentile"), F.count("*")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 2 * 20_000 / len(sizes) and len(sizes) > 1
    assert tuple(hot) == (0.0, 0.0, 18_000)
