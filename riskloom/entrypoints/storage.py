"""Queries that write tables and read them back: sinks, merges, incremental runs, generators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.entrypoints.inputs import NEWEST, clean, described, feature, processed, processed_to_write, table_once
from riskloom.entrypoints.oracle import CTES
from riskloom.entrypoints.registry import query
from riskloom.functions.times import epoch_seconds, iso_utc
from riskloom.generate.late import late_fixture
from riskloom.operators import merge
from riskloom.plans import etl, features, incremental, models
from riskloom.quality import rulesets
from riskloom.schemas import PROCESSED, RAW_TRANSACTION
from riskloom.session import work_folder
from riskloom.sinks import tables
from riskloom.sources import star_schema as star
from riskloom.sources import transactions as scans
from riskloom.sources.files import delete_folder

_DAY = "1998-07-04"
_COLUMNS = [c for c in PROCESSED.fieldNames() if c not in ("source_file", "processed_at")]
_TX = ", ".join(_COLUMNS)


# --- scans ------------------------------------------------------------------------------


@query(
    "s1_csv_scan",
    """SELECT transaction_id, event_timestamp, customer_id, merchant_id, amount, currency, country,
              merchant_category, payment_method, device_id, is_fraud FROM raw""",
)
def s1(spark, d):
    path = work_folder(spark, "raw-csv")
    star.raw_transactions(spark, d).drop("source_offset").write.csv(path, header=True)
    return scans.read_raw(spark, f"{path}/*.csv")


def _stored_processed(spark, d, **options):
    path = work_folder(spark, "processed")
    with processed_to_write(spark, d, *_COLUMNS) as rows:
        tables.write_partitioned(rows, path, **options)
    return path


def _processed_table(spark, d):
    """The stored processed table, for queries that only read it."""
    write = lambda path: tables.write_partitioned(processed(spark, d, *_COLUMNS), path)
    return table_once(spark, d, "processed-table", write)


@query("s2_partitioned_scan", f"SELECT {_TX} FROM processed")
def s2(spark, d):
    return scans.read_processed(spark, _processed_table(spark, d))


@query("s3_one_date_scan", f"SELECT {_TX} FROM processed WHERE event_date = DATE '{_DAY}'")
def s3(spark, d):
    return scans.read_partition(spark, _processed_table(spark, d), _DAY)


@query("s6_external_table", "SELECT l_returnflag, COUNT(*) AS line_count FROM lineitem GROUP BY l_returnflag")
def s6(spark, d):
    scans.register_external(spark, "lineitem_files", f"{d}/lineitem.parquet")
    return spark.sql("SELECT l_returnflag, COUNT(*) AS line_count FROM lineitem_files GROUP BY l_returnflag")


@query(
    "s9_literal_rows",
    """SELECT n_name AS country, currency FROM nation JOIN (VALUES (0, 'USD'), (1, 'CAD'), (2, 'GBP'), (3, 'INR'), (4, 'EUR'))
       AS c(region, currency) ON n_regionkey = region""",
)
def s9(spark, d):
    codes = scans.from_rows(spark, list(star.REGION_CURRENCY.items()), "region int, currency string")
    nation = star.table(spark, d, "nation")
    return nation.join(codes, nation["n_regionkey"] == codes["region"]).select(F.col("n_name").alias("country"), "currency")


# --- sinks -------------------------------------------------------------------------------


@query("k1_baseline_write", f"SELECT {_TX} FROM processed")
def k1(spark, d):
    return scans.read_processed(spark, _stored_processed(spark, d, strategy="baseline"))


@query("k2_gathered_write", f"SELECT {_TX} FROM processed")
def k2(spark, d):
    return scans.read_processed(spark, _stored_processed(spark, d, strategy="repartitioned"))


@query(
    "k3_dynamic_overwrite",
    f"""SELECT * REPLACE (CASE WHEN event_date BETWEEN DATE '1998-07-01' AND DATE '1998-07-31' THEN amount + 1 ELSE amount END AS amount)
        FROM (SELECT {_TX} FROM processed)""",
)
def k3(spark, d):
    path = _stored_processed(spark, d)
    july = scans.read_processed(spark, path).where("event_date between date'1998-07-01' and date'1998-07-31'")
    changed = july.withColumn("amount", F.col("amount") + 1)
    again = work_folder(spark, "july")
    changed.write.parquet(again)
    tables.write_partitioned(spark.read.parquet(again), path, dynamic=True)
    return scans.read_processed(spark, path)


@query("k4_feature_write", "SELECT COUNT(*) AS rows_written FROM merchant_features")
def k4(spark, d):
    path = work_folder(spark, "feature")
    rows = tables.write_feature(feature(spark, d, "merchant_risk_features"), path)
    return spark.read.parquet(path).agg(F.lit(rows).cast("long").alias("rows_written"))


@query(
    "k14_clustered_write",
    f"SELECT {_TX} FROM processed",
)
def k14(spark, d):
    return scans.read_processed(spark, _stored_processed(spark, d, cluster_by=["merchant_id", "customer_id"]))


def _by_month(spark, d):
    return processed(spark, d, *_COLUMNS).withColumn("event_month", F.trunc("event_date", "month"))


@query("k15_retention", f"SELECT {_TX} FROM processed WHERE date_trunc('month', event_date) >= DATE '1999-06-01' - 1000")
def k15(spark, d):
    """Folders of months that are past the retention go; what is left is read back."""
    path = work_folder(spark, "retention")
    tables.write_partitioned(_by_month(spark, d), path, partition_by="event_month")
    tables.apply_retention(spark, path, "event_month", 1000, "1999-06-01")
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "q11_write_check",
    """SELECT COUNT(*) AS written_rows, COUNT(*) AS stored_rows,
              COUNT(*) FILTER (WHERE event_date BETWEEN DATE '1995-03-01' AND DATE '1995-03-31') AS lost_rows FROM processed""",
)
def q11(spark, d):
    """Rows that entered a write, rows in its files, and what the check says is lost when a folder is gone."""
    path = work_folder(spark, "checked")
    written = tables.write_checked(_by_month(spark, d), path, partition_by="event_month")
    stored = tables.stored_rows(spark, path)
    delete_folder(spark, f"{path}/event_month=1995-03-01")
    try:
        lost = written - tables.verify_write(spark, path, written)
    except RuntimeError:
        lost = written - tables.stored_rows(spark, path)
    return spark.createDataFrame([(written, stored, lost)], "written_rows long, stored_rows long, lost_rows long")


# --- merges --------------------------------------------------------------------------------

# Fraud rows corrected (amount, one day later) and, under a new id, inserted.
CTES["stage"] = """
SELECT transaction_id, event_timestamp + INTERVAL 1 DAY AS event_timestamp, event_date + 1 AS event_date, event_hour,
       customer_id, merchant_id, amount + 1 AS amount, currency, country, merchant_category, payment_method, device_id, is_fraud
FROM processed WHERE is_fraud
UNION ALL
SELECT transaction_id || '-N', event_timestamp, event_date, event_hour, customer_id, merchant_id, amount, currency,
       country, merchant_category, payment_method, device_id, is_fraud
FROM processed WHERE is_fraud"""
# Ids are unique and the stage holds the fraud ids and their copies, so one pass says the same as an anti-join.
CTES["merged"] = f"""
SELECT {_TX} FROM (
  SELECT CASE WHEN k = 1 THEN transaction_id || '-N' ELSE transaction_id END AS transaction_id,
         CASE WHEN k = 0 AND is_fraud THEN event_timestamp + INTERVAL 1 DAY ELSE event_timestamp END AS event_timestamp,
         CASE WHEN k = 0 AND is_fraud THEN event_date + 1 ELSE event_date END AS event_date, event_hour,
         customer_id, merchant_id, CASE WHEN k = 0 AND is_fraud THEN amount + 1 ELSE amount END AS amount, currency,
         country, merchant_category, payment_method, device_id, is_fraud
  FROM processed, (VALUES (0), (1)) AS copies(k) WHERE k = 0 OR is_fraud)"""


def _stage(fact):
    fraud = fact.where("is_fraud")
    moved = fraud.withColumns(
        {
            "event_timestamp": F.col("event_timestamp") + F.make_dt_interval(days=F.lit(1)),
            "event_date": F.date_add("event_date", 1),
            "amount": F.col("amount") + 1,
        }
    )
    return moved.unionByName(fraud.withColumn("transaction_id", F.concat("transaction_id", F.lit("-N"))))


@query("m1_merge_upsert", f"SELECT {_TX} FROM merged")
def m1(spark, d):
    fact = processed(spark, d, *_COLUMNS)
    return merge.merge_upsert(fact, _stage(fact))


@query("m1_merge_into_table", f"SELECT {_TX} FROM merged")
def m1_table(spark, d):
    path = _stored_processed(spark, d)
    merge.merge_into(spark, path, _stage(scans.read_processed(spark, path)))
    return scans.read_processed(spark, path)


@query(
    "m2_stage_checks",
    """SELECT 'stage' AS table_name, "check", failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
         SELECT 'not_empty' AS "check", 0 AS failures
         UNION ALL SELECT 'grain_transaction_id', COUNT(*) - COUNT(DISTINCT transaction_id) FROM tx
         UNION ALL SELECT 'not_null_transaction_id', 0
         UNION ALL SELECT 'other_date', COUNT(*) FILTER (WHERE event_date != DATE '1998-07-04') FROM tx)""",
)
def m2(spark, d):
    return merge.stage_checks(star.transactions(spark, d, ["transaction_id", "event_date"]), _DAY)


def _canonical(spark, d):
    """Processed table with all fifteen columns, stored once."""
    def write(path):
        kept = etl.clean_transactions(etl.transform(star.raw_lines(spark, d)), NEWEST)
        tables.write_partitioned(described(spark, d, kept, *PROCESSED.fieldNames()), path)

    return table_once(spark, d, "canonical-table", write)


def _raw_once(spark, d):
    """Raw rows whose ids are unique, as CSV: the input a one-date run reads again and again."""
    def write(path):
        text = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
        rows = spark.read.parquet(_canonical(spark, d)).withColumn("event_timestamp", text)
        rows.select(*RAW_TRANSACTION.fieldNames()).write.csv(path, header=True, compression="gzip")

    return scans.read_raw(spark, table_once(spark, d, "raw-csv", write), with_file=True)


def _older_target(spark, source, target):
    """The date as it was before: some rows not there yet, the others with another amount."""
    rows = scans.read_processed(spark, source).where(F.col("event_date") == F.lit(_DAY).cast("date"))
    old = rows.where(~F.right("transaction_id", F.lit(1)).isin("0", "1", "2")).withColumn("amount", F.col("amount") - 1)
    tables.write_partitioned(old, target)


@query(
    "m3_merge_partition",
    f"""SELECT CAST((SELECT COUNT(*) FROM clean_latest WHERE event_date = DATE '{_DAY}'
                       AND right(transaction_id, 1) NOT IN ('0', '1', '2')) AS BIGINT) AS before_rows,
               CAST((SELECT COUNT(*) FROM clean_latest WHERE event_date = DATE '{_DAY}') AS BIGINT) AS staged_rows,
               CAST((SELECT COUNT(*) FROM clean_latest WHERE event_date = DATE '{_DAY}') AS BIGINT) AS after_rows,
               CAST((SELECT COUNT(*) FROM clean_latest WHERE event_date = DATE '{_DAY}') AS BIGINT) AS unique_transaction_ids""",
)
def m3(spark, d):
    source, target = _canonical(spark, d), work_folder(spark, "target")
    _older_target(spark, source, target)
    result = merge.merge_partition(spark, source, target, _DAY)
    return spark.createDataFrame([tuple(result.values())], ", ".join(f"{k} long" for k in result))


CTES["late_source"] = f"""
SELECT * FROM raw WHERE transaction_id = (SELECT MIN(transaction_id) FROM clean_latest WHERE event_date = DATE '{_DAY}')
ORDER BY event_timestamp DESC, source_offset DESC LIMIT 1"""
_REST = "currency, country, merchant_category, payment_method, device_id"


@query(
    "g3_late_fixture",
    f"""SELECT transaction_id, '{_DAY}T12:00:00+00:00' AS event_timestamp, customer_id, merchant_id,
               round(amount + 1, 2) AS amount, {_REST}, is_fraud FROM late_source
        UNION ALL SELECT 'LATE_19980704_000001', '{_DAY}T23:59:59+00:00', customer_id, merchant_id, 123.45, {_REST}, false
        FROM late_source""",
)
def g3(spark, d):
    return late_fixture(star.raw_transactions(spark, d), clean(spark, d), _DAY, tuple(NEWEST))


@query(
    "m7_late_data_scenario",
    f"""SELECT '{_DAY}' AS event_date, n AS baseline_rows, n AS first_merge_rows, n AS same_date_rerun_rows, n + 1 AS late_merge_rows,
               CAST(1 AS BIGINT) AS rows_added_by_late_batch, CAST(0 AS BIGINT) AS duplicate_rows, CAST(1 AS BIGINT) AS late_transaction_rows,
               CAST(1 AS BIGINT) AS corrected_transaction_rows, 'PASSED' AS verification
        FROM (SELECT COUNT(*) AS n FROM clean_latest WHERE event_date = DATE '{_DAY}')""",
)
def m7(spark, d):
    evidence = incremental.late_data_scenario(
        spark, _raw_once(spark, d), _canonical(spark, d), work_folder(spark, "late"), _DAY
    )
    return spark.createDataFrame([tuple(evidence.values())], list(evidence))


@query(
    "a19_late_merge_row",
    """SELECT COUNT(*) - COUNT(DISTINCT transaction_id) AS duplicate_rows,
              COUNT(*) FILTER (WHERE transaction_id = '100-2') AS late_rows,
              COUNT(*) FILTER (WHERE transaction_id = '100-1' AND abs(amount - 50000.5) < 0.000001) AS corrected_rows FROM tx""",
)
def a19(spark, d):
    return merge.late_merge_row(star.transactions(spark, d, ["transaction_id", "amount"]), "100-2", "100-1", 50000.5)


_SPLIT = "2000-01-01 00:00:00"


@query(
    "f11_since_watermark",
    f"""SELECT transaction_id, event_timestamp AS processed_at FROM processed
        WHERE event_timestamp >= (SELECT MAX(event_timestamp) FROM processed WHERE event_timestamp < TIMESTAMP '{_SPLIT}')""",
)
def f11(spark, d):
    rows = processed(spark, d, "transaction_id", "event_timestamp").withColumnRenamed("event_timestamp", "processed_at")
    return merge.since_watermark(rows, rows.where(f"processed_at < timestamp'{_SPLIT}'"))


@query("m4_incremental_fact", f"SELECT {_TX} FROM processed")
def m4(spark, d):
    stored, path = work_folder(spark, "stg"), work_folder(spark, "fct")
    with processed_to_write(spark, d) as rows:
        fact = rows.withColumns({"source_file": F.lit("table"), "processed_at": F.col("event_timestamp")})
        tables.write_partitioned(models.fct_select(fact), stored)
    stg = models.fct_select(spark.read.parquet(stored))
    # Some later rows are there already in an earlier state, on another date; the second load corrects them.
    later = f"processed_at >= timestamp'{_SPLIT}'"
    earlier = stg.where(f"{later} and amount > 50000").withColumns({
        "amount": F.col("amount") - 1, "event_date": F.date_sub("event_date", 1),
        "processed_at": F.lit(_SPLIT).cast("timestamp") - F.expr("interval 1 day")})
    merge.build_fct(spark, path, stg.where(f"not ({later})").unionByName(earlier))
    merge.build_fct(spark, path, stg)
    delete_folder(spark, stored)
    return scans.read_processed(spark, path).select(*_COLUMNS)


@query("m6_date_snapshot", f"SELECT {_TX} FROM processed WHERE event_date = DATE '{_DAY}'")
def m6(spark, d):
    path = work_folder(spark, "snapshot")
    merge.snapshot_partition(spark, _processed_table(spark, d), path, _DAY)
    return scans.read_processed(spark, path)


@query("s8_stored_evidence", "SELECT COUNT(*) AS row_count, COUNT(DISTINCT transaction_id) AS unique_ids, 'PASSED' AS status FROM tx")
def s8(spark, d):
    """A result row written as CSV with a header and read back by its schema."""
    path = work_folder(spark, "evidence")
    row = merge.table_metrics(star.transactions(spark, d, ["transaction_id"])).first()
    tables.write_evidence(spark, {**row.asDict(), "status": "PASSED"}, path)
    return scans.read_evidence(spark, path, "row_count long, unique_ids long, status string")


@query(
    "k11_events_as_json_lines",
    """SELECT '{"country":"' || country || '","event_hour":' || event_hour || ',"merchant_id":"' || merchant_id
              || '","transaction_id":"' || transaction_id || '"}' AS value FROM tx""",
)
def k11(spark, d):
    """One JSON object per line, keys in alphabetical order."""
    path = work_folder(spark, "json-lines")
    tables.write_events_jsonl(star.transactions(spark, d, ["transaction_id", "merchant_id", "event_hour", "country"]), path)
    return spark.read.text(path)


@query("k9_replaced_table", "SELECT event_date, COUNT(*) AS row_count FROM processed GROUP BY event_date")
def k9(spark, d):
    """A named table loaded twice, read by its name while it is replaced; the second load stands alone."""
    name = f"daily_{uuid.uuid4().hex}"
    daily = processed(spark, d, "event_date").groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))
    tables.load_table(daily.withColumn("row_count", F.lit(-1).cast("long")), name, work_folder(spark, "named"))
    tables.load_table(daily, name, work_folder(spark, "named"))
    return spark.table(name)


@query(
    "q12_inventory_contract",
    """SELECT 'processed' AS table_name, 'not_empty' AS "check", CAST(COUNT(*) = 0 AS BIGINT) AS failures,
              CASE WHEN COUNT(*) = 0 THEN 'fail' ELSE 'pass' END AS status FROM processed
       UNION ALL SELECT 'processed', 'expected_partitions', CAST(COUNT(DISTINCT date_trunc('month', event_date)) != 31 AS BIGINT),
              CASE WHEN COUNT(DISTINCT date_trunc('month', event_date)) != 31 THEN 'fail' ELSE 'pass' END FROM processed
       UNION ALL SELECT 'processed', 'date_folder_in_flat_table', COUNT(DISTINCT date_trunc('month', event_date)), 'fail' FROM processed""",
)
def q12(spark, d):
    """Folders by month, checked against 31 of them and as if the table were flat; months are gathered, one file each."""
    root = f"{work_folder(spark, 'inventory')}/processed"
    months = processed(spark, d, "event_date", "amount").withColumn("event_date", F.trunc("event_date", "month"))
    tables.write_partitioned(months.repartition("event_date"), root, "baseline")
    return rulesets.inventory_contract(spark, root, partitions=31, flat=True)


@query(
    "x5_iso_utc",
    "SELECT transaction_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS text, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS seconds FROM tx",
)
def x5(spark, d):
    """An instant as ISO text, and the text as seconds again."""
    text = iso_utc(F.col("event_timestamp"))
    return star.transactions(spark, d, ["transaction_id", "event_timestamp"]).select("transaction_id", text.alias("text")).withColumn(
        "seconds", epoch_seconds("text"))


@query("p14_stamped_features", "SELECT merchant_id, transaction_count, TRUE AS stamped FROM merchant_features")
def p14(spark, d):
    stamped = features.add_generated_at(feature(spark, d, "merchant_risk_features"))
    return stamped.select("merchant_id", "transaction_count", F.col("feature_generated_at").isNotNull().alias("stamped"))


# --- whole batch -------------------------------------------------------------------------------


@query("m8_incremental_run", f"SELECT {_TX} FROM clean_latest WHERE event_date = DATE '{_DAY}'")
def m8(spark, d):
    processed_root, target = work_folder(spark, "incremental"), work_folder(spark, "target")
    _older_target(spark, _canonical(spark, d), target)
    incremental.run_incremental(spark, _raw_once(spark, d), processed_root, target, _DAY)
    return scans.read_processed(spark, target).select(*_COLUMNS)


@query(
    "p3_etl_table",
    f"SELECT {_TX} FROM clean_latest",
)
def etl_table(spark, d):
    path = work_folder(spark, "etl")
    etl.process(star.raw_transactions(spark, d), path, newest=NEWEST)
    return scans.read_processed(spark, path).select(*_COLUMNS)


@query(
    "u4_inventory_difference",
    """SELECT CAST((SELECT COUNT(DISTINCT event_date) FROM processed WHERE event_date BETWEEN DATE '1998-07-01' AND DATE '1998-07-31') AS BIGINT)
              AS changed_dates""",
)
def u4(spark, d):
    from riskloom.operators.compare import file_inventory, inventory_diff

    path = _stored_processed(spark, d)
    before = work_folder(spark, "inventory")
    file_inventory(spark, path).write.parquet(before)  # stored before the files change
    july = work_folder(spark, "july")
    scans.read_processed(spark, path).where("event_date between date'1998-07-01' and date'1998-07-31'").write.parquet(july)
    tables.write_partitioned(spark.read.parquet(july), path, dynamic=True)
    changed = inventory_diff(spark.read.parquet(before), file_inventory(spark, path))
    day = F.regexp_extract("path", "event_date=([0-9-]+)", 1)
    return changed.agg(F.count_distinct(day).alias("changed_dates"))


@query(
    "a20_partition_counts",
    """SELECT CAST(COUNT(DISTINCT event_date) AS BIGINT) AS logical_dates, CAST(COUNT(DISTINCT event_date) AS BIGINT) AS physical_dates
       FROM processed""",
)
def a20(spark, d):
    from riskloom.quality.rulesets import partition_counts

    path = _processed_table(spark, d)
    return partition_counts(spark, path, scans.read_processed(spark, path)).select("logical_dates", "physical_dates")
