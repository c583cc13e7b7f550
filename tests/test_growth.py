"""What must not grow faster than the tables: joins of lines, partitions of shuffles, row groups of records."""

import re
import time
import uuid
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskloom.entrypoints import inputs, quality, storage, streams
from riskloom.operators import merge
from riskloom.operators.clean import dedup_latest
from riskloom.quality import rules
from riskloom.session import MERGED, PARTITION_BYTES, PARTITIONS, fit_partitions, release_partitions
from riskloom.sinks import tables
from riskloom.sources import star_schema as star

DAY = datetime(1998, 7, 4)


@pytest.fixture
def folder(tmp_path):
    """Lines with copies and missing keys; every dimension row comes twice."""
    keys = [(1, 1), (1, 1), (1, 2), (2, 1), (None, 3), (3, None), (3, None), (None, None), (None, None), (4, 1)]
    lines = {
        "l_orderkey": pa.array([k for k, _ in keys], pa.int64()), "l_linenumber": pa.array([n for _, n in keys], pa.int32()),
        "l_partkey": pa.array([5, 6, 7, 5, 6, 7, 5, 6, None, 97], pa.int64()), "l_suppkey": pa.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 1], pa.int64()),
        "l_quantity": pa.array([50.0] * 10), "l_extendedprice": pa.array([float(i + 1) for i in range(10)]),
        "l_returnflag": pa.array(["R"] * 10), "l_shipdate": pa.array([DAY] * 10, pa.timestamp("us")),
    }
    tables = {
        "lineitem": lines,
        "orders": {"o_orderkey": pa.array([1, 2, 3, 4] * 2, pa.int64()), "o_custkey": pa.array([1, 2, 9, 1] * 2, pa.int64()),
                   "o_orderpriority": pa.array(["1-URGENT", "5-LOW", "2-HIGH", None] * 2)},
        "customer": {"c_custkey": pa.array([1, 2] * 2, pa.int64()), "c_nationkey": pa.array([7, 8] * 2, pa.int32())},
        "nation": {"n_nationkey": pa.array([7, 8], pa.int32()), "n_name": pa.array(["A", "B"]), "n_regionkey": pa.array([0, 4], pa.int32())},
        "part": {"p_partkey": pa.array([5, 6, 7, 97] * 2, pa.int64()), "p_type": pa.array(["SMALL", "LARGE", "PROMO", "X"] * 2)},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_customers_are_joined_to_orders_not_to_lines(spark, folder):
    for frame in (star.transactions(spark, folder, ["country"]), star.latest_transactions(spark, folder, ["customer_id", "country"])):
        joins = [line for line in plan(frame).splitlines() if "Join LeftOuter" in line]
        of_customers = next(line for line in joins if "o_custkey" in line)
        of_orders = next(line for line in joins if "l_orderkey" in line or "o_orderkey" in line)
        depth = lambda line: len(re.match(r"[\s:+|-]*", line).group())
        assert depth(of_customers) > depth(of_orders)


def test_checks_of_lines_join_nothing(spark, folder):
    assert "Join" not in plan(inputs.typed(spark, folder, "transaction_id"))


def test_clean_rows_lose_their_copies_before_they_are_described(spark, folder):
    text = plan(inputs.clean(spark, folder))
    assert text.index("Join") < text.index("row_number")  # the tree is printed from its root
    rows = inputs.clean(spark, folder).collect()
    assert sorted(r.transaction_id for r in rows) == ["", "1-1", "1-2", "2-1", "3"]  # one each, though orders come twice
    assert {r.transaction_id: r.country for r in rows} == {"": None, "1-1": "A", "1-2": "A", "2-1": "B", "3": None}


def test_missing_line_keys_make_the_same_ids_as_before(spark, folder):
    rows = star.latest_transactions(spark, folder, ["transaction_id", "merchant_id", "amount"]).collect()
    newest = {"1-1": 2.0, "1-2": 3.0, "2-1": 4.0, "3": 5.0, "": 8.0, "4-1": 10.0}
    by_text = star.transactions(spark, folder, ["transaction_id", "event_timestamp", "source_offset", "amount"]).collect()
    wanted = {}
    for r in sorted(by_text, key=lambda r: (r.event_timestamp is not None and (r.event_timestamp, r.source_offset)) or (datetime.min, 0)):
        wanted[r.transaction_id] = r.amount
    assert {r.transaction_id: r.amount for r in rows} == wanted and len(rows) == len(wanted) == len(newest)


def test_shuffles_have_partitions_for_the_tables(spark, folder, monkeypatch):
    monkeypatch.setattr("riskloom.session.folder_bytes", lambda *_: 100 * PARTITION_BYTES)
    try:
        fit_partitions(spark, folder)
        assert (spark.conf.get(PARTITIONS), spark.conf.get(MERGED)) == ("100", "16777216")
        assert spark.range(10).repartition("id").rdd.getNumPartitions() <= 100
        release_partitions(spark)
        assert spark.conf.get(PARTITIONS, None) is None and spark.conf.get(MERGED, None) is None
        spark.conf.set(MERGED, "8m")
        fit_partitions(spark, folder)
        assert spark.conf.get(MERGED) == "8m"  # what the session states stands
    finally:
        spark.conf.unset(MERGED)
        release_partitions(spark)


def test_raw_files_hold_the_canonical_rows(spark, folder):
    raw = storage._raw_once(spark, folder)
    stored = spark.read.parquet(storage._canonical(spark, folder))
    assert sorted(r.transaction_id or "" for r in raw.collect()) == sorted(r.transaction_id for r in stored.collect())
    assert all(f.endswith(".gz") for r in raw.select("source_file").collect() for f in r)


def test_record_files_can_be_read_by_many_tasks(spark, tmp_path):
    n = 60_000
    pq.write_table(pa.table({
        "event_id": pa.array(range(n), pa.int64()), "ts": pa.array([DAY] * n, pa.timestamp("us")),
        "user_id": pa.array([i % 500 for i in range(n)], pa.int64()), "event_type": pa.array(["click"] * n),
        "value": pa.array([float(i % 300) for i in range(n)]), "props": pa.array(["{}"] * n),
    }), f"{tmp_path}/events.parquet")
    files = [f.removeprefix("file:") for f in spark.read.parquet(streams._record_files(spark, str(tmp_path))).inputFiles()]
    assert len(files) == 12 and sum(pq.ParquetFile(f).metadata.num_rows for f in files) == n
    assert min(pq.ParquetFile(f).num_row_groups for f in files) > 1


def test_grain_of_one_column_expands_nothing(spark):
    """Two counts of one column are one; before, the rows were expanded for the second. Null counts as a key."""
    def found(ids):
        rows = spark.createDataFrame([(i,) for i in ids], "id string")
        return rules.evaluate(rows, "t", [rules.grain("id"), rules.expected_value("ids", F.count_distinct("id"), 2)])

    assert "Expand" not in found(["a"])._jdf.queryExecution().toString()
    assert [[r.failures for r in found(ids).collect()] for ids in (["a", "a", "b", None, None], ["a", "b"], [None], [])] == [
        [2, 0], [0, 0], [0, 1], [0, 1]]


def _same(a, b):
    key = lambda r: repr(r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.select(*a.columns).collect()), key=key)


def _kept_in(monkeypatch, tmp_path):
    for module in (inputs, storage, merge):
        monkeypatch.setattr(module, "work_folder", lambda spark, label: f"{tmp_path}/kept/{label}-{uuid.uuid4().hex}")
    return lambda: {path.name.rsplit("-", 1)[0] for path in (tmp_path / "kept").iterdir()}


def _shuffle_files(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def _no_more_shuffle_files_than(spark, files):
    for _ in range(100):                      # Spark removes the files of a run soon after it
        if _shuffle_files(spark) <= files:
            return True
        time.sleep(0.1)
    return False


@pytest.mark.parametrize("name", ["q8", "q9"])
def test_checks_leave_no_tables_and_no_shuffle_files(spark, folder, tmp_path, monkeypatch, name):
    left, files = _kept_in(monkeypatch, tmp_path), _shuffle_files(spark)
    found = getattr(quality, name)(spark, folder)
    assert left() == {"checks"}
    assert _no_more_shuffle_files_than(spark, files)
    assert found.count() > 20


@pytest.mark.parametrize("name", ["q8", "q9"])
def test_checks_by_parts_find_the_same(spark, folder, monkeypatch, name):
    whole = getattr(quality, name)(spark, folder)
    monkeypatch.setattr(inputs, "parts_for", lambda size: 3)
    assert _same(whole, getattr(quality, name)(spark, folder))


def test_the_stored_fact_is_described_by_parts(spark, folder, tmp_path, monkeypatch):
    left = _kept_in(monkeypatch, tmp_path)
    monkeypatch.setattr(inputs, "parts_for", lambda size: 3)
    fact = inputs.stored_processed(spark, folder)
    assert _same(inputs.processed(spark, folder), fact) and left() == {"processed"}
    for name, feature in inputs.features.FEATURE_TABLES.items():
        assert _same(feature.build(fact, inputs.LIMIT), inputs.stored_feature(fact, name))
    with inputs.processed_to_write(spark, folder, "transaction_id", "event_date") as rows:
        assert _same(inputs.processed(spark, folder, "transaction_id", "event_date"), rows)
    assert not [name for name in left() if name == "newest-lines"]


def test_lines_are_told_by_the_order_of_copies(spark, tmp_path):
    """Part, supplier and ship date come back as they were, also where the order of copies does not tell them."""
    parts, supps = [5, None, 5, None, 5, 5, -3, 0, 5, 5], [1, 1, None, None, -1, 1 << 32, (1 << 32) - 1, 0, 1, 1]
    pq.write_table(pa.table({
        "l_orderkey": pa.array([*range(9), 8], pa.int64()), "l_linenumber": pa.array([1] * 10, pa.int32()),
        "l_partkey": pa.array(parts, pa.int64()), "l_suppkey": pa.array(supps, pa.int64()),
        "l_quantity": pa.array([1.0] * 10), "l_extendedprice": pa.array([float(i) for i in range(10)]), "l_returnflag": pa.array(["R"] * 10),
        "l_shipdate": pa.array([DAY, DAY, DAY, DAY, datetime(1998, 7, 4, 23, 59, 59, 5), DAY, DAY, DAY, DAY, None], pa.timestamp("us")),
    }), f"{tmp_path}/lineitem.parquet")
    names = ["transaction_id", "event_timestamp", "event_date", "event_hour", "merchant_id", "device_id", "amount", "source_offset"]
    wanted = dedup_latest(star.transactions(spark, str(tmp_path), names), ["transaction_id"], ["event_timestamp", "source_offset"])
    assert _same(wanted, star.latest_transactions(spark, str(tmp_path), names)) and wanted.count() == 9
    lines = star.newest_lines(spark, str(tmp_path), names).orderBy("l_orderkey").collect()
    assert [r.l_partkey for r in lines] == parts[:9] and [r.l_suppkey for r in lines] == supps[:9]


def _dated(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, event_date string, amount int").withColumn(
        "event_date", F.to_date("event_date"))


@pytest.mark.parametrize("dynamic", [False, True])
def test_dates_are_written_by_parts(spark, tmp_path, monkeypatch, dynamic):
    path, source, parts = str(tmp_path / "t"), str(tmp_path / "s"), []
    _dated(spark, [(f"t{i}", f"2026-01-{1 + i % 9:02d}" if i % 10 else None, i) for i in range(90)]).write.parquet(source)
    tables.write_partitioned(_dated(spark, [("old", "2026-02-01", 1), ("old", "2026-01-01", 1)]), path)
    monkeypatch.setattr(tables, "parts_for", lambda size: parts.append(size) or 4)
    rows, files = spark.read.parquet(source), _shuffle_files(spark)
    tables.write_partitioned(rows, path, dynamic=dynamic)
    assert parts[0] > 0 and _no_more_shuffle_files_than(spark, files)
    kept = _dated(spark, [("old", "2026-02-01", 1)] if dynamic else [])
    assert _same(rows.unionByName(kept), spark.read.parquet(path))


def test_merge_by_groups_of_dates(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    left, real = _kept_in(monkeypatch, tmp_path), merge.write_partitioned
    tables.write_partitioned(_dated(spark, [(f"t{i}", f"2026-01-{1 + i % 9:02d}", i) for i in range(90)]), path)
    stage = _dated(spark, [("t0", "2026-01-02", 100), ("t1", "2026-01-02", 101), ("new", "2026-01-30", 1), ("t8", "2026-01-01", 108)])
    rows = lambda: {r.transaction_id: (r.amount, str(r.event_date)) for r in spark.read.parquet(path).collect()}
    before = rows()
    wanted = before | {"t0": (100, "2026-01-02"), "t1": (101, "2026-01-02"), "new": (1, "2026-01-30"), "t8": (108, "2026-01-01")}
    monkeypatch.setattr(merge, "parts_for", lambda size: 2)      # every date is a group
    written = []

    def breaking(merged, to):
        real(merged, to)
        written.append(to)
        if len(written) == 2:
            raise OSError("broken off")

    monkeypatch.setattr(merge, "write_partitioned", breaking)
    with pytest.raises(OSError):
        merge.merge_into(spark, path, stage)
    assert rows() == before and merge.finish_merges(spark, path) == 1 and rows() == before
    files = _shuffle_files(spark)
    assert merge.merge_into(spark, path, stage) == [date(2026, 1, d) for d in (1, 2, 9, 30)]
    assert _no_more_shuffle_files_than(spark, files)
    assert len(written) == 6 and rows() == wanted and spark.read.parquet(path).count() == 91


def test_incremental_fact_leaves_only_the_fact(spark, folder, tmp_path, monkeypatch):
    left, files = _kept_in(monkeypatch, tmp_path), _shuffle_files(spark)
    for module in (inputs, tables, merge):
        monkeypatch.setattr(module, "parts_for", lambda size: 2)
    fact = storage.m4(spark, folder)
    assert left() == {"fct"} and _no_more_shuffle_files_than(spark, files)
    assert _same(inputs.processed(spark, folder, *fact.columns).where("event_date is not null"), fact)
