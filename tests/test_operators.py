import glob
import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskloom.functions.amounts import money_avg, money_sum
from riskloom.functions.times import has_offset, iso_date, parse_instant_strict, parse_iso
from riskloom.generate.events import generate_events
from riskloom.generate.transactions import generate_transactions
from riskloom.operators import compare, merge
from riskloom.operators.clean import clean_filter, dedup_latest, transform
from riskloom.operators.rank import percent_rank
from riskloom.plans.etl import process
from riskloom.quality.rules import ContractError, evaluate, not_null, require_all, unique
from riskloom.schemas import RAW_TRANSACTION
from riskloom.sinks import tables
from riskloom.sources.files import child_names, delete_folder
from riskloom.sources.transactions import read_raw


def test_money_sum_rounds_nothing(spark):
    cases = {"five": ([0.00004] * 10_000, 0.4), "six": ([0.12345] * 10, 1.2345), "large": ([1e20, 0.1, 0.2], 1e20),
             "tiny": ([1e-12, 1e-12], 2e-12), "mixed": ([1e-12, 0.5], 0.5 + 1e-12), "inf": ([float("inf"), 1.0], float("inf"))}
    rows = spark.createDataFrame([(k, x) for k, (values, _) in cases.items() for x in values], "k string, amount double")
    found = {r["k"]: r["s"] for r in rows.groupBy("k").agg(money_sum("amount").alias("s")).collect()}
    assert found == {k: total for k, (_, total) in cases.items()}


def test_money_sum_keeps_nan_and_null(spark):
    rows = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", float("nan")), ("b", 1.0), ("c", None)], "k string, amount double")
    found = {r["k"]: (r["s"], r["m"]) for r in rows.groupBy("k").agg(money_sum("amount").alias("s"), money_avg("amount").alias("m")).collect()}
    assert found["a"] == (0.3, 0.15)
    assert found["b"][0] != found["b"][0]  # NaN, not a shortened sum
    assert found["c"] == (None, None)


@pytest.mark.parametrize(
    "text, offset, readable",
    [
        ("2026-01-31T10:20:30+00:00", True, True), ("2026-01-31T10:20:30.123456Z", True, True),
        ("20260131T102030+0530", True, True), ("2026-01-31 10:20", False, True), ("2026-01-31", False, True),
        ("2026", False, False), ("2026-13-31T10:20:30Z", True, False), ("not-a-time", False, False), ("", False, False),
    ],
)
def test_iso_parsing(spark, text, offset, readable):
    row = spark.createDataFrame([(text,)], "t string").select(
        has_offset(F.col("t")), parse_iso(F.col("t")).isNotNull(), parse_instant_strict(F.col("t")).isNotNull()
    ).first()
    assert tuple(row) == (offset, readable, offset and readable)


def test_iso_date_refuses_other_spellings():
    assert iso_date("2026-07-08") == "2026-07-08"
    for text in ("20260708", "2026-7-8", "yesterday"):
        with pytest.raises(ValueError):
            iso_date(text)


def test_cleaning_keeps_the_newest_valid_copy(spark):
    row = ("2026-01-01T00:00:00+00:00", "c", "m", 5.0, "USD", "US", "fuel", "credit_card", "d", False)
    rows = [("a", *row), ("a", "2026-01-02T00:00:00+00:00", *row[1:]), (None, *row), ("b", "bad", *row[1:]),
            ("c", *row[:3], -1.0, *row[4:]), ("d", *row[:3], None, *row[4:])]
    clean = dedup_latest(clean_filter(transform(spark.createDataFrame(rows, RAW_TRANSACTION))), ["transaction_id"], ["event_timestamp"])
    assert [(r["transaction_id"], r["event_date"]) for r in clean.collect()] == [("a", date(2026, 1, 2))]


def test_percent_rank_equals_the_window_function_under_skew(spark):
    rng = random.Random(1)
    rows = [(i, 0.0 if i % 3 == 0 else rng.randint(0, 40) / 40, 1 if i % 3 == 0 else rng.randint(1, 5)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "id long, fraud_rate double, transaction_count long")
    frame.createOrReplaceTempView("rank_input")
    wanted = spark.sql("select id, percent_rank() over (order by fraud_rate, transaction_count) p from rank_input")
    found = percent_rank(frame, ["fraud_rate", "transaction_count"]).select("id", "risk_percentile")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert percent_rank(frame.limit(1), ["fraud_rate"]).first()["risk_percentile"] == 0.0


def test_rules_count_and_raise(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    results = evaluate(rows, "t", [not_null("k"), unique("k")])
    assert {r["check"]: r["failures"] for r in results.collect()} == {"not_null_k": 1, "unique_k": 1}
    with pytest.raises(ContractError) as error:
        require_all(results)
    assert error.value.table == "t" and error.value.actual == 1


def _day(spark, ids, day, amount):
    return spark.createDataFrame([(i, date.fromisoformat(day), amount) for i in ids], "transaction_id string, event_date date, amount double")


def test_merge_moves_rows_and_drops_emptied_dates(spark, tmp_path):
    path = str(tmp_path / "target")
    start = _day(spark, ["a"], "2026-01-01", 1.0).union(_day(spark, ["b"], "2026-01-02", 1.0)).union(_day(spark, ["c"], "2026-01-03", 1.0))
    tables.write_partitioned(start, path)
    untouched = {f["path"] for f in compare.file_inventory(spark, f"{path}/event_date=2026-01-03").collect()}
    stage = _day(spark, ["a", "d"], "2026-01-02", 2.0)
    for _ in range(2):  # the second run changes nothing
        merge.merge_into(spark, path, stage)
        found = sorted(tuple(r) for r in spark.read.parquet(path).select("transaction_id", "event_date", "amount").collect())
        assert found == [("a", date(2026, 1, 2), 2.0), ("b", date(2026, 1, 2), 1.0), ("c", date(2026, 1, 3), 1.0), ("d", date(2026, 1, 2), 2.0)]
    assert child_names(spark, path)[-2:] == ["event_date=2026-01-02", "event_date=2026-01-03"]
    assert "event_date=2026-01-01" not in child_names(spark, path)
    assert {f["path"] for f in compare.file_inventory(spark, f"{path}/event_date=2026-01-03").collect()} == untouched


def test_stage_with_another_date_is_refused(spark):
    with pytest.raises(ContractError):
        merge.validate_stage(_day(spark, ["a"], "2026-01-01", 1.0), "2026-01-02")
    with pytest.raises(ContractError):
        merge.validate_stage(_day(spark, ["a", "a"], "2026-01-01", 1.0), "2026-01-01")


def test_retention_drops_old_folders_only(spark, tmp_path):
    path = str(tmp_path / "kept")
    tables.write_partitioned(_day(spark, ["a"], "2026-01-01", 1.0).union(_day(spark, ["b"], "2026-01-08", 1.0)), path)
    assert tables.apply_retention(spark, path, "event_date", 7, "2026-01-09") == ["event_date=2026-01-01"]
    assert spark.read.parquet(path).count() == 1


def test_generated_transactions_are_reproducible_and_plausible(spark, tmp_path):
    make = lambda parts: generate_transactions(spark, 20000, 7, date(2026, 6, 8), 31, parts)
    one, many = make(1), make(6)
    assert one.exceptAll(many).count() == 0
    stats = one.agg(
        F.count_distinct("transaction_id"), F.avg(F.col("is_fraud").cast("int")), F.max("amount"), F.min("amount"),
        F.count_distinct(F.substring("event_timestamp", 1, 10)), F.percentile("amount", 0.5),
    ).first()
    assert stats[0] == 20000 and 0.025 < stats[1] < 0.045 and stats[2] <= 5000 and stats[3] > 0 and stats[4] == 31
    assert 31 < stats[5] < 35  # median of the lognormal is exp(3.5)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    one.write.csv(raw, header=True)
    metrics = process(read_raw(spark, raw, with_file=True), out)
    assert (metrics["raw_count"], metrics["clean_count"]) == (20000, 20000)
    days = [n for n in child_names(spark, out) if n.startswith("event_date=")]
    assert len(days) == 31 and compare.file_inventory(spark, out).count() == 31


def test_generated_events_hold_the_planned_faults(spark):
    rows = generate_events(spark, 11, 3, invalid_every=5, duplicate_every=4, late_every=3).collect()
    assert sum(r["amount"] < 0 for r in rows) == 2
    assert len(rows) - len({r["transaction_id"] for r in rows}) == 2
    assert rows[3]["event_timestamp"] < "2026-07-14"
    assert len({r["transaction_id"] for r in generate_events(spark, 5, 3, duplicate_every=1).collect()}) == 1
    with pytest.raises(ValueError):
        generate_events(spark, -1, 3)


def _table(spark, path, rows):
    frame = spark.createDataFrame(rows, "transaction_id string, event_date string, amount int")
    frame = frame.withColumn("event_date", F.to_date("event_date"))
    if path:
        frame.write.partitionBy("event_date").parquet(path)
    return frame


@pytest.mark.parametrize("broken_at", ["write", "list", 0, 1, 2])
def test_merge_that_breaks_off_is_finished_or_undone(spark, tmp_path, monkeypatch, broken_at):
    path = str(tmp_path / "t")
    _table(spark, path, [("a", "2026-01-01", 1), ("b", "2026-01-02", 2), ("c", "2026-01-03", 3), ("d", "2026-01-04", 4)])
    stage = _table(spark, None, [("a", "2026-01-02", 10), ("e", "2026-01-03", 50)])     # the first date is emptied
    rows = lambda: sorted((r[0], str(r[2]), r[1]) for r in spark.read.parquet(path).collect())
    before, after = rows(), [("a", "2026-01-02", 10), ("b", "2026-01-02", 2), ("c", "2026-01-03", 3), ("d", "2026-01-04", 4),
                             ("e", "2026-01-03", 50)]
    real = {"write": merge.write_partitioned, "move": merge.move_folder, "in": merge._move_in}
    moves = iter(range(10))

    def breaking(*args, **kwargs):
        raise OSError("broken off")

    def move(*args):
        if next(moves) == broken_at:
            raise OSError("broken off")
        real["move"](*args)

    if broken_at == "write":
        monkeypatch.setattr(merge, "write_partitioned", lambda rows, to: (real["write"](rows, to), breaking()))
    elif broken_at == "list":
        monkeypatch.setattr(merge, "child_names", breaking)
        monkeypatch.setattr(merge, "finish_merges", lambda *a: 0)
    else:
        monkeypatch.setattr(merge, "move_folder", move)
    if broken_at == 2:                       # there are two folders to move
        assert merge.merge_into(spark, path, stage) and rows() == after
        return
    with pytest.raises(OSError):
        merge.merge_into(spark, path, stage)
    monkeypatch.undo()
    if isinstance(broken_at, str):
        assert rows() == before              # not decided yet: as it was
    assert merge.finish_merges(spark, path) == 1
    assert rows() == (before if isinstance(broken_at, str) else after)
    for _ in range(2):
        assert [str(d) for d in merge.merge_into(spark, path, stage)][-2:] == ["2026-01-02", "2026-01-03"]
        assert rows() == after and merge.finish_merges(spark, path) == 0


def test_merge_writes_touched_dates_once(spark, tmp_path):
    path = str(tmp_path / "t")
    _table(spark, path, [(f"t{i}", f"2026-01-{1 + i % 9:02d}", i) for i in range(90)])
    untouched = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/event_date=2026-01-0[3-9]/*.parquet")}
    merge.merge_into(spark, path, _table(spark, None, [("t0", "2026-01-01", 7), ("t1", "2026-01-02", 8)]))
    assert untouched == {f: os.path.getmtime(f) for f in glob.glob(f"{path}/event_date=2026-01-0[3-9]/*.parquet")}
    assert not [n for n in os.listdir(path) if n.startswith("_merge")]


def test_checked_write_counts_twice(spark, tmp_path):
    from riskloom.sinks.tables import verify_write, write_checked

    path = str(tmp_path / "t")
    rows = _table(spark, None, [(f"t{i}", f"2026-01-{1 + i % 3:02d}", i) for i in range(30)])
    assert write_checked(rows, path) == 30
    assert write_checked(rows.where("event_date = date'2026-01-02' and amount > 10"), path, "2026-01-02") == 6
    assert verify_write(spark, path, 26) == 26
    delete_folder(spark, f"{path}/event_date=2026-01-03")
    with pytest.raises(RuntimeError, match="expected 26 rows, found 16"):
        verify_write(spark, path, 26)
    assert write_checked(rows.limit(0), str(tmp_path / "empty")) == 0
