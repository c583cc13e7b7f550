from datetime import date

import pytest

from riskloom.generate.transactions import generate_transactions
from riskloom.plans.full_run import BatchConfig, run_full
from riskloom.plans.incremental import late_data_scenario, run_incremental
from riskloom.quality.rules import ContractError
from riskloom.sources.transactions import read_raw


def _copied(spark, root):
    spark.read.parquet(f"{root}/processed").write.partitionBy("event_date").parquet(f"{root}/processed-copy")
    return True


def test_full_batch_and_late_data(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "root")
    rows = generate_transactions(spark, 1500, 11, date(2026, 6, 8), 4)
    text = rows.withColumn("is_fraud", rows["is_fraud"].cast("string"))
    text = text.replace({"true": "True", "false": "False"}, subset=["is_fraud"])
    text.write.csv(raw, header=True)
    config = BatchConfig(f"{raw}/*.csv", root)
    first = run_full(spark, config)
    assert first["clean_count"] == 1500 and first["daily_transaction_summary"] == 4
    assert spark.read.parquet(f"{root}/models/mart_daily_risk_kpis").count() == 4
    again = run_incremental(spark, read_raw(spark, f"{raw}/*.csv", with_file=True), f"{root}/processed", f"{root}/processed-copy",
                            "2026-06-09", marts_root=str(tmp_path / "marts")) if _copied(spark, root) else {}
    assert again["models"] == first["models"] and again["customer_risk_features"] == first["customer_risk_features"]
    evidence = late_data_scenario(
        spark, read_raw(spark, f"{raw}/*.csv", with_file=True), f"{root}/processed", str(tmp_path / "late"), "2026-06-09"
    )
    assert evidence["verification"] == "PASSED"


def test_full_batch_refuses_a_foreign_header(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = generate_transactions(spark, 20, 11, date(2026, 6, 8), 1)
    rows.withColumnRenamed("device_id", "device").write.csv(raw, header=True)
    with pytest.raises(ContractError, match="header"):
        run_full(spark, BatchConfig(f"{raw}/*.csv", str(tmp_path / "root")))
