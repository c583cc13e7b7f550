"""Headline timings: prints one JSON line.

Queries run at $BENCH_SF_DIR on local[$BENCH_CPUS] and are executed in full (every row is
produced and dropped). The two `etl_` entries time the published workload: CSV with 31
dates to a cleaned, deduplicated, date-partitioned table, including read-back; making
their input is not timed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import date

from riskloom.entrypoints import QUERIES
from riskloom.generate.transactions import generate_transactions
from riskloom.plans.etl import process
from riskloom.session import build_session
from riskloom.sources.transactions import read_raw

HEADLINE = [
    "p1_transform", "d3_dedup_latest", "a1_daily_summary", "a2_segment_summary", "a3_customer_features",
    "a4_merchant_features", "p10_high_risk", "a5_dim_customer", "a7_dim_date", "w1_customer_ranking",
    "w3_segment_ranking", "w4_daily_kpis", "q1_raw_contract", "q2_processed_contract", "m1_merge_upsert",
    "f5_basic_validity", "f8_strict_errors", "a9_realtime_trends", "a10_event_quality",
]
ETL_ROWS = {"etl_100350_rows": 100_350, "etl_1m_rows": 1_000_000}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times: dict[str, float] = {}

    with tempfile.TemporaryDirectory(prefix="riskloom-bench-") as folder:
        for name, rows in ETL_ROWS.items():
            raw = f"{folder}/{name}/raw"
            generated = generate_transactions(spark, rows, 202611, date(2026, 6, 8), 31, int(cpus))
            generated.write.csv(raw, header=True)
            started = time.monotonic()
            metrics = process(read_raw(spark, raw, with_file=True), f"{folder}/{name}/out")
            times[name] = round(time.monotonic() - started, 3)
            assert metrics["clean_count"] == rows, metrics

    for name in HEADLINE:
        started = time.monotonic()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - started, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
