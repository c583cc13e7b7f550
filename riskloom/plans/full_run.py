"""The whole batch in one session: contract, processed table, features, models, checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.risk import HIGH_VALUE
from riskloom.operators.compare import union_all
from riskloom.operators.merge import build_fct
from riskloom.plans import features, models
from riskloom.plans.etl import process
from riskloom.quality import rulesets
from riskloom.quality.rules import require_all, require_none
from riskloom.schemas import RAW_TRANSACTION
from riskloom.sinks.tables import write_counted, write_feature
from riskloom.sources.registry import Catalog
from riskloom.sources.transactions import csv_header, read_processed, read_raw, read_raw_text


@dataclass(frozen=True)
class BatchConfig:
    raw: str
    root: str
    threshold: float = HIGH_VALUE
    full_refresh: bool = False


def build_features(spark: SparkSession, processed: DataFrame, root: str, threshold: float) -> dict[str, int]:
    """Write the five feature tables; returns their row counts."""
    counts = {
        name: write_feature(features.add_generated_at(table.build(processed, threshold)), f"{root}/{name}")
        for name, table in features.FEATURE_TABLES.items()
    }
    rows = features.add_generated_at(features.high_risk(processed, threshold))
    counts["high_risk_transactions"] = write_counted(rows, f"{root}/high_risk_transactions")
    return counts


def build_catalog(
    spark: SparkSession, root: str, threshold: float, full_refresh: bool = False, processed_root: str | None = None,
) -> Catalog:
    """Staging views, fact, dimensions and marts over the stored tables."""
    catalog = Catalog(spark, f"{root}/models")
    names = [*features.FEATURE_TABLES, "high_risk_transactions"]
    catalog.add_source("processed_transactions", read_processed(spark, processed_root or f"{root}/processed"))
    for name in names:
        catalog.add_source(name, spark.read.parquet(f"{root}/features/{name}"))
    for name in ["processed_transactions", *names]:
        catalog.add_model(f"stg_{name}", lambda c, n=name: models.staging(n, c.source(n)), "view")

    def fct(c: Catalog) -> DataFrame:
        path = f"{root}/fct_transactions"
        build_fct(spark, path, models.fct_select(c.ref("stg_processed_transactions")), full_refresh)
        return models.fct_select(read_processed(spark, path))

    catalog.add_model("fct_transactions", fct, "view")  # stored by its own merge
    catalog.add_model("dim_customer", lambda c: models.dim_customer(c.ref("fct_transactions")))
    catalog.add_model("dim_merchant", lambda c: models.dim_merchant(c.ref("fct_transactions")))
    catalog.add_model("dim_date", lambda c: models.dim_date(c.ref("fct_transactions")))
    catalog.add_model("mart_customer_risk_ranking", lambda c: models.customer_ranking(c.ref("stg_customer_risk_features")))
    catalog.add_model("mart_merchant_risk_ranking", lambda c: models.merchant_ranking(c.ref("stg_merchant_risk_features")))
    catalog.add_model("mart_segment_risk_analysis", lambda c: models.segment_ranking(c.ref("stg_segment_risk_summary")))
    catalog.add_model("mart_daily_risk_kpis", lambda c: models.daily_kpis(c.ref("stg_daily_transaction_summary")))
    catalog.add_model(
        "mart_high_risk_daily_trends",
        lambda c: models.high_risk_daily_trends(c.ref("stg_high_risk_transactions"), threshold),
    )
    return catalog


def model_results(catalog: Catalog) -> DataFrame:
    """All declared checks of the built models as one result table."""
    tables = {name: catalog.ref(name) for name in rulesets.MODEL_RULES}
    fct = tables["fct_transactions"]
    parents = {"event_date": "dim_date", "customer_id": "dim_customer", "merchant_id": "dim_merchant"}
    return union_all(
        rulesets.model_checks(tables, {name: rules() for name, rules in rulesets.MODEL_RULES.items()}),
        *[rulesets.relationship(fct, tables[dim], key, "fct_transactions") for key, dim in parents.items()],
    )


def check_processed(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """The processed table, once its schema, rows, dates and folders are as they should be."""
    require_none("processed_transactions", "schema", rulesets.schema_problems(spark.read.parquet(path).schema))
    processed = read_processed(spark, path)
    require_all(rulesets.processed_contract(processed, rows=rows))
    dates = rulesets.date_bounds(processed).first()["event_date_count"]
    require_all(rulesets.inventory_contract(spark, path, partitions=dates))
    if not rulesets.partition_mismatch(spark, path, processed).isEmpty():
        raise RuntimeError("folders and rows of the processed table name different dates")
    return processed


def run_full(spark: SparkSession, config: BatchConfig) -> dict:
    """Run everything in order; a failed contract stops the later steps."""
    require_none("raw_transactions", "header",
                 rulesets.header_problems(csv_header(spark, config.raw), RAW_TRANSACTION.fieldNames()))
    text = read_raw_text(spark, config.raw)
    require_all(rulesets.raw_contract(text, rulesets.conformity_table(spark)))
    metrics = process(read_raw(spark, config.raw, with_file=True), f"{config.root}/processed")
    processed = check_processed(spark, f"{config.root}/processed", metrics["clean_count"])
    counts = build_features(spark, processed, f"{config.root}/features", config.threshold)
    for name in features.FEATURE_TABLES:
        require_all(rulesets.inventory_contract(spark, f"{config.root}/features/{name}", flat=True))

    tables = {"processed_transactions": processed}
    tables |= {name: spark.read.parquet(f"{config.root}/features/{name}") for name in counts}
    expect = {
        "daily_transaction_summary": {"transactions": metrics["clean_count"]},
        "segment_risk_summary": {"transactions": metrics["clean_count"]},
    }
    require_all(rulesets.warehouse_contract(tables, expect, config.threshold))
    return {**metrics, **counts, "models": build_models(spark, config.root, config.threshold, config.full_refresh)}


def build_models(spark: SparkSession, root: str, threshold: float, full_refresh: bool = False) -> list[str]:
    """Build all models, store the results of their checks, and raise for a failed one."""
    catalog = build_catalog(spark, root, threshold, full_refresh)
    catalog.build_all()
    results = model_results(catalog)
    results.write.mode("overwrite").json(f"{root}/check-results")
    require_all(spark.read.schema(results.schema).json(f"{root}/check-results"))
    return catalog.model_names()
