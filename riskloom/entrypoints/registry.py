"""Registered queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.entrypoints.oracle import compose
from riskloom.session import fit_partitions, prepare

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; `sql` may use the shared common table expressions by name."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            folder = sf_dir.rstrip("/")
            fit_partitions(prepare(spark), folder)
            return run(spark, folder)

        QUERIES[name] = Query(prepared, compose(sql) if sql else None)
        return run

    return register
