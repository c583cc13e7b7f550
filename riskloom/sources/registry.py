"""Named sources and models: views for staging, written tables for core and marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import work_folder

Model = Callable[["Catalog"], DataFrame]


class Catalog:
    """Resolves names to tables; a model is built the first time it is asked for.

    A model registered as a `table` is written once and read back, so later models
    start from stored files instead of repeating its plan. A `view` stays a plan.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or work_folder(spark, "models")
        self._sources: dict[str, DataFrame] = {}
        self._models: dict[str, tuple[Model, str, str | None]] = {}
        self._built: dict[str, DataFrame] = {}

    def add_source(self, name: str, frame: DataFrame) -> None:
        self._sources[name] = frame

    def add_model(self, name: str, build: Model, kind: str = "table", partition_by: str | None = None) -> None:
        if kind not in ("view", "table"):
            raise ValueError(f"unknown model kind {kind!r}")
        self._models[name] = (build, kind, partition_by)

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            raise KeyError(f"unknown source {name!r}")
        return self._sources[name]

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._models:
                raise KeyError(f"unknown model {name!r}")
            build, kind, partition_by = self._models[name]
            frame = build(self)
            if kind == "table":
                frame = self._store(name, frame, partition_by)
            frame.createOrReplaceTempView(name)
            self._built[name] = frame
        return self._built[name]

    def build_all(self) -> dict[str, DataFrame]:
        return {name: self.ref(name) for name in self._models}

    def model_names(self) -> list[str]:
        return list(self._models)

    def _store(self, name: str, frame: DataFrame, partition_by: str | None) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = frame.write.mode("overwrite")
        if partition_by:
            writer = frame.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by)
        writer.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
