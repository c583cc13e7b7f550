"""Counters of a stream while it runs.

The counts are metrics that the engine observes on the rows of a micro-batch and reports with the progress of
that batch, so reading them costs no job.  They go on after a restart: what earlier runs stored is counted once
at the start, and a batch that is replayed, because its run ended before the commit, replaces its own numbers.
"""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from riskloom.schemas import STRICT_EVENT, STRICT_REQUIRED
from riskloom.sources.files import exists
from riskloom.sources.results import read_batch_metrics
from riskloom.streaming import strict

BASIC = ("input_count", "invalid_count", "schema_drift_count")
STRICT = (strict.VALID_METRIC, strict.INVALID_METRIC, strict.SINK_FAILURE_METRIC)


def measures(rows: DataFrame, profile: str) -> list[Column]:
    """What is counted in a batch, on the rows that enter its fan-out."""
    if profile == "basic":
        found = (F.count(F.lit(1)), F.count_if(~F.col("is_valid")), F.count_if(F.col("unexpected_field_count") > 0))
        return [column.alias(name) for name, column in zip(BASIC, found)]
    kept = T.StructType([f for f in STRICT_EVENT if f.name in rows.columns])
    fits = strict.conforms(rows, kept, [n for n in STRICT_REQUIRED["events"] if n in rows.columns])
    good = strict.is_valid()
    found = (F.count_if(good), F.count_if(~good), F.count_if(good & ~fits))
    return [column.alias(name) for name, column in zip(STRICT, found)]


def stored_counts(spark: SparkSession, root: str, profile: str) -> DataFrame:
    """batch_id and the counts of every batch whose outputs are stored."""
    if profile == "basic":
        return read_batch_metrics(spark, f"{root}/metrics").select("batch_id", *BASIC)
    path = f"{root}/observations"
    if not exists(spark, path):
        return spark.createDataFrame([], "batch_id long, " + ", ".join(f"{name} long" for name in STRICT))
    value = lambda name: F.coalesce(F.sum(F.when(F.col("metric_name") == name, F.col("metric_value"))), F.lit(0)).cast("long")
    return spark.read.parquet(path).groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        *[value(name).alias(name) for name in STRICT])


class LiveCounters(StreamingQueryListener):
    """Totals of one stream; pass it to `start_stream`."""

    def __init__(self, spark: SparkSession, root: str, profile: str = "basic"):
        super().__init__()
        self.spark, self.root, self.profile = spark, root, profile
        self.name = f"live counters of {profile} {root}"
        self._lock, self._ended = threading.Lock(), threading.Event()
        # Only the newest batch can be replayed, so the others are one sum.
        self._done: Counter = Counter()
        self._batch, self._counts = -1, Counter()
        stored = stored_counts(spark, root, profile)
        newest = stored.agg(F.max("batch_id")).first()[0]
        if newest is not None:
            names = [c for c in stored.columns if c != "batch_id"]
            sums = stored.groupBy((F.col("batch_id") == newest).alias("last")).agg(*[F.sum(n).alias(n) for n in names]).collect()
            for row in sums:
                (self._counts if row["last"] else self._done).update({n: row[n] for n in names})
            self._batch = newest

    def on_rows(self, rows: DataFrame) -> DataFrame:
        """The stream with its counts observed."""
        return rows.observe(self.name, *measures(rows, self.profile))

    def totals(self) -> dict[str, int]:
        names = BASIC if self.profile == "basic" else STRICT
        with self._lock:
            return {name: self._done[name] + self._counts[name] for name in names}

    def take(self, batch_id: int, counts: dict[str, int]) -> None:
        with self._lock:
            if batch_id > self._batch:
                self._done.update(self._counts)
                self._batch, self._counts = batch_id, Counter(counts)
            elif batch_id == self._batch:
                self._counts = Counter(counts)

    def wait(self, seconds: float = 30.0) -> None:
        """Until the engine has reported the end of the run, hence all progress before it."""
        self._ended.wait(seconds)

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and event.progress.numInputRows > 0:
            self.take(event.progress.batchId, seen.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()
