"""Session settings and the shared working folder.

Every timestamp in the library is an instant read and shown in UTC, so the
session time zone is part of the contract, not a preference.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.files import folder_bytes

# Settings every job relies on.  Adaptive execution is what keeps the plans safe
# under skew: it splits hot join and rebalance partitions, merges tiny ones and
# turns a join into a broadcast only after it has measured the side at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Shuffles start with a partition for so many bytes of the given tables, and adaptive execution merges them up to
# the second size, so what a task holds does not grow with the tables. What the session states itself stands.
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTITION_BYTES, MERGED_BYTES = 4 << 20, str(16 << 20)
_set: dict[str, str] = {}


def fit_partitions(spark: SparkSession, folder: str) -> None:
    """Let the number of shuffle partitions follow the size of the tables in a folder."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = {PARTITIONS: str(max(least, folder_bytes(spark, folder) // PARTITION_BYTES)), MERGED: MERGED_BYTES}
    for name, value in wanted.items():
        if spark.conf.get(name, None) in (None, _set.get(name)):
            spark.conf.set(name, value)
            _set[name] = value


def release_partitions(spark: SparkSession) -> None:
    """Take back what `fit_partitions` set."""
    for name, value in _set.items():
        if spark.conf.get(name, None) == value:
            spark.conf.unset(name)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_with_the_run(spark: SparkSession):
    """Spark removes the shuffle files of a run when it is done; else they stay until the driver collects garbage.

    Only for frames that are made and run inside: one that runs again would look for its files in vain.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


# Rows of more stored bytes than this are shuffled in parts, one after another, so that only one part is on disk at once.
# Where all rows are read again for every part, parts are larger by the second figure.
PART_BYTES, READ_AGAIN = 512 << 20, 4


def parts_for(size: int) -> int:
    return 1 + size // PART_BYTES


def in_part(columns: list[str | Column], part: int, parts: int) -> Column:
    """Rows of one part; equal values of the columns are in the same one, null like any other."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)) == part


def scanned_bytes(rows: DataFrame) -> int:
    """Estimated bytes of rows that are only read from files, narrowed, filtered and put together; 0 for any other plan."""
    found = rows._jdf.queryExecution().optimizedPlan()
    waiting = [found]
    while waiting:
        node = waiting.pop()
        if node.getClass().getSimpleName() not in ("LogicalRelation", "Project", "Filter", "Union"):
            return 0
        waiting += [node.children().apply(i) for i in range(node.children().size())]
    return int(str(found.stats().sizeInBytes()))


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local-mode session without that setting (tests) gets a temporary
    folder; a cluster session without it is refused, because files on one
    machine would be lost with that machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="riskloom-")
    return _local_root


_local_root: str | None = None


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder path below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Write the rows once to reliable storage and cut the lineage there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
