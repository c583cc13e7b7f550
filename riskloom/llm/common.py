"""What several training-data operators share: word and line definitions, stored intermediates."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import SHUFFLE_CLEANUP as SHUFFLE_CLEANUP
from riskloom.session import shuffles_end_with_the_run, work_folder
from riskloom.sources.files import delete_folder

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; a missing one counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of words; empty for an empty text."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write rows once to the shared folder and read them back: cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = work_folder(spark, label)
    with shuffles_end_with_the_run(spark):
        frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    _folders[out] = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove the files of frames that `stored` returned and nothing reads any more."""
    for frame in frames:
        delete_folder(frame.sparkSession, _folders.pop(frame))


_model: dict[Hashable, object] = {}


def worker_model(key: Hashable, make: Callable[[], object]):
    """The model that a Python worker keeps from task to task: one at a time, as workers serve one operator after another."""
    if key not in _model:
        _model.clear()
        _model[key] = make()
    return _model[key]


def release_model() -> None:
    """Let go of the model an earlier operator left in this worker."""
    _model.clear()
