import pytest
from pyspark.sql import functions as F


@pytest.fixture
def clash(spark):
    """Adds columns whose names the operators use for results or inside."""
    def add(frame):
        extra = ["id", "node", "n", "t", "size", "start", "last", "edge", "score", "host", "path", "rule", "verdict", "tokens", "ids",
                 "digest", "bucket", "sketch", "value", "label"]
        return frame.withColumns({c: F.lit("x") for c in extra if c not in frame.columns})
    return add


@pytest.fixture
def docs(spark):
    def make(texts, start=0):
        return spark.createDataFrame([(start + i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)],
                                     "doc_id long, text string, lang string, source string, n_chars long")
    return make
