"""From raw documents to token ids: five stages, each stored and read again by the next.

Stage by stage: toxic documents go; lines found in many documents go; one document of each group of near
copies stays; the sources are mixed to target weights, a document used twice being two rows; what is left
is encoded to token ids and decoded again.  Every stage but the last returns the columns of `documents`.

A missing text counts as empty and is kept unless a stage decides otherwise: it is never toxic, it has one
empty line, it is linked with nothing, but it holds no words, so no mix takes it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import jaccard_join, line_dedup, source_mix
from riskloom.llm.common import stored, table
from riskloom.llm.queries import ready, toxicity_model, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of `documents`; n_chars follows the text."""
    return rows.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text is judged toxic go."""
    docs = docs.select(*COLUMNS)
    return toxicity_model(ready(spark), docs, sf_dir).score(docs).filter("predicted = 0").select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least ten documents go, the documents stay."""
    ready(spark)
    return _documents(line_dedup.dedup_lines(docs.select(*COLUMNS), min_docs=10, min_chars=1))


def _numbered(docs: DataFrame) -> DataFrame:
    """`docs` with a number of its own for every row, the same at every reading: a hash of the file and the place in it."""
    try:
        return docs.select(*COLUMNS, F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row"))
    except AnalysisException:      # rows that are not read from files are stored with numbers
        return stored(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: that with the smallest id, a missing one being the last.

    Rows are linked by a number of their own, so of rows that repeat an id, or lack one, one stays, too; only
    documents without words are linked with nothing and all stay.
    """
    ready(spark)
    numbered = _numbered(docs)
    linked = jaccard_join.link_documents(numbered, doc_id="row").join(numbered.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "row"))
    kept = linked.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return numbered.join(kept, "row", "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a document is there as often as it is used."""
    ready(spark)
    return source_mix.mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (packed little-endian unsigned 32-bit), and whether they decode to its text."""
    bpe = vocabulary(ready(spark))
    rows = bpe.round_trip(docs.select(*COLUMNS))
    return rows.select("doc_id", "lang", "source", "n_chars", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup_stage),
    ("near_copies", near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

# Toxicity, the mix's flow and byte-level BPE have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
