"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.entrypoints.registry import Query
from riskloom.llm import (
    byte_bpe,
    html_blocks,
    jaccard_join,
    license_scan,
    line_dedup,
    maxscore,
    pair_bounds,
    source_mix,
    syncmers,
    toxicity,
    url_rules,
    vptree,
    zone_negatives,
)
from riskloom.llm.common import table
from riskloom.session import prepare, release_partitions

QUERIES: dict[str, Query] = {}


# Texts are long: batches sent to Python are cut by rows and bytes well before memory.
BATCH_ROWS, BATCH_BYTES = "500", "48m"


def ready(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    release_partitions(spark)
    return prepare(spark)


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = Query(lambda spark, sf_dir: run(ready(spark), sf_dir.rstrip("/")), sql)
        return run
    return register


@query("op2_line_dedup", r"""
WITH lines AS (
  SELECT rowid AS r, doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row_number() OVER () AS rowid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), hot AS (
  SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(hot.k) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN hot.k IS NULL THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM lines LEFT JOIN hot USING (k) GROUP BY r, doc_id
""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_source_mix", r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS draw FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS n,
         (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS w FROM sized GROUP BY source
), levels AS (
  SELECT *, 3 * n / w AS ratio,
         ((SELECT sum(n) FROM sources) - coalesce(sum(3 * n) OVER o, 0))::DOUBLE
           / ((SELECT sum(w) FROM sources) - coalesce(sum(w) OVER o, 0)) AS level
  FROM sources WINDOW o AS (ORDER BY 3 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stop AS (
  SELECT level FROM levels WHERE 3 * n >= w * level ORDER BY ratio, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, n, least((3 * n)::DOUBLE, w * (SELECT level FROM stop)) AS target FROM levels
), quotas AS (
  SELECT *, floor(target + 0.5)::BIGINT AS quota FROM targets
), sums AS (
  SELECT s.*, q.n, q.target, q.quota, CASE WHEN q.n > 0 THEN q.quota // q.n ELSE 0 END AS uses,
         CASE WHEN q.n > 0 THEN q.quota % q.n ELSE 0 END AS rest,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, n AS source_size, target,
       (CASE WHEN size > 0 THEN size * (uses + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END)
             ELSE 0 END)::BIGINT AS taken
FROM sums
""")
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    uses, plan = source_mix.mix(docs)
    sizes = {p[0]: n for p, n in plan.pattern_sizes.items()}
    sources = spark.createDataFrame([(s, sizes[s], t) for s, t in plan.targets.items()],
                                    "name string, source_size long, target double")
    return uses.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", F.col("mix_size").alias("size"), "source_size", "target",
        (F.col("mix_size") * F.col("mix_uses")).alias("taken"))


@query("op3_vp_tree_search")
def op3_vp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = vptree.VpIndex.build(vectors)
    return index.search(vectors.filter(F.col("vec_id") % 50 == 0), k=5, relax=1.0)


@query("op4_html_blocks")
def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_blocks.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = vocabulary(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def vocabulary(spark: SparkSession) -> byte_bpe.ByteBpe:
    import public_tokenizers

    return byte_bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op10_url_rules")
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_rules.HostRule("block", "net/"), url_rules.HostRule("allow", "example.net/en/"),
             url_rules.HostRule("block", "example.com/de/"), url_rules.HostRule("allow", "org/fr/")]
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow").alias("verdict"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules, labels)


def held_out() -> Column:
    """Every third document by a checksum of its id: never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out())
    return toxicity.ToxicityModel.fit(docs, labels)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_model(spark, docs, sf_dir).score(docs, threshold=0.7).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", "toxic_terms")


@query("op5_closed_syncmers")
def op5_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return syncmers.compare_edited(docs).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op8_jaccard_join", r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 5 THEN array_to_string(ws[i:i + 4], ' ') ELSE array_to_string(ws, ' ') END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM texts WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) ON x = d.doc_id
""")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), license_scan.all_templates())


@query("op11_maxscore", """
WITH whole AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), asked AS (
  SELECT vec_id AS query_id, min(v) AS q FROM whole WHERE vec_id % 50 = 0 GROUP BY vec_id
), scored AS (
  SELECT query_id, vec_id, list_inner_product(q, v)::BIGINT AS score FROM asked JOIN whole ON vec_id <> query_id AND len(q) = len(v)
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
FROM scored WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5
""")
def op11_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return maxscore.MaxScoreIndex.build(vectors).search(vectors.filter(F.col("vec_id") % 50 == 0), k=5)


@query("op12_pair_bounds", r"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), sizes AS (
  SELECT d, doc_id, len(ws)::BIGINT AS n FROM words WHERE len(ws) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes
), freq AS (
  SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(ws) AS term FROM words) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM freq, corpus GROUP BY term, docs
), items AS (
  SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS r FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, d, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN freq USING (term) JOIN weights USING (term) JOIN sizes USING (d), corpus GROUP BY item_id, doc_id, d
)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER best <= 20
""")
def op12_pair_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pair_bounds.rank_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), k=20)


@query("op13_zone_negatives", """
WITH whole AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), anchors AS (
  SELECT id AS anchor_id, unnest(min({'label': label, 'n': len(v), 'q': v})) FROM whole WHERE id % 100 = 0 GROUP BY id
), scored AS (
  SELECT anchor_id, id, whole.label = anchors.label AS same, list_inner_product(q, v)::BIGINT AS score
  FROM anchors JOIN whole ON id <> anchor_id AND n = len(v)
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score, row_number() OVER best AS win FROM scored WHERE same
  WINDOW best AS (PARTITION BY anchor_id ORDER BY score DESC, id) QUALIFY row_number() OVER best <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, win ORDER BY score DESC, id) QUALIFY row_number() OVER best <= 10
""")
def op13_zone_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return zone_negatives.mine(vectors, F.col("id") % 100 == 0, label=moved)
