"""Document fingerprints from closed syncmers, by DataFrame functions only.

A text is a string of words; a k-mer of words is chosen if the smallest of its inner s-mers (by hash, the
leftmost of equal ones) stands at its left or right edge.  The choice depends on the k-mer alone, so the
same passage gives the same anchors wherever it stands, and a text's anchors are those of its parts but for
the k - 1 places around each border.  A fingerprint is a digest of all anchors with their positions, followed by the
ascending list of the SKETCH smallest distinct anchor hashes; likeness is the Jaccard similarity of all distinct
anchors of both texts.

Words, not characters, are the letters of the k-mers: that is a sixth of the places, all of them array elements.

Defined results: a missing or empty text and one without words has the empty fingerprint, and two of them
are alike (1.0); a text of fewer than K words is a single anchor; equal texts have equal fingerprints; the next document is the
next row by (doc_id, text), after the last the first, a single row is its own next; a missing doc_id comes
first; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import whole_text, words

K, S = 3, 1               # words in a k-mer and in an s-mer
INNER = K - S + 1         # s-mers in a k-mer; 2 of INNER k-mers are chosen on average
SKETCH = 64               # hashes that a fingerprint lists beside its digest
HEX = 8                   # hex digits of a hash in the fingerprint
BUCKET_ROWS = 2_000       # documents that share a window in small tables
MAX_BUCKETS = 4_096       # ranges of doc_id; larger tables have more rows in each


def _hash(*parts: Column) -> Column:
    """Non-negative 32-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 32)


def _places(array: Column, width: int) -> Column:
    return F.when(F.size(array) >= width, F.sequence(F.lit(0), F.size(array) - width)).otherwise(F.array().cast("array<int>"))


def _runs(hashes: Column, width: int) -> Column:
    """Hash of each run of `width` elements."""
    return F.transform(_places(hashes, width), lambda i: _hash(*[F.get(hashes, i + j) for j in range(width)]))


def _with_hashes(frame: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`: hashes of the words of a text."""
    return frame.withColumn(out, F.transform(words(F.col(text)), lambda w: _hash(w)))


def _chosen(h: Column) -> Column:
    """Start places of the closed syncmers, given the hashes of the words."""
    inner = h if S == 1 else _runs(h, S)

    def closed(i: Column) -> Column:
        # Smallest at the left edge, or smaller at the right edge than everything before it.
        mers = [F.get(inner, i + j) for j in range(INNER)]
        return (mers[0] <= F.least(*mers[1:])) | (mers[-1] < F.least(*mers[:-1]))

    return F.filter(_places(h, K), closed)


def _anchor_places(h: Column) -> Column:
    few = F.when(F.size(h) > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return F.when(F.size(h) < K, few).otherwise(_chosen(h))


def _anchor_hashes(h: Column, places: Column) -> Column:
    whole = F.transform(places, lambda _: F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: _hash(a, x)))
    return F.when(F.size(h) < K, whole).otherwise(
        F.transform(places, lambda i: _hash(*[F.get(h, i + j) for j in range(K)])))


def anchors(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per anchor for positional matching: doc_id, position (words from 0), anchor (hash)."""
    frame = _with_hashes(docs.select(doc_id, whole_text(text).alias("__t")), "__t", "__h")
    frame = frame.withColumn("position", _anchor_places(F.col("__h")))
    frame = frame.withColumn("anchor", _anchor_hashes(F.col("__h"), F.col("position")))
    return frame.select(doc_id, F.inline(F.arrays_zip("position", "anchor")))


def _text_of(anchors: Column, digest: Column) -> Column:
    """Fingerprint: 32 hex digits of the digest, HEX for each of the smallest hashes; empty without anchors."""
    hexed = lambda x, width: F.lower(F.lpad(F.hex(x), width, "0"))
    smallest = F.array_join(F.transform(F.slice(F.array_sort(anchors), 1, SKETCH), lambda x: hexed(x, HEX)), "")
    return F.when(F.size(anchors) == 0, F.lit("")).otherwise(
        F.concat(hexed(digest["a"], 16), hexed(digest["b"], 16), smallest))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def distinct_anchors(docs: DataFrame, *, text: str = "text", out: str = "anchors", digest: str | None = None) -> DataFrame:
    """Adds the distinct anchor hashes of the whole text, and if asked for the digest of all anchors with their positions."""
    frame = _with_hashes(docs.withColumn("__t", whole_text(text)), "__t", "__h")
    frame = frame.withColumn("__at", _anchor_places(F.col("__h")))
    frame = frame.withColumn("__all", _anchor_hashes(F.col("__h"), F.col("__at")))
    if digest:
        halves = [F.xxhash64(F.lit(half), "__at", "__all").alias("ab"[half]) for half in (0, 1)]
        frame = frame.withColumn(digest, F.struct(*halves))
    return frame.withColumn(out, F.array_distinct("__all")).drop("__t", "__h", "__at", "__all")


def _buckets(docs: DataFrame, doc_id: str) -> tuple[Column, int]:
    """Bucket of a row by doc_id ranges of equal numbers of rows; only the range bounds reach the driver."""
    rows = docs.count()
    parts = min(MAX_BUCKETS, max(1, rows // BUCKET_ROWS))
    cuts = docs.select(F.percentile_approx(doc_id, [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else None
    bounds = sorted(set(cuts or []))
    coarse = bounds[::64]
    if not bounds:
        return F.lit(0), 1
    # Two steps of at most 64 and len/64 comparisons instead of one for every bound.
    step = F.greatest(F.size(F.filter(F.lit(coarse), lambda b: b <= F.col(doc_id))) - 1, F.lit(0))
    fine = F.size(F.filter(F.slice(F.lit(bounds), step * 64 + 1, 64), lambda b: b <= F.col(doc_id)))
    return F.when(F.col(doc_id).isNull(), 0).otherwise(step * 64 + fine), len(bounds) + 1


def with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): the next document by ascending doc_id, after the last the first.

    Rows are ordered inside ranges of doc_id; the first row of each range is also placed at the end of the
    range before it, so no window spans the whole table.
    """
    rows = docs.select(F.col(doc_id).alias("id"), whole_text(text).alias("t"))
    bucket, parts = _buckets(rows, "id")
    rows = rows.withColumn("bucket", bucket)
    # One row per range; the number of ranges is far below that of documents.
    key = F.struct(F.col("id").isNotNull(), "id", "t")
    first = rows.groupBy("bucket").agg(F.min(key).alias("k")).select("bucket", F.col("k.id").alias("id"), F.col("k.t").alias("t"))
    held = [r.bucket for r in first.select("bucket").orderBy("bucket").collect()]
    before = {b: held[i - 1] for i, b in enumerate(held)}
    if before:
        owner = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
        guests = first.withColumn("bucket", owner[F.col("bucket")])
        rows = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    else:
        rows = rows.withColumn("guest", F.lit(False))
    order = W.partitionBy("bucket").orderBy("guest", F.asc_nulls_first("id"), "t")
    return (rows.withColumn("next_text", F.lead("t").over(order)).filter(~F.col("guest"))
            .select(F.col("id").alias(doc_id), F.col("t").alias(text), "next_text"))


def edited(rows: DataFrame, *, text: str = "text", share: int = 4) -> DataFrame:
    """Adds `edited`: the last floor(n / share) characters replaced by the first as many (or all) of `next_text`."""
    n = F.char_length(text)
    cut = F.floor(n / share).cast("int")
    return rows.withColumn("edited", F.concat(F.substring(F.col(text), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut)))


def compare_edited(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its text, edited text, both fingerprints, and the likeness to the edited and to the next text.

    Anchors are worked out per row after the window, which carries texts only.
    """
    rows = edited(with_next(docs, doc_id=doc_id, text=text), text=text)
    rows = distinct_anchors(rows, text=text, digest="digest")
    rows = distinct_anchors(rows, text="edited", out="edited_anchors", digest="edited_digest")
    rows = distinct_anchors(rows, text="next_text", out="next_anchors")
    return rows.withColumns({
        "fingerprint": _text_of(F.col("anchors"), F.col("digest")),
        "edited_fingerprint": _text_of(F.col("edited_anchors"), F.col("edited_digest")),
        "near_edited": likeness(F.col("anchors"), F.col("edited_anchors")),
        "near_next": likeness(F.col("anchors"), F.col("next_anchors"))})
