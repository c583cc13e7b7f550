"""Ranked lexical search by MaxScore with bounds on pairs of terms.

The documents are read once: chunks of them become posting lists (document, occurrences) of the terms that the
items use, and the corpus counts follow from the stored chunks.  Each chunk then gets its impacts and, for every
two terms that stand next to each other in an item's order of weights, the list of documents that hold both,
with the largest joint impact in it.  Rare terms seldom reach their largest impacts together, so a pair's joint
bound is below the sum of the two single ones.

A search keeps an item's k best documents while it goes through the chunks.  The item's terms stand in ascending
order of weight times repeats; the bound of the first i terms is the least that combining pair and single bounds
can give (along that order, by dynamic programming).  The terms whose combined bound stays below the k-th best
score are non-essential: postings of the others are traversed, and the documents found there are probed for the
non-essential terms, largest weights first, as long as score and bound together are competitive.  A chunk whose
whole bound is too small is skipped.  While fewer than k documents are known, those of the heaviest pair lists
are scored first: k of them that reach a score make it the one to beat.

Weights, impacts and scores are whole numbers: w = floor(1000 ln((2N+2) / (2df+1))), m = 75 + (25 n N) div L,
score = sum of w * ((10^9 tf) div (1000 tf + 12 m)) over an item's terms, repeats included.

Defined results: a missing text, and one without terms, counts nowhere and is never found; an item without terms,
or whose terms no document holds, has no rows; only scores above 0 are returned; every row is a document, rows
that repeat a doc_id are ranked each; ties go to the smaller doc_id, a missing one comes last; of several texts
of one item_id the smallest is asked; fewer documents than `k` give fewer rows; empty tables give no rows; extra
columns are not read.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER, UPPER, stored

CHUNK_DOCS = 4_096            # documents of a chunk at most
CHUNK_POSTINGS = 2_000_000    # postings after which a chunk ends, so that long documents fit
ITEM_CHARS = 2_000_000        # characters of the items that are asked together and sent to every task; an item counts 64 more
# Everything in ASCII but digits and letters parts terms; only A-Z are lower-cased.
_TERMS = bytes(ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


class Items:
    """The asked items: `vocabulary` numbers their terms, `repeats` are (term, repeats) by item."""

    def __init__(self, rows: list[tuple]):
        self.vocabulary: dict[bytes, int] = {}
        self.repeats: dict = {}
        for item, text in rows:
            counts = Counter(terms(text or ""))
            self.repeats[item] = [(self.vocabulary.setdefault(t, len(self.vocabulary)), n) for t, n in counts.items()]

    def order(self, weights: list[int]) -> dict:
        """Per item its terms with their repeats, ascending by weight; terms of weight 0 add nothing."""
        return {item: sorted(((t, n) for t, n in held if weights[t] > 0), key=lambda x: (weights[x[0]] * x[1], x[0]))
                for item, held in self.repeats.items()}


def neighbours(order: dict) -> list[tuple[int, int]]:
    """Pairs of terms next to each other in some item's order."""
    return sorted({tuple(sorted((a[0], b[0]))) for held in order.values() for a, b in zip(held, held[1:])})


CHUNK_SCHEMA = "docs long, terms long, term array<int>, df array<long>, chunk binary"


def _chunks(batches: Iterator[pd.DataFrame], vocabulary: dict[bytes, int], chunk_docs: int = CHUNK_DOCS) -> Iterator[pd.DataFrame]:
    """Posting lists of chunks of documents: ids and sizes by place, and (term, place, occurrences) by term."""
    ids, missing, sizes, held, places, counts, load = [], [], [], [], [], [], 0

    def closed() -> pd.DataFrame:
        term, place, tf = (np.concatenate([np.empty(0, np.int64), *x]) for x in (held, places, counts))
        by_term = np.argsort(term, kind="stable")
        term, place, tf = (x[by_term].astype(np.int32) for x in (term, place, tf))
        known, start = np.unique(term, return_index=True)
        chunk = pickle.dumps((np.array(ids, np.int64), np.array(missing, bool), np.array(sizes, np.int64), known, start, place, tf), 5)
        return pd.DataFrame({"docs": [len(ids)], "terms": [sum(sizes)], "term": [known],
                             "df": [np.diff(np.r_[start, len(term)]).astype(np.int64)], "chunk": [chunk]})

    for batch in batches:
        for doc, lacks, text in zip(batch.id, batch.lacks, batch.t):
            words = terms(text)
            if not words:
                continue
            found = Counter(map(vocabulary.get, words))
            found.pop(None, None)
            missing.append(lacks)
            held.append(np.fromiter(found.keys(), np.int64, len(found)))
            counts.append(np.fromiter(found.values(), np.int64, len(found)))
            places.append(np.full(len(found), len(ids), np.int64))
            ids.append(doc)
            sizes.append(len(words))
            load += len(found)
            if len(ids) >= chunk_docs or load >= CHUNK_POSTINGS:
                yield closed()
                ids, missing, sizes, held, places, counts, load = [], [], [], [], [], [], 0
    if ids:
        yield closed()


class PairIndex:
    """The chunk of a stored row with its weighted impacts, largest impacts, and pair lists."""

    def __init__(self, chunk: bytes, docs: int, size: int, weights: list[int], pairs: list[tuple[int, int]]):
        self.ids, self.missing, sizes, known, start, place, tf = pickle.loads(chunk)
        m = np.array([75 + 25 * n * docs // size for n in sizes.tolist()], np.int64)
        tf = tf.astype(np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[place])
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for term, a, b in zip(known.tolist(), start.tolist(), [*start[1:].tolist(), len(place)]):
            if weights[term] > 0:
                self.lists[term] = place[a:b], weights[term] * impact[a:b]
        self.top = {term: int(score.max()) for term, (_, score) in self.lists.items()}
        # Intersection lists: the documents that hold both terms, and the largest joint impact among them.
        self.joint: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
        scratch = np.full(len(self.ids), -1, np.int64)
        for a, b in pairs:
            if a in self.lists and b in self.lists:
                (pa, sa), (pb, sb) = self.lists[a], self.lists[b]
                if len(pa) > len(pb):
                    (pa, sa), (pb, sb) = (pb, sb), (pa, sa)
                scratch[pb] = sb
                other = scratch[pa]
                scratch[pb] = -1
                both = other >= 0
                self.joint[a, b] = pa[both], int((sa + other)[both].max(initial=0))
        self.traversed = 0      # postings read by searches, for tests

    def pair_bound(self, x: tuple[int, int], y: tuple[int, int]) -> int:
        """Most that two terms (with repeats) can add together in one document."""
        (a, ra), (b, rb) = x, y
        ta, tb = self.top.get(a, 0), self.top.get(b, 0)
        places, most = self.joint.get((min(a, b), max(a, b)), (None, None))
        if places is None:
            return ra * ta + rb * tb
        # In a document with both the common repeats are bounded together, the others singly.
        least = min(ra, rb)
        together = least * most + (ra - least) * ta + (rb - least) * tb if len(places) else 0
        return min(ra * ta + rb * tb, max(ra * ta, rb * tb, together))

    def bounds(self, held: list[tuple[int, int]]) -> list[int]:
        """bounds[i]: most that the first i terms can add together."""
        out = [0]
        for i, (term, n) in enumerate(held):
            most = out[-1] + n * self.top.get(term, 0)
            if i:
                most = min(most, out[-2] + self.pair_bound(held[i - 1], held[i]))
            out.append(most)
        return out

    def search(self, held: list[tuple[int, int]], k: int, best: tuple | None) -> tuple:
        """The k best so far (scores, missing, ids) with this chunk's documents added."""
        scores, missing, ids = best if best is not None else (np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
        held = [x for x in held if x[0] in self.lists]
        left = self.bounds(held)
        worst = int(scores[-1]) if len(scores) == k else 1
        if left[-1] < worst:
            return scores, missing, ids
        if len(scores) < k:
            worst = self._sure(held, k)
        first = int(np.searchsorted(left, worst, "left")) - 1     # so many terms are non-essential: left[first] < worst
        sums = np.zeros(len(self.ids), np.int64)
        for term, n in held[first:]:
            places, score = self.lists[term]
            sums[places] += n * score
            self.traversed += len(places)
        found = np.flatnonzero((sums > 0) & (sums + left[first] >= worst))
        part = sums[found]
        for i in range(first - 1, -1, -1):
            if not len(found):
                break
            term, n = held[i]
            places, score = self.lists[term]
            at = np.minimum(np.searchsorted(places, found), len(places) - 1)
            part = part + np.where(places[at] == found, n * score[at], 0)
            open_ = part + left[i] >= worst
            found, part = found[open_], part[open_]
        scores, missing, ids = np.r_[scores, part], np.r_[missing, self.missing[found]], np.r_[ids, self.ids[found]]
        order = np.lexsort((ids, missing, -scores))[:k]
        return scores[order], missing[order], ids[order]

    def _sure(self, held: list[tuple[int, int]], wanted: int) -> int:
        """A score that at least `wanted` documents reach: those of the heaviest pair lists, scored in full."""
        seeds: set[int] = set()
        for x, y in zip(held[-2::-1], held[:0:-1]):
            places, _ = self.joint.get((min(x[0], y[0]), max(x[0], y[0])), ((), 0))
            seeds.update(places[:wanted] if len(seeds) < wanted else ())
        if len(seeds) < wanted:
            return 1
        at = np.array(sorted(seeds), np.int32)
        sums = np.zeros(len(at), np.int64)
        for term, n in held:
            places, score = self.lists[term]
            spot = np.minimum(np.searchsorted(places, at), len(places) - 1)
            sums += np.where(places[spot] == at, n * score[spot], 0)
        return max(1, int(np.sort(sums)[-wanted]))


def _rank_block(docs: DataFrame, items: Items, k: int, chunk_docs: int) -> DataFrame:
    """item (number), doc, score: the k best of every task."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(items.vocabulary)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _chunks(batches, vocabulary.value, chunk_docs)

    chunks = stored(docs.mapInPandas(read, CHUNK_SCHEMA), "postings")
    totals = chunks.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
    # One count for each of the items' terms, which are bounded.
    df = dict(chunks.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df")).collect())
    weights = [math.floor(1000 * math.log((2 * totals.docs + 2) / (2 * df[t] + 1))) if t in df else 0 for t in range(len(items.vocabulary))]
    order = items.order(weights)
    sent = spark.sparkContext.broadcast((totals.docs, totals.terms, weights, neighbours(order), list(order.values())))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs, size, weights, pairs, asked = sent.value
        best: list = [None] * len(asked)
        for batch in batches:
            for chunk in batch.chunk:
                index = PairIndex(chunk, docs, size, weights, pairs)
                best = [index.search(held, k, known) if held else None for held, known in zip(asked, best)]
        rows = [(number, None if m else i, s) for number, known in enumerate(best) if known is not None
                for s, m, i in zip(known[0].tolist(), known[1].tolist(), known[2].tolist())]
        yield pd.DataFrame(rows, columns=["item", "doc", "score"]).astype({"item": "int32", "doc": "Int64", "score": "int64"})

    # A chunk is a row of a megabyte or so: few of them at a time go to Python.
    return chunks.select("chunk").mapInPandas(search, "item int, doc long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, *, k: int = 20, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", item_chars: int = ITEM_CHARS,
                   chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's k best documents."""
    spark = docs.sparkSession
    number = F.col(doc_id).cast("long")
    docs = docs.select(F.coalesce(number, F.lit(0)).alias("id"), number.isNull().alias("lacks"), F.col(text).alias("t"))
    docs = docs.filter("t is not null and t != ''")
    asked = items.filter(F.col(item_id).isNotNull()).groupBy(F.col(item_id).alias("key")).agg(F.min(item_text).alias("t"))
    asked = stored(asked.withColumn("chars", F.coalesce(F.char_length("t"), F.lit(0)) + 64), "items")
    # Items are asked in blocks whose texts are bounded; each block reads the documents once.
    blocks = max(1, -(-(asked.agg(F.sum("chars")).first()[0] or 0) // item_chars))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
    out = None
    for block in range(blocks):
        rows = [(r.key, r.t) for r in dealt.filter(F.col("block") == block).select("key", "t").orderBy("key").collect()]
        names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(rows)], f"item int, item_id {asked.schema['key'].dataType.simpleString()}")
        found = _rank_block(docs, Items(rows), k, chunk_docs).join(F.broadcast(names), "item")
        out = found if out is None else out.unionAll(found)
    best = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return (out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", "rank", F.col("doc").alias("doc_id"), "score"))
