"""Exact top-k by integer inner product with MaxScore over sharded postings.

Every component is rounded down to a whole number after scaling.  A component d that is above 0 is a posting
of the term (d, +), one below 0 of the term (d, -), with its size as impact; a query holds, for each of its
components, the term of the same sign.  Terms of the other sign only lower a score, their bound is 0.

A shard is traversed window by window, vectors of large norm first.  In a window the query's terms are ordered
by their bound (weight times the largest impact).  Those whose bounds together stay below the k-th best score
so far are non-essential: a vector that is in no other posting list cannot get into the result.  Postings of
the essential terms are traversed, the vectors they lead to are probed for what is left, largest bounds first,
as long as they are competitive.  While there is no k-th score above 0, the list of all vectors is essential,
too.  The shards' results are merged.

Defined results: vectors that are null or hold null or non-finite components take no part, zero and empty
ones do; vectors of different length never meet; a query never finds rows with its own id; equal rows count
once; rows of one id with different vectors are candidates each, the smallest of them is the query; ties go
to the smaller id; fewer candidates than `k` give fewer rows; an empty table gives no rows; extra columns are
not read.  Scores beyond 64 bits raise an error.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import stored

SCALE = 256
SHARD_ROWS = 8_192        # vectors a shard should hold
QUERY_BLOCK = 4_096       # queries that visit a shard together
WINDOW = 2_048            # vectors whose postings have a bound of their own
DENSE = 4                 # a list is kept in full from one vector in so many on
PROBED = 8                # non-essential terms probed between two tests
INDEX_SCHEMA = "dim int, shard int, postings binary"


def finite(vector: Column) -> Column:
    """Neither missing nor with a missing or non-finite component."""
    number = F.transform(vector, lambda x: x.cast("double"))
    return F.coalesce(F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Each component times `scale`, rounded down, as long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def whole_vectors(frame: DataFrame, key_id: str, vector: str, *more: Column) -> DataFrame:
    """id, v, dim (and more columns) of the rows that take part; equal rows once."""
    rows = frame.filter(finite(F.col(vector)) & F.col(key_id).isNotNull())
    return rows.select(F.col(key_id).cast("long").alias("id"), scaled(F.col(vector)).alias("v"), F.size(vector).alias("dim"),
                       *more).distinct()


def exact_type(terms: int, *largest: int) -> type:
    """A type that holds every sum of so many products: doubles are quick, but end at 2 ** 53."""
    bound = max(terms, 1)
    for value in largest:
        bound *= max(value, 1)
    if bound >= 1 << 63:
        raise ValueError("scores of these vectors do not fit 64 bits")
    return np.float64 if bound < 1 << 53 else np.int64


def magnitude(numbers: np.ndarray) -> int:
    return max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))


def packed(vectors: pd.Series) -> np.ndarray:
    """One row per vector."""
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), -1)


class Postings:
    """The posting lists of one shard, cut into windows of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, window: int = WINDOW):
        norm = (vectors.astype(np.float64) ** 2).sum(1)
        order = np.lexsort((ids, -norm))
        self.ids, self.columns, self.largest = ids[order], np.ascontiguousarray(vectors[order].T), magnitude(vectors)
        self.windows = []
        for start in range(0, len(ids), window):
            columns = self.columns[:, start:start + window]
            size, lists = columns.shape[1], []
            for values in columns:
                for sign in (1, -1):
                    impacts = np.maximum(values * sign, 0)
                    holders = np.flatnonzero(impacts).astype(np.int32)
                    # A list that most vectors are in is kept with a place for each of them.
                    lists.append((None, impacts) if DENSE * len(holders) > size else (holders, impacts[holders]))
            top = np.array([impacts.max(initial=0) for _, impacts in lists], np.int64)
            self.windows.append((start, size, lists, top))
        self.traversed = 0        # postings read by searches, for tests

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) for a query vector."""
        kind = exact_type(len(query), self.largest, magnitude(query))
        if self.columns.dtype != kind:
            self.columns = self.columns.astype(kind)
            self.windows = [(start, size, [(holders, impacts.astype(kind)) for holders, impacts in lists], top)
                            for start, size, lists, top in self.windows]
        query = query.astype(kind)
        weight = np.abs(query)
        held = np.flatnonzero(weight)
        terms = 2 * held + (query[held] < 0)
        weight = weight[held]
        scores, ids = np.empty(0, kind), np.empty(0, np.int64)
        worst = None              # the k-th best score so far
        for start, size, lists, top in self.windows:
            bounds = weight * top[terms]
            order = np.argsort(-bounds, kind="stable")
            # left[i]: what the terms from place i on can add at most.
            left = np.r_[np.cumsum(bounds[order][::-1])[::-1], 0]
            if worst is not None and left[0] < worst:
                continue
            essential = len(order) if worst is None else int(np.argmax(left < worst)) if (left < worst).any() else len(order)
            sums = np.zeros(size, kind)
            for i in order[:essential].tolist():
                holders, impacts = lists[terms[i]]
                if holders is None:
                    sums += weight[i] * impacts
                else:
                    sums[holders] += weight[i] * impacts
                self.traversed += len(impacts)
            if worst is None or worst <= 0:
                found = np.arange(size)
            else:
                found = np.flatnonzero((sums > 0) & (sums + left[essential] >= worst))
            found = found[self.ids[start + found] != own]
            # First what lowers the sums of the essential components, then the other components.
            dims = held[order[:essential]]
            part = self._probed(start, size, found, dims, query)
            for at in range(essential, len(order) + 1, PROBED):
                if worst is not None:
                    open_ = part + left[at] >= worst
                    found, part = found[open_], part[open_]
                dims = held[order[at:at + PROBED]]
                part = part + self._probed(start, size, found, dims, query)
            if worst is not None:
                found, part = found[part >= worst], part[part >= worst]
            scores, ids = np.r_[scores, part], np.r_[ids, self.ids[start + found]]
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            if len(scores) == k:
                worst = scores[-1]
        return [(int(s), int(i)) for s, i in zip(scores, ids)]

    def _probed(self, start: int, size: int, found: np.ndarray, dims: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products over some components of the vectors found in a window."""
        if 8 * len(found) > size:             # whole components are read faster than many single places
            return (query[dims] @ self.columns[dims, start:start + size])[found]
        return query[dims] @ self.columns[np.ix_(dims, start + found)]


class MaxScoreIndex:
    """Posting lists of all vectors, one row per shard, stored in the shared folder."""

    def __init__(self, shards: DataFrame, count: int):
        self.shards, self.count = shards, count

    @classmethod
    def build(cls, vectors: DataFrame, *, key_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS,
              window: int = WINDOW) -> MaxScoreIndex:
        rows = whole_vectors(vectors, key_id, vector)
        count = max(1, -(-rows.count() // shard_rows))
        # By id and vector: neither rows of one id nor copies of one vector gather in a shard.
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(count)).cast("int"))

        def post(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            postings = Postings(part.id.to_numpy(), packed(part.v), window)
            return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "postings": [pickle.dumps(postings, 5)]})

        return cls(stored(dealt.groupBy("dim", "shard").applyInPandas(post, INDEX_SCHEMA), "maxscore"), count)

    def search(self, queries: DataFrame, *, k: int = 5, key_id: str = "vec_id", vector: str = "embedding",
               query_block: int = QUERY_BLOCK) -> DataFrame:
        """query_id, rank (from 1), vec_id, score of each query's k best."""
        asked = whole_vectors(queries, key_id, vector).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.*")
        blocks = max(1, -(-asked.count() // query_block))
        # The stated query set against all shards, in blocks: a task holds one shard and one block.
        sent = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
                .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(self.count - 1)))))
        shards = self.shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keys = ["dim", "shard", "block"]

        def visit(key: tuple, shard: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            rows: list[tuple[int, int, int]] = []
            if len(shard) and len(part):
                postings = pickle.loads(shard.postings.iloc[0])
                for own, query in zip(part.id.tolist(), packed(part.v)):
                    rows += [(own, i, s) for s, i in postings.search(own, query, k)]
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

        near = shards.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(visit, "query_id long, vec_id long, score long")
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
