"""Nearest neighbours by cosine over sharded vantage-point trees.

Vectors are dealt to shards by a hash of their id; each shard is a tree of balls around vantage
points.  On unit vectors the chord length is a metric that orders like the cosine, so a subtree is cut
off when the triangle inequality puts it outside the current k-th distance times `relax`: 1 keeps the
search exact, smaller values cut more and may miss neighbours.  Distances are held as two bounds that follow
from the rounding error of the cosine, which for nearly equal vectors is far smaller than that of their
distance; so nothing is cut off because of rounding.  Scores come from the original vectors.

Defined results: vectors that are null, zero or hold null or non-finite components take no part;
vectors of different length never meet; a query never finds rows with its own id; rows repeated with
one id count as one query (the smallest vector) but stay candidates; ties go to the smaller id; fewer
candidates than `k` give fewer rows; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import stored

SHARD_ROWS = 8_192        # vectors a tree should hold
QUERY_BLOCK = 1_024       # queries that visit a tree together
LEAF = 64
ULP = 2.0 ** -53          # relative rounding error of a double
INDEX_SCHEMA = "dim int, shard int, tree binary"


def _scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine row by row: equal vectors get equal scores wherever they stand."""
    dots = (vectors * query).sum(1)
    return dots / (np.sqrt((vectors * vectors).sum(1)) * np.sqrt((query * query).sum()))


def _chords(cosines: np.ndarray | float, error: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the distance of unit vectors whose cosine is known up to `error`."""
    square = 2.0 - 2.0 * np.asarray(cosines)
    least = np.sqrt(np.maximum(0.0, square - 2.0 * error)) * (1.0 - 4 * ULP)
    most = np.sqrt(np.maximum(0.0, square + 2.0 * error)) * (1.0 + 4 * ULP)
    return least, most


class VpTree:
    """Equal vectors are one point with all their ids; ids are kept in ascending order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order], np.float64)
        self.points, owner = np.unique(vectors, axis=0, return_inverse=True)
        owner = owner.reshape(-1)
        by_point = np.argsort(owner, kind="stable")
        self.ids = np.split(ids[by_point], np.cumsum(np.bincount(owner))[:-1])
        self.unit = self.points / np.sqrt((self.points ** 2).sum(1))[:, None]
        # Two normalised vectors and their inner product: a few roundings for each component.
        self.error = 4.0 * (self.points.shape[1] + 8) * ULP
        self.nodes: list[tuple] = []
        self._grow(np.arange(len(self.points)))

    def _grow(self, members: np.ndarray) -> int:
        """A leaf is (members,); an inner node is (vantage point, two children with their distance range)."""
        at = len(self.nodes)
        self.nodes.append((members,))
        if len(members) > LEAF:
            vantage, rest = members[0], members[1:]
            cosines = self.unit[rest] @ self.unit[vantage]
            order = np.argsort(-cosines, kind="stable")
            half = len(order) // 2
            children = tuple((self._grow(rest[part]), float(_chords(cosines[part[0]], self.error)[0]),
                              float(_chords(cosines[part[-1]], self.error)[1])) for part in (order[:half], order[half:]))
            self.nodes[at] = (vantage, *children)
        return at

    def _distance(self, queries: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _chords(queries @ self.unit[members].T, self.error)

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, relax: float) -> list[list[tuple[float, int]]]:
        """For each query its k best (score, id).  Two walks: down to the home leaf for a first radius, then over all that remain."""
        unit = vectors / np.sqrt((vectors ** 2).sum(1))[:, None]
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        radius = np.full(len(ids), 4.0)     # more than any distance

        def look(queries: np.ndarray, members: np.ndarray) -> None:
            far, _ = self._distance(unit[queries], members)
            for row, q in enumerate(queries.tolist()):
                near = members[far[row] <= radius[q]]
                if not len(near):
                    continue
                for point, score in zip(near.tolist(), _scores(vectors[q], self.points[near]).tolist()):
                    # A point's k + 1 smallest ids suffice: one may be the query's own.
                    best[q] += [(score, i) for i in self.ids[point][:k + 1].tolist() if i != ids[q]]
                best[q].sort(key=lambda x: (-x[0], x[1]))
                del best[q][k:]
                if len(best[q]) == k:
                    radius[q] = _chords(best[q][-1][0], self.error)[1]   # never less than the k-th distance

        home: dict[int, list[int]] = {}
        level = {0: np.arange(len(ids))}
        while level:
            following: dict[int, np.ndarray] = {}
            for at, queries in level.items():
                node = self.nodes[at]
                if len(node) == 1:
                    look(queries, node[0])
                    home.setdefault(at, []).extend(queries.tolist())
                    continue
                vantage, (near, _, edge), (far_child, _, _) = node
                inside = self._distance(unit[queries], np.array([vantage]))[0][:, 0] <= edge
                for child, part in ((near, queries[inside]), (far_child, queries[~inside])):
                    if len(part):
                        following[child] = part
            level = following
        stack = [(0, np.arange(len(ids)))]
        while stack:
            at, queries = stack.pop()
            node = self.nodes[at]
            if len(node) == 1:
                done = home.get(at, [])
                queries = np.setdiff1d(queries, done) if done else queries
                if len(queries):
                    look(queries, node[0])
                continue
            look(queries, np.array([node[0]]))
            least, most = (d[:, 0] for d in self._distance(unit[queries], np.array([node[0]])))
            reach = radius[queries] * relax
            slack = 8 * ULP * (2.0 + reach)       # of the sums themselves
            for child, low, high in node[1:]:
                part = queries[(least - reach <= high + slack) & (most + reach >= low - slack)]
                if len(part):
                    stack.append((child, part))
        return best


def _usable(vector: Column) -> Column:
    number = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(number, lambda x: x != 0.0), F.lit(False))


def _doubles(frame: DataFrame, key_id: str, vector: str) -> DataFrame:
    return frame.filter(_usable(F.col(vector)) & F.col(key_id).isNotNull()).select(
        F.col(key_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("dim"))


class VpIndex:
    """Trees of all vectors, one row per shard, stored in the shared folder."""

    def __init__(self, trees: DataFrame, shards: int):
        self.trees, self.shards = trees, shards

    @classmethod
    def build(cls, vectors: DataFrame, *, key_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> VpIndex:
        rows = _doubles(vectors, key_id, vector)
        shards = max(1, -(-rows.count() // shard_rows))
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))

        def grow(key, part: pd.DataFrame) -> pd.DataFrame:
            tree = VpTree(part.id.to_numpy(), np.stack(part.v.to_numpy()))
            return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [pickle.dumps(tree, 5)]})

        return cls(stored(dealt.groupBy("dim", "shard").applyInPandas(grow, INDEX_SCHEMA), "vp-trees"), shards)

    def search(self, queries: DataFrame, *, k: int = 5, relax: float = 1.0, key_id: str = "vec_id",
               vector: str = "embedding") -> DataFrame:
        """query_id, rank (from 1), vec_id, score of each query's k nearest."""
        asked = _doubles(queries, key_id, vector).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q"))
        asked = asked.select("id", "q.*")
        blocks = max(1, -(-asked.count() // QUERY_BLOCK))
        # The stated query set against all shards, in blocks: a task holds one tree and one block.
        sent = (asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int"))
                .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(self.shards - 1)))))
        trees = self.trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keys = ["dim", "shard", "block"]

        def visit(key, tree: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            rows: list[tuple[int, int, float]] = []
            if len(tree) and len(part):
                ids = part.id.to_numpy()
                found = pickle.loads(tree.tree.iloc[0]).search(ids, np.stack(part.v.to_numpy()).astype(np.float64), k, relax)
                rows = [(q, i, s) for q, hits in zip(ids.tolist(), found) for s, i in hits]
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

        near = trees.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(visit, "query_id long, vec_id long, score double")
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
