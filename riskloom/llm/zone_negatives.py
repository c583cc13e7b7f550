"""Hard negatives from Hilbert-ordered candidate blocks with per-dimension zone maps.

All vectors are laid out once as Parquet, one folder per segment, ordered along a Hilbert curve through the
components that vary most, and numbered in blocks.  A zone map holds the smallest and largest value of every
component in a segment or block.  The inner product of an anchor with anything inside is then between two
sums that interval arithmetic gives; a segment or block is read for an anchor only if these bounds reach one of
its windows.  A window is a range of scores of which the k best are wanted; it gets narrower from below as
better rows are found, so an anchor visits its own segment first and then only what can still compete.

The same search finds an anchor's positives (best rows of its label, any score) and its negatives (best rows of
other labels with a score in a range given by each positive's score).

Defined results: rows whose id, label or vector is missing, or whose vector holds null or non-finite
components, take no part; vectors of different length never meet; equal rows count once; of several rows of one
id that with the smallest label, then length, then vector is the anchor; rows with the anchor's id are neither its positives nor its
negatives; ties go to the smaller id; fewer rows than asked for give fewer; a positive without a negative in
its range gives no row; an empty table gives no rows; extra columns are not read.  Scores beyond 64 bits raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import stored
from riskloom.llm.maxscore import exact_type, magnitude, packed, whole_vectors
from riskloom.session import work_folder

BLOCK_ROWS = 512
SEGMENT_ROWS = 16 * BLOCK_ROWS
GROUP = 4_096             # anchors, or zone maps, that a task holds
CURVE_DIMS, CURVE_BITS = 8, 7
MAX_LENGTHS = 1_000       # different vector lengths
LOWEST, HIGHEST = -(1 << 62), 1 << 62
WINDOWS = "array<struct<win:int,low:long,high:long>>"


def hilbert(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Place of each point (whole numbers of `bits` bits per column) on the Hilbert curve, as a long."""
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):          # undo the rotations of the curve, coarse to fine
        below = (1 << bit) - 1
        for d in range(dims):
            flip = (x[:, d] >> bit & 1).astype(bool)
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, d]) & below)
            x[:, 0] ^= np.where(flip, below, swap)
            x[:, d] ^= swap
    for d in range(1, dims):                    # Gray code across the columns
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | x[:, d] >> bit & 1
    return key


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with anything between `low` and `high` (anchors x zones)."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


class Windows:
    """The windows of one anchor: per window the k best (score, id) in its range so far."""

    def __init__(self, asked, k: int):
        self.wins = [w["win"] for w in asked]
        self.low = np.array([w["low"] for w in asked], np.int64)
        self.high = np.array([w["high"] for w in asked], np.int64)
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in asked]
        self.k = k

    def reached(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which of the zones with these bounds can hold a score some window still wants."""
        return ((most[:, None] >= self.low) & (least[:, None] <= self.high)).any(1)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for i in range(len(self.wins)):
            inside = (scores >= self.low[i]) & (scores <= self.high[i])
            if inside.any():
                s, n = np.r_[self.best[i][0], scores[inside]], np.r_[self.best[i][1], ids[inside]]
                order = np.lexsort((n, -s))[:self.k]
                self.best[i] = s[order], n[order]
                if len(order) == self.k:
                    self.low[i] = max(self.low[i], int(s[order[-1]]))

    def rows(self, anchor: int) -> list[tuple[int, int, int, int]]:
        return [(anchor, win, i, s) for win, (scores, ids) in zip(self.wins, self.best) for s, i in zip(scores.tolist(), ids.tolist())]


class ZonedVectors:
    """Usable rows (id, label, dim, v) in Hilbert order: `path` holds them, `zones` the bounds of each segment."""

    def __init__(self, spark, path: str, zones: DataFrame, schema):
        self.rows = spark.read.schema(schema).parquet(path)
        self.zones = zones

    @classmethod
    def build(cls, vectors: DataFrame, *, key_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
              segment_rows: int = SEGMENT_ROWS, block_rows: int = BLOCK_ROWS) -> ZonedVectors:
        spark = vectors.sparkSession
        label = F.col(label) if isinstance(label, str) else label
        rows = stored(whole_vectors(vectors, key_id, vector, label.cast("long").alias("label")).filter("label is not null"), "zone-rows")
        segments = max(1, -(-rows.count() // segment_rows))
        curve = _curve(rows)

        @F.pandas_udf("long")
        def place(batch: pd.Series) -> pd.Series:
            out = np.zeros(len(batch), np.int64)
            lengths = np.array([len(v) for v in batch], np.int64)
            for length in np.unique(lengths):
                at, start, width = curve[int(length)]
                own = np.flatnonzero(lengths == length)
                if len(at):
                    cells = (packed(batch.iloc[own])[:, at].astype(np.float64) - start) / width * (1 << CURVE_BITS)
                    out[own] = hilbert(np.clip(cells, 0, (1 << CURVE_BITS) - 1))
            return pd.Series(out)

        # Ties on the curve are parted by id and vector, so equal vectors fill as many segments as they need.
        order = ["dim", "key", "id", F.xxhash64("v", "label")]
        laid = (rows.withColumn("key", place("v")).repartitionByRange(segments, *order).sortWithinPartitions(*order).drop("key")
                .withColumn("row", F.monotonically_increasing_id())
                .select("id", "label", "dim", "v", F.shiftright("row", 33).cast("int").alias("segment"),
                        F.floor(F.expr("row & 8589934591") / block_rows).cast("int").alias("block")))
        path = work_folder(spark, "zone-blocks")
        laid.write.partitionBy("segment").parquet(path)
        read = spark.read.schema(laid.schema).parquet(path)
        return cls(spark, path, stored(_zones(read), "zone-maps"), laid.schema)

    def best(self, windows: DataFrame, k: int, same_label: bool) -> DataFrame:
        """anchor, win, id, score, rank: of each window's rows with a score in its range the k best.

        `windows`: anchor, label, dim, v, segment (the first to be visited) and `asked`, its windows.
        """
        first = stored(self._visit(windows, windows.select("anchor", "dim", "segment"), k, same_label), "zone-first")
        # What is known by now narrows the windows: only scores from the k-th best on are wanted.
        by_rank = W.partitionBy("anchor", "win").orderBy(F.desc("score"), "id")
        floors = (first.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") == k)
                  .groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("floors")))
        narrowed = windows.join(floors, "anchor", "left").withColumn("asked", F.transform("asked", lambda w: F.struct(
            w["win"].alias("win"), F.greatest(w["low"], F.coalesce(F.col("floors")[w["win"]], w["low"])).alias("low"),
            w["high"].alias("high")))).drop("floors")
        narrowed = stored(narrowed, "zone-windows")
        more = self._visit(narrowed, stored(self._reached(narrowed, same_label), "zone-needs"), k, same_label)
        return (first.unionAll(more).withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k))

    def _reached(self, windows: DataFrame, same_label: bool) -> DataFrame:
        """(anchor, dim, segment): segments other than the first whose bounds reach a window of the anchor."""
        count = lambda frame: max(1, -(-frame.count() // GROUP))
        anchor_groups, zone_groups = count(windows), count(self.zones)
        deal = lambda groups, *by: F.pmod(F.xxhash64(*by), F.lit(groups)).cast("int")
        every = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        left = windows.withColumn("ag", deal(anchor_groups, "anchor")).withColumn("zg", every(zone_groups))
        right = self.zones.withColumn("zg", deal(zone_groups, "segment")).withColumn("ag", every(anchor_groups))

        def choose(key: tuple, anchors: pd.DataFrame, zones: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(anchors) and len(zones):
                least, most = _bounds(packed(anchors.v), packed(zones.low), packed(zones.high))
                segments, first, last = (zones[c].to_numpy() for c in ("segment", "first_label", "last_label"))
                for row, (anchor, label, home, asked) in enumerate(zip(anchors.anchor, anchors.label, anchors.segment, anchors.asked)):
                    needed = Windows(asked, 0).reached(least[row], most[row]) & (segments != home)
                    needed &= (first <= label) & (label <= last) if same_label else (first != label) | (last != label)
                    out += [(anchor, key[0], s) for s in segments[needed].tolist()]
            return pd.DataFrame(out, columns=["anchor", "dim", "segment"])

        keys = ["dim", "ag", "zg"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(choose, "anchor long, dim int, segment int")

    def _visit(self, windows: DataFrame, needs: DataFrame, k: int, same_label: bool) -> DataFrame:
        """The k best of each window in each segment an anchor needs; a task holds a segment and a group of anchors."""
        groups = max(1, -(-windows.count() // GROUP))
        needs = needs.withColumn("ag", F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int"))
        asked = windows.drop("segment", "dim").join(needs, "anchor")
        # Only folders of segments that somebody needs are read, once for each group of anchors.
        wanted = needs.select(*[F.col(c).alias(c) for c in ("dim", "segment", "ag")]).distinct()
        rows = self.rows.join(wanted, ["dim", "segment"])

        def visit(key: tuple, part: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple[int, int, int, int]] = []
            if len(part) and len(anchors):
                part = part.sort_values("block", kind="stable")
                vectors, blocks = packed(part.v), part.block.to_numpy()
                ids, labels = part.id.to_numpy(), part.label.to_numpy()
                starts = np.flatnonzero(np.r_[True, np.diff(blocks) != 0])
                ends = np.r_[starts[1:], len(blocks)]
                if vectors.shape[1]:
                    low, high = np.minimum.reduceat(vectors, starts), np.maximum.reduceat(vectors, starts)
                else:
                    low = high = np.zeros((len(starts), 0), np.int64)
                own = packed(anchors.v)
                least, most = _bounds(own, low, high)
                kind = exact_type(own.shape[1], magnitude(own), magnitude(vectors))
                vectors = vectors.astype(kind)
                for row, (anchor, label, asked) in enumerate(zip(anchors.anchor, anchors.label, anchors.asked)):
                    windows = Windows(asked, k)
                    for b in np.argsort(-most[row], kind="stable").tolist():
                        if windows.reached(least[row, b:b + 1], most[row, b:b + 1])[0]:
                            block = slice(starts[b], ends[b])
                            fits = ((labels[block] == label) == same_label) & (ids[block] != anchor)
                            scores = (vectors[block] @ own[row].astype(kind)).astype(np.int64)
                            windows.offer(scores[fits], ids[block][fits])
                    out += windows.rows(anchor)
            return pd.DataFrame(out, columns=["anchor", "win", "id", "score"])

        keys = ["dim", "segment", "ag"]
        return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(visit, "anchor long, win int, id long, score long")


def _bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = exact_type(anchors.shape[1], magnitude(anchors), max(magnitude(low), magnitude(high)))
    return intervals(anchors.astype(kind), low.astype(kind), high.astype(kind))


def _curve(rows: DataFrame) -> dict[int, tuple[list[int], np.ndarray, np.ndarray]]:
    """Per vector length the components that vary most, with start and width of their values."""
    spread = (rows.select("dim", F.posexplode("v").alias("pos", "x")).groupBy("dim", "pos")
              .agg(F.variance("x").alias("spread"), F.min("x").alias("start"), F.max("x").alias("stop")))
    most = W.partitionBy("dim").orderBy(F.desc_nulls_last("spread"), "pos")
    chosen = (spread.withColumn("r", F.row_number().over(most)).filter(F.col("r") <= CURVE_DIMS)
              .limit(MAX_LENGTHS * CURVE_DIMS + 1).collect())
    if len(chosen) > MAX_LENGTHS * CURVE_DIMS:
        raise ValueError(f"more than {MAX_LENGTHS} vector lengths")
    curve: dict[int, list] = {}
    for row in sorted(chosen, key=lambda r: (r.dim, r.r)):
        curve.setdefault(row.dim, []).append((row.pos, row.start, row.stop - row.start + 1))
    out = {dim: ([p for p, _, _ in parts], np.array([s for _, s, _ in parts], float), np.array([w for _, _, w in parts], float))
           for dim, parts in curve.items()}
    return {0: ([], np.empty(0), np.empty(0)), **out}


def _zones(rows: DataFrame) -> DataFrame:
    """Zone map of each segment: dim, segment, low, high, first_label, last_label."""
    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for (dim, segment), part in batch.groupby(["dim", "segment"]):
                vectors = packed(part.v)
                out.append((dim, segment, vectors.min(0), vectors.max(0), part.label.min(), part.label.max()))
            yield pd.DataFrame(out, columns=["dim", "segment", "low", "high", "first_label", "last_label"])

    parts = rows.mapInPandas(bounds, "dim int, segment int, low array<long>, high array<long>, first_label long, last_label long")
    # A few batches of a segment meet here, as maps of one length each.
    fold = lambda name, pick: F.reduce(F.collect_list(name), F.first(name), lambda a, b: F.zip_with(a, b, lambda x, y: pick(x, y)))
    return parts.groupBy("dim", "segment").agg(
        fold("low", F.least).alias("low"), fold("high", F.greatest).alias("high"),
        F.min("first_label").alias("first_label"), F.max("last_label").alias("last_label"))


def mine(vectors: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 10, from_pct: int = 30, to_pct: int = 90,
         key_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
         segment_rows: int = SEGMENT_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are the best rows of its label.  For each of them the best rows of other labels
    are returned whose score is between `from_pct` and `to_pct` hundredths of the positive's.
    `is_anchor` is a condition on `id`.
    """
    zoned = ZonedVectors.build(vectors, key_id=key_id, vector=vector, label=label, segment_rows=segment_rows, block_rows=block_rows)
    anchors = zoned.rows.filter(is_anchor).groupBy(F.col("id").alias("anchor")).agg(
        F.min(F.struct("label", "dim", "v", "segment")).alias("a")).select("anchor", "a.*")
    anchors = stored(anchors, "zone-anchors")
    anything = F.array(F.struct(F.lit(0).alias("win"), F.lit(LOWEST).cast("long").alias("low"), F.lit(HIGHEST).cast("long").alias("high")))
    pairs = stored(zoned.best(anchors.withColumn("asked", anything.cast(WINDOWS)), positives, True)
                   .select("anchor", F.col("rank").alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                   "zone-positives")
    ranges = (pairs.select("anchor", F.struct("win", _hundredths("positive_score", from_pct, up=True).alias("low"),
                                              _hundredths("positive_score", to_pct, up=False).alias("high")).alias("w"))
              .filter("w.low <= w.high").groupBy("anchor").agg(F.sort_array(F.collect_list("w")).cast(WINDOWS).alias("asked")))
    found = zoned.best(stored(anchors.join(ranges, "anchor"), "zone-ranges"), negatives, False)
    return found.join(pairs, ["anchor", "win"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def _hundredths(score: str, percent: int, up: bool) -> Column:
    """score * percent / 100 on whole numbers, rounded up or down."""
    product = F.col(score) * percent
    rest = F.pmod(product, F.lit(100))
    return F.call_function("div", product - rest, F.lit(100)) + F.when(rest > 0, 1 if up else 0).otherwise(0)
