"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

A `LineIndex` counts, for every line key, the documents that hold it.  Keys at or above the threshold
are *blocked*; each shard keeps its blocked keys in a cuckoo filter.  Cleaning probes the filters first
and asks the exact counts only about positives, so a line is dropped by the counts alone.  Documents can
be added and deleted: counts rise and fall, and keys crossing the threshold enter or leave the filters
(a cuckoo filter can delete), which makes dedup reversible.  A filter without room is made anew from the exact
counts, and when all are well filled their keys are dealt to more shards.

Defined results: a missing text is one empty line; a line whose key is shorter than `min_chars` is never
blocked; a key counts once per document however often it is repeated there; equal rows count as
documents of their own; an empty table has no counts; further columns are carried along by `clean`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, release_model, stored, whole_text

SLOTS = 4
KICKS = 500
SHARD_KEYS = 250_000          # blocked keys a shard should hold; a filter of about 1 MB
FILTER_BYTES = 48 << 20       # filters held by a worker at once; more shards take more rounds
FILTER_SCHEMA = "shard int, prints binary"
_MIX = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    """Set of 64-bit hashes with deletion; 16-bit fingerprints in buckets of four."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints                     # (buckets, SLOTS) uint16; 0 is an empty slot
        self.mask = np.uint64(len(prints) - 1)

    @classmethod
    def sized_for(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8) + 1))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        """Filter of distinct hashes; doubles in size in the rare case that an insertion finds no place."""
        buckets = len(cls.sized_for(len(hashes)).prints)
        while True:
            out = cls(np.zeros((buckets, SLOTS), np.uint16))
            if all(out.insert(h) for h in hashes):
                return out
            buckets *= 2

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.prints.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = hashes & self.mask
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        with np.errstate(over="ignore"):
            step = (np.asarray(prints).astype(np.uint64) * _MIX) >> np.uint64(20)
        return (bucket ^ step) & self.mask

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(hashes)
        hit = (self.prints[first] == prints[:, None]).any(1)
        return hit | (self.prints[second] == prints[:, None]).any(1)

    def insert(self, h: int) -> bool:
        prints, first, second = self._places(np.array([h], np.uint64))
        p, bucket = prints[0], first[0]
        for b in (bucket, second[0]):
            free = np.flatnonzero(self.prints[b] == 0)
            if len(free):
                self.prints[b, free[0]] = p
                return True
        for kick in range(KICKS):
            slot = (int(p) + kick) % SLOTS
            p, self.prints[bucket, slot] = self.prints[bucket, slot], p
            bucket = self._other(bucket, p)
            free = np.flatnonzero(self.prints[bucket] == 0)
            if len(free):
                self.prints[bucket, free[0]] = p
                return True
        return False

    def delete(self, h: int) -> bool:
        prints, first, second = self._places(np.array([h], np.uint64))
        for b in (first[0], second[0]):
            found = np.flatnonzero(self.prints[b] == prints[0])
            if len(found):
                self.prints[b, found[0]] = 0
                return True
        return False


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def _exact(key: Column) -> Column:
    """The reference table holds SHA-256 digests, not texts: 32 bytes whatever a line's length."""
    return F.unhex(F.sha2(key, 256))


def _filter_hash(digest: Column) -> Column:
    return F.xxhash64(digest)


def _shard(digest: Column, shards: int) -> Column:
    return F.pmod(F.hash(digest), F.lit(shards))


class LineIndex:
    """Reference counts (digest, n_docs) and the cuckoo filters of the keys in at least `min_docs` documents."""

    def __init__(self, refs: DataFrame, filters: DataFrame, shards: int, min_docs: int, min_chars: int):
        self.refs, self.filters = refs, filters
        self.shards, self.min_docs, self.min_chars = shards, min_docs, min_chars

    @classmethod
    def build(cls, docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> LineIndex:
        refs = stored(cls._counted(docs, text, min_chars), "line-refs")
        blocked = refs.filter(F.col("n_docs") >= min_docs)
        shards = max(1, -(-blocked.count() // SHARD_KEYS))
        return cls(refs, stored(cls._filled(blocked, shards), "line-filters"), shards, min_docs, min_chars)

    @staticmethod
    def _filled(blocked: DataFrame, shards: int, only: DataFrame | None = None) -> DataFrame:
        """Filters of all blocked keys, or of those in some shards."""
        hashes = blocked.select(_shard(F.col("digest"), shards).alias("shard"), _filter_hash(F.col("digest")).alias("h"))
        if only is not None:
            hashes = hashes.join(only, "shard", "left_semi")

        def fill(key, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": [key[0]], "prints": [CuckooFilter.of(np.unique(rows.h.to_numpy().view(np.uint64))).dump()]})

        # One row per distinct key and a bounded number of keys a shard: groups cannot be hot.
        return hashes.groupBy("shard").applyInPandas(fill, FILTER_SCHEMA)

    @staticmethod
    def _counted(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
        """Documents per key, counted before the shuffle: a key in every third row is a few partial sums."""
        keys = F.array_distinct(F.transform(F.split(whole_text(text), "\n"), _key))
        return (docs.select(F.explode(keys).alias("k")).filter(F.char_length("k") >= min_chars)
                .groupBy(_exact(F.col("k")).alias("digest")).agg(F.count("*").alias("n_docs")))

    def add(self, docs: DataFrame, text: str = "text") -> LineIndex:
        return self._changed(docs, text, 1)

    def remove(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """Take documents out again; a ValueError if they hold lines that the index counts in fewer documents."""
        return self._changed(docs, text, -1)

    def _changed(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        change = self._counted(docs, text, self.min_chars).withColumnRenamed("n_docs", "by")
        both = stored(self.refs.join(change, "digest", "full").select(
            "digest", F.coalesce("n_docs", F.lit(0)).alias("was"),
            (F.coalesce("n_docs", F.lit(0)) + sign * F.coalesce("by", F.lit(0))).alias("n_docs")), "line-changes")
        if sign < 0 and not both.filter("n_docs < 0").isEmpty():
            raise ValueError("documents to be removed were never added")
        limit = F.lit(self.min_docs)
        refs, blocked = both.filter("n_docs > 0").select("digest", "n_docs"), both.filter(F.col("n_docs") >= limit).select("digest")
        needed = -(-blocked.count() // SHARD_KEYS)
        if needed > self.shards:
            # Room for as many again: the keys of all shards are dealt anew, from the exact counts, only at each doubling.
            return LineIndex(refs, stored(self._filled(blocked, 2 * needed), "line-filters"), 2 * needed, self.min_docs, self.min_chars)
        crossing = both.filter((F.col("was") >= limit) != (F.col("n_docs") >= limit)).select(
            _shard(F.col("digest"), self.shards).alias("shard"), _filter_hash(F.col("digest")).alias("h"),
            (F.col("n_docs") >= limit).alias("enters"))

        def apply(key, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            hashes, enters = rows.h.to_numpy().view(np.uint64), rows.enters.to_numpy(bool)
            out = CuckooFilter.load(old.prints.iloc[0]) if len(old) else CuckooFilter.sized_for(len(rows))
            for h in hashes[~enters]:
                out.delete(h)
            room = all([out.insert(h) for h in hashes[enters]])
            return pd.DataFrame({"shard": [key[0]], "prints": [out.dump() if room else None]})

        filters = stored(self.filters.groupBy("shard").cogroup(crossing.groupBy("shard")).applyInPandas(apply, FILTER_SCHEMA),
                         "line-filters")
        full = filters.filter("prints is null").select("shard")
        if not full.isEmpty():                 # a shard without room is made anew from the exact counts, larger
            filters = stored(filters.filter("prints is not null").unionAll(self._filled(blocked, self.shards, full)), "line-filters")
        return LineIndex(refs, filters, self.shards, self.min_docs, self.min_chars)

    def _suspects(self, docs: DataFrame, key_id: str, text: str) -> DataFrame:
        """(id, digest) of the lines that the filters call blocked; filters are sent in rounds of bounded size."""
        lines = F.array_distinct(F.transform(F.split(whole_text(text), "\n"), _key))
        digests = F.transform(F.filter(lines, lambda k: F.char_length(k) >= self.min_chars), _exact)
        rows = docs.select(F.col(key_id), digests.alias("digests"))
        sizes = self.filters.select("shard", F.length("prints").alias("n")).orderBy("shard").toLocalIterator()
        rounds: list[list[int]] = [[]]
        held = 0
        for r in sizes:
            if held + r.n > FILTER_BYTES and rounds[-1]:
                rounds.append([])
                held = 0
            rounds[-1].append(r.shard)
            held += r.n
        out = None
        for shards in rounds:
            found = self._probe(rows, shards, key_id)
            out = found if out is None else out.unionAll(found)
        return out

    def _probe(self, rows: DataFrame, shards: list[int], key_id: str) -> DataFrame:
        spark, n = rows.sparkSession, self.shards
        picked = self.filters.filter(F.col("shard").isin(shards)).collect() if shards else []
        sent = spark.sparkContext.broadcast({r.shard: bytes(r.prints) for r in picked})   # at most FILTER_BYTES

        @F.pandas_udf("array<boolean>")
        def maybe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            release_model()
            filters = {k: CuckooFilter.load(v) for k, v in sent.value.items()}
            for hashes, homes in batches:
                lengths = hashes.map(len).to_numpy()
                h = np.concatenate([np.empty(0, np.int64), *hashes]).astype(np.int64).view(np.uint64)
                home = np.concatenate([np.empty(0, np.int32), *homes])
                hit = np.zeros(len(h), bool)
                for shard, cuckoo in filters.items():
                    at = np.flatnonzero(home == shard)
                    hit[at] = cuckoo.contains(h[at])
                yield pd.Series(np.split(hit, np.cumsum(lengths)[:-1]) if len(lengths) else [])

        flagged = rows.select(key_id, "digests", maybe(
            F.transform("digests", _filter_hash), F.transform("digests", lambda d: _shard(d, n))).alias("hits"))
        hit = F.filter(F.arrays_zip("digests", "hits"), lambda x: x["hits"])
        return flagged.filter(F.exists("hits", lambda x: x)).select(key_id, F.explode(hit["digests"]).alias("digest"))

    def clean(self, docs: DataFrame, *, text: str = "text") -> DataFrame:
        """`docs` with its text cleaned, `n_lines` before and `n_dropped`; rows are matched by position-free digests."""
        # Rows are told apart by their text's digest: equal texts lose the same lines.
        keyed = docs.withColumn("__row", F.unhex(F.sha2(whole_text(text), 256)))
        suspects = self._suspects(keyed, "__row", text).distinct()
        blocked = self.refs.filter(F.col("n_docs") >= self.min_docs).select("digest")
        drops = (suspects.join(blocked, "digest").groupBy("__row")
                 .agg(F.collect_set("digest").alias("__drop")))   # at most a text's own lines
        lines = F.split(whole_text(text), "\n")
        kept = F.filter(lines, lambda x: ~F.array_contains(F.col("__drop"), _exact(_key(x))))
        kept = F.when(F.col("__drop").isNull(), lines).otherwise(kept)
        return (keyed.join(drops, "__row", "left").withColumn("__kept", kept)
                .withColumns({"n_lines": F.size(lines).cast("long"),
                              "n_dropped": (F.size(lines) - F.size("__kept")).cast("long"),
                              text: F.array_join("__kept", "\n")})
                .drop("__row", "__drop", "__kept"))


def dedup_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """Count the lines of `docs` and drop those whose key is in at least `min_docs` of its documents."""
    return LineIndex.build(docs, min_docs=min_docs, min_chars=min_chars, text=text).clean(docs, text=text)
