"""Exact Jaccard self-join of word shingles by universe partition, and its connected components.

Sets with Jaccard similarity of at least t differ in at most H = (1-t)/(1+t) * (|r|+|s|) elements.  The
universe of shingles is dealt to segments by hash, as many as the size band needs; if a set touches more
than H segments, one of them must be equal in both sets (pigeonhole).  In the band of small sets a segment
is matched together with its one-deletion neighbourhood, which is worth two differences.  Every set gets an
allocation by cost: signatures that very many sets share are left out, and a set that keeps too few for the
pigeonhole goes to a second level where segments are single shingles and its H + 1 rarest ones are looked
up.  Candidates pass an exact bound on small sketches and are then verified on the shingles themselves.

Groups of copies are never paired up: equal sets are one node, the members of a signature are first
compared with one of them, and what is connected by then is not compared again.

Defined results: a missing or empty text and one without words has no shingles and is linked with nothing;
fewer than WORDS words are one shingle; equal sets are always linked; every row is answered by itself, rows
that repeat a doc_id share its smallest component; an empty table gives an empty one; extra columns are not
read.  A missing doc_id never names a component unless all its members lack one.  If a lost task is run again on rows in another
order (those of files keep theirs), the join ends with an error, as signatures name their set by its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER, UPPER, discard, release_model, stored, whole_text

WORDS = 5
NUM, DEN = 75, 100        # similarity as a fraction
SMALL = 14                # smaller sets: three segments with one-deletion neighbourhoods
SMALL_SEGMENTS = 3
FREQUENT = 32             # signatures shared by more sets are left out where the pigeonhole allows it
PIVOTS = 16               # pivots that a set of many signatures is compared with in the second round
CELLS = 512               # counters of a sketch
BUCKETS = 256             # parts that signatures are dealt to at least
CHUNK_SIGNATURES = 400_000     # signatures packed together, of so many entries at most, which 16 bits number
CHUNK_ENTRIES = 60_000
SENT_IDS = 200_000        # ids sent to every task at most; more are joined by a shuffle
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    tokens = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()   # at the six ASCII blanks, as the contract says
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    n = len(h) - width + 1
    out = np.full(n, len(h) if width < words else 0, np.uint64)
    for j in range(width):
        out = _mixed(out + h[j:j + n] * _ODD[j % len(_ODD)])
    return np.unique(out)


def _node(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketch(tokens: np.ndarray) -> bytes:
    """How many shingles fall in each cell, up to 255."""
    return np.minimum(np.bincount((tokens % np.uint64(CELLS)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes()


def difference_bound(n: int, largest: int, num: int = NUM, den: int = DEN) -> int:
    """Largest difference of a set of n elements and a partner of at most `largest`."""
    return (den - num) * (n + min(largest, n * den // num)) // (den + num)


def signatures(tokens: np.ndarray, num: int = NUM, den: int = DEN) -> list[tuple[int, np.ndarray, int]]:
    """(band, signatures, slack) per band of a set; slack: how many of them the pigeonhole can spare, negative: too few."""
    n, out = len(tokens), []
    if difference_bound(n, n * den // num, num, den) == 0:   # partners are equal sets, which are one node
        return out
    edges = [0, SMALL]
    while edges[-1] <= n:
        edges.append(edges[-1] * 2)
    for band in range(len(edges) - 1):
        low, high = edges[band], edges[band + 1]
        # A pair meets in the band of its smaller set, so a set is also in the band below if partners are there.
        if n < low or n * num >= high * den:
            continue
        need = 1 + difference_bound(n, n * den // num if n < high else high - 1, num, den)
        segments = SMALL_SEGMENTS if not band else int(0.42 * high) + 3
        segment = _mixed(tokens + np.uint64(band)) % np.uint64(segments)
        order = np.argsort(segment, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(segment[order]) != 0])
        parts = _mixed(tokens ^ _ODD[1])[order]
        sums = np.add.reduceat(parts, at)                       # a subset's hash: the sum of its elements'
        sizes = np.diff(np.r_[at, n])
        place = segment[order][at] * np.uint64(64) + np.uint64(band)
        sigs = _mixed(sums + _mixed(place))
        credit = len(at)
        if not band:
            several = np.repeat(sizes > 1, sizes)
            rest = np.repeat(sums, sizes) - parts
            sigs = np.unique(np.r_[sigs, _mixed(rest + _mixed(np.repeat(place, sizes)))[several]])
            # A lone element's neighbourhood lacks the empty subset, so it is worth one difference only.
            credit += int((sizes > 1).sum())
        # One left-out signature costs at most two differences in the small band, one elsewhere.
        slack = credit - need
        out.append((band, sigs, slack if band or slack < 0 else slack // 2))
    return out


PASS = "part int, bucket int, chunk long, packed binary, id long, node long, n long, short boolean, bits binary"
DOCUMENT, ENTRIES, SIGNATURES = range(3)   # what a row of PASS holds
BITS = np.uint64(48)                       # a signature's lower bits are sent, its upper ones name its bucket


def _pack(low: np.ndarray, entry: np.ndarray) -> bytes:
    """Signatures of ascending entries in eight bytes each: six of its own, two for the step from the entry before."""
    steps = np.diff(entry, prepend=np.uint16(0)).view(np.uint8).reshape(-1, 2)
    return low.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() + steps[:, 0].tobytes() + steps[:, 1].tobytes()


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 8
    low, steps = np.zeros((n, 8), np.uint8), np.empty((n, 2), np.uint8)
    low[:, :6] = np.frombuffer(packed, np.uint8, 6 * n).reshape(n, 6)
    steps[:, 0], steps[:, 1] = np.frombuffer(packed, np.uint8, 2 * n, 6 * n).reshape(2, n)
    return low.view(np.uint64).ravel(), np.cumsum(steps.view(np.uint16).ravel(), dtype=np.uint16)


def _chunk(sigs: list, nodes: list, aux: list, buckets: int) -> pd.DataFrame:
    """One row says which sets (and bands) the entries are, one per bucket holds its signatures.

    A chunk is named by what its entries are, so one that is made anew in another order is not taken for it.
    """
    names = np.array(nodes, np.int64).tobytes() + np.array(aux, np.int32).tobytes()
    chunk = int.from_bytes(hashlib.blake2b(names, digest_size=8).digest(), "little", signed=True)
    flat = np.concatenate(sigs)
    bucket = ((flat >> BITS) % np.uint64(buckets)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    entry = np.repeat(np.arange(len(sigs), dtype=np.uint16), [len(s) for s in sigs])[order]
    flat, bucket = flat[order], bucket[order].astype(np.int32)
    at = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True])
    packed = [_pack(flat[i:j], entry[i:j]) for i, j in zip(at, at[1:])]
    return pd.DataFrame({"part": [ENTRIES] + [SIGNATURES] * len(packed), "bucket": [chunk % buckets, *bucket[at[:-1]]],
                         "chunk": chunk, "packed": [names, *packed], "id": None, "node": None, "n": None, "short": None, "bits": None})


def _signed(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """One reading of the texts gives rows of documents and chunks of packed signatures.

    A document: its id, set, size, sketch, and whether it had too few signatures from the start.  An entry is a
    set in a band, with aux = 64 * slack + band.
    """
    release_model()
    sigs, nodes, aux, held, row = [], [], [], 0, 0
    for batch in batches:
        docs = []
        for doc, t in zip(batch.id, batch.t):
            tokens = shingles(t)
            node, short = _node(tokens), False
            for band, own, slack in signatures(tokens):
                short |= slack < 0
                sigs.append(own)
                nodes.append(node)
                aux.append(64 * max(slack, 0) + band)
                held += len(own)
            row += 1
            docs.append((DOCUMENT, row % buckets, None, None, doc, node, len(tokens), short, _sketch(tokens)))
            if held >= CHUNK_SIGNATURES or len(sigs) >= CHUNK_ENTRIES:
                yield _chunk(sigs, nodes, aux, buckets)
                sigs, nodes, aux, held = [], [], [], 0
        yield pd.DataFrame(docs, columns=["part", "bucket", "chunk", "packed", "id", "node", "n", "short", "bits"])
    if sigs:
        yield _chunk(sigs, nodes, aux, buckets)


def _shared(rows: pa.Table) -> pa.Table:
    """Rows of one bucket, without the signatures that only one document has."""
    packs = rows.filter(pc.equal(rows["part"], SIGNATURES))
    if not packs.num_rows:
        return rows
    low, entry = zip(*map(_unpack, packs["packed"].to_pylist()))
    flat = np.concatenate(low)
    order = np.argsort(flat)
    same = flat[order[1:]] == flat[order[:-1]]
    met = np.zeros(len(flat), bool)
    met[order[1:][same]] = met[order[:-1][same]] = True
    kept = np.split(met, np.cumsum([len(x) for x in low])[:-1])
    packed = [_pack(x[k], y[k]) for x, y, k in zip(low, entry, kept)]
    at = packs.schema.get_field_index("packed")
    packs = packs.set_column(at, packs.schema.field(at), pa.array(packed, packs.schema.field(at).type))
    return pa.concat_tables([rows.filter(pc.not_equal(rows["part"], SIGNATURES)), packs.filter(pc.greater(pc.binary_length(packs["packed"]), 0))])


def _named(rows: pa.Table) -> pa.Table:
    """Signatures of one chunk with the sets they belong to."""
    names = rows.filter(pc.equal(rows["part"], ENTRIES))["packed"].to_pylist()
    packs = rows.filter(pc.equal(rows["part"], SIGNATURES))
    out = {"sig": np.empty(0, np.int64), "node": np.empty(0, np.int64), "aux": np.empty(0, np.int32)}
    if packs.num_rows:
        if not names:
            raise RuntimeError("a chunk of signatures lacks its entries: the documents came in another order when a lost task was run again")
        n = len(names[0]) // 12
        nodes, aux = np.frombuffer(names[0], np.int64, n), np.frombuffer(names[0], np.int32, n, 8 * n)
        low, entry = zip(*map(_unpack, packs["packed"].to_pylist()))
        bucket = np.repeat(packs["bucket"].to_numpy().astype(np.uint64), [len(x) for x in low])
        entry = np.concatenate(entry)
        out = {"sig": (np.concatenate(low) | bucket << BITS).view(np.int64), "node": nodes[entry], "aux": aux[entry]}
    return pa.table(out)


def _named_once(rows: pa.Table) -> pa.Table:
    """The same, each signature of a set once, however many copies of it the chunk holds."""
    found = _named(rows).group_by(["sig", "node"]).aggregate([("aux", "min")])
    return found.rename_columns(["sig", "node", "aux"])


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch.t]
        yield pd.DataFrame({"node": [_node(s) for s in sets], "set": [s.tobytes() for s in sets]})


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch.t]
        yield pd.DataFrame({"token": np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64),
                            "node": np.repeat([_node(s) for s in sets], [len(s) for s in sets]).astype(np.int64)})


def _linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        out = []
        for a, b in zip(left, right):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            out.append(DEN * common >= NUM * (len(a) + len(b) - common))
        yield pd.Series(out, dtype=bool)


def _may_link(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Cells that differ by k need k elements that differ, so too large a difference rules a link out."""
    for a, b, n, m in batches:
        if not len(a):
            yield pd.Series([], dtype=bool)
            continue
        x, y = (np.frombuffer(b"".join(side), np.uint8).reshape(len(a), CELLS).astype(np.int16) for side in (a, b))
        differ = np.abs(x - y).sum(1, dtype=np.int64)
        yield pd.Series((DEN + NUM) * differ <= (DEN - NUM) * (n.to_numpy() + m.to_numpy()))


def sent_if_small(rows: DataFrame) -> DataFrame:
    """Stored rows of two numbers: up to SENT_IDS of them go to every task, more are joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= SENT_IDS else rows


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes in edges (a, b), by contraction.

    Every node hooks to its smallest neighbour and edges are renamed; node numbers are hashes, so a path
    shrinks by a constant share each time.  Each step is stored in the shared folder.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node"))
    used = [edges]
    while not edges.isEmpty():
        used.append(stored(edges.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to")), "hooks"))
        hook = sent_if_small(used[-1])
        for end in ("a", "b"):
            edges = (edges.join(hook, F.col(end) == F.col("from"), "left")
                     .withColumn(end, F.coalesce("to", end)).drop("from", "to"))
        labels = labels.join(hook, F.col("comp") == F.col("from"), "left").select("node", F.coalesce("to", "comp").alias("comp"))
        edges = stored(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        used.append(edges)
    labels = stored(labels, "labels")
    discard(*used)
    return labels


class JaccardJoin:
    """One self-join: nodes are distinct shingle sets, `rows` says which document has which."""

    def __init__(self, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text"):
        self.docs = docs.select(F.col(doc_id).alias("id"), whole_text(text).alias("t"))
        # Buckets stay small as the session's shuffle does; upper bits of a signature name at most 65,536.
        buckets = min(max(BUCKETS, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1 << 16)
        met = (self.docs.mapInPandas(lambda batches: _signed(batches, buckets), PASS)
               .groupBy("bucket").applyInArrow(_shared, PASS))
        # Most signatures are met by one document only and end here.
        self.met = stored(met, "jaccard-met")
        own = self.met.filter(F.col("part") == DOCUMENT)
        self.rows = stored(own.select("id", "node", "n", "short"), "jaccard-rows")
        self.short = self.rows.filter("short").select("node")
        # One document stands for each distinct set.
        self.nodes = stored(own.filter("n > 0").groupBy("node").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "jaccard-nodes")
        self.labels: DataFrame | None = None

    def _texts(self, nodes: DataFrame) -> DataFrame:
        """Texts of the documents that stand for the given nodes."""
        some = stored(self.nodes.join(nodes.select("node").distinct(), "node").select("id").distinct(), "ids")
        if some.count() <= SENT_IDS:
            some = F.broadcast(some)         # the texts stay where they are
        return self.docs.join(some, self.docs.id.eqNullSafe(some.id), "left_semi").select("t")

    def _comp(self, rows: DataFrame, node: str, out: str) -> DataFrame:
        if self.labels is None:
            return rows.withColumn(out, F.col(node))
        known = sent_if_small(self.labels.select(F.col("node").alias("__n"), F.col("comp").alias("__c")))
        return (rows.join(known, F.col(node) == F.col("__n"), "left")
                .withColumn(out, F.coalesce("__c", node)).drop("__n", "__c"))

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) that sizes and sketches allow."""
        side = lambda name: self.nodes.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("bits").alias(f"bits{name}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        both = both.filter((F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM))
        return both.filter(F.pandas_udf(_may_link, "boolean")("bitsa", "bitsb", "na", "nb")).drop("bitsa", "bitsb", "na", "nb")

    def _sets(self, pairs: DataFrame) -> DataFrame:
        """Shingles of all sets in pairs, read anew from their texts: only plausible pairs get here."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        return stored(self._texts(ends).mapInPandas(_packed, "node long, set binary"), "sets")

    def _verify(self, pairs: DataFrame, sets: DataFrame | None = None) -> None:
        """Check pairs on their shingles; links join the components."""
        pairs = stored(pairs.select("a", "b"), "pairs")
        if pairs.isEmpty():
            discard(pairs)
            return
        own = [] if sets is not None else [self._sets(pairs)]
        sets = sets if not own else own[0]
        full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"))
        links = stored(full.filter(F.pandas_udf(_linked, "boolean")("sa", "sb")).select("a", "b"), "links")
        discard(*own, pairs)
        # Only what is new is contracted: components so far are the nodes of the new edges.
        joined = self._comp(self._comp(links, "a", "ca"), "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).filter("a != b")
        fresh = components(joined)
        discard(links)
        if self.labels is not None:
            new = sent_if_small(fresh.select(F.col("node").alias("__was"), F.col("comp").alias("__is")))
            old = (self.labels.join(new, F.col("comp") == F.col("__was"), "left")
                   .select("node", F.coalesce("__is", "comp").alias("comp")))
            both = stored(old.unionAll(fresh.join(self.labels.select("node"), "node", "left_anti")), "labels")
            discard(fresh, self.labels)
            fresh = both
        self.labels = fresh

    def run(self) -> JaccardJoin:
        """Find and verify all pairs. What is stored on the way goes when it has been read for the last time."""
        group = W.partitionBy("sig")
        named = self.met.filter(F.col("part") != DOCUMENT).groupBy("chunk").applyInArrow(_named_once, "sig long, node long, aux int")
        # A signature comes once a chunk and set, so one shuffle by it serves both steps.
        counted = named.repartition("sig").dropDuplicates(["sig", "node"]).withColumn("c", F.count("*").over(group)).filter("c > 1")
        counted = stored(counted, "jaccard-counted")
        discard(self.met)
        # The pivot of a signature is its set with the most company: the unedited one among its copies.
        central = stored(counted.groupBy("node").agg(F.sum("c").alias("company")), "jaccard-company")
        met = counted.join(sent_if_small(central), "node").withColumn("pivot", F.max(F.struct("company", "node")).over(group)["node"])
        met = stored(met.drop("company"), "jaccard-groups")
        discard(counted, central)
        # First each set with the pivot it shares most signatures with, then the other pivots it is not joined to yet.
        stars = self._stars(met).groupBy("a", "b").agg(F.count("*").alias("shared"))
        stars = stored(self._plausible(stars), "jaccard-stars")
        sets = self._sets(stars)
        best = W.partitionBy("b").orderBy(F.desc("shared"), "a")
        self._verify(stars.withColumn("r", F.row_number().over(best)).filter("r = 1"), sets)
        self._verify(self._apart(stars), sets)
        discard(stars, sets)
        # Copies that are far from that pivot: once more with pivots that differ from signature to signature.
        open_rows = self._open(met)
        discard(met)
        turn = F.struct(F.xxhash64(F.pmod(F.col("sig"), F.lit(PIVOTS)), "node"), "node")
        others = open_rows.withColumn("pivot", F.max(turn).over(group)["node"])
        self._verify(self._plausible(self._apart(self._stars(others).distinct()).select("a", "b")))
        known = self._open(open_rows.drop("comp"))
        discard(open_rows)
        few = known.filter(F.col("c") <= FREQUENT)
        left = few.select("sig", F.col("node").alias("a"), F.col("comp").alias("ca"))
        right = few.select("sig", F.col("node").alias("b"), F.col("comp").alias("cb"))
        pairs = left.join(right, "sig").filter("a < b and ca != cb").select("a", "b").distinct()
        short = self._short_of_signatures(known)
        self._verify(self._plausible(pairs))
        discard(known)
        self._second_level(short)
        return self

    @staticmethod
    def _stars(met: DataFrame) -> DataFrame:
        """Pairs (a, b) of a pivot and another set of its signature, in a fixed order."""
        return met.filter("node != pivot").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))

    def _open(self, met: DataFrame) -> DataFrame:
        """Rows of the signatures whose sets are not all connected by now."""
        known = self._comp(met, "node", "comp")
        open_sigs = known.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("sig")
        return stored(known.join(open_sigs, "sig", "left_semi"), "jaccard-open")

    def _apart(self, pairs: DataFrame) -> DataFrame:
        return self._comp(self._comp(pairs, "a", "ca"), "b", "cb").filter("ca != cb")

    def _short_of_signatures(self, known: DataFrame) -> DataFrame:
        """Sets that cannot spare their frequent signatures, or had too few from the start."""
        left_out = (known.filter(F.col("c") > FREQUENT).groupBy("node", "aux").agg(F.count("*").alias("k"))
                    .filter("k > aux div 64").select("node"))
        return stored(left_out.unionAll(self.short).distinct(), "jaccard-short")

    def _second_level(self, short: DataFrame) -> None:
        """Segments of one shingle each: every short set looks up its H + 1 rarest shingles among all short sets."""
        if short.isEmpty():
            return
        tokens = self._texts(short).mapInPandas(_tokens, "token long, node long").distinct()
        counted = tokens.withColumn("c", F.count("*").over(W.partitionBy("token"))).filter("c > 1")
        sized = stored(self._comp(counted.join(self.nodes.select("node", "n"), "node"), "node", "comp"), "jaccard-tokens")
        # Shingles nobody else has are the rarest ones; only what remains of the H + 1 is looked up.
        rarest = W.partitionBy("node").orderBy("c", "token")
        alone = F.col("n") - F.count("*").over(W.partitionBy("node"))
        bound = F.floor((F.col("n") + F.floor(F.col("n") * DEN / NUM)) * (DEN - NUM) / (DEN + NUM)) + 1
        picks = (sized.withColumn("left_over", F.col("n") - (F.row_number().over(rarest) + alone) + 1)
                 .filter(F.col("n") - F.col("left_over") < bound))
        side = lambda name: picks.select("token", F.col("node").alias(name), F.col("comp").alias(f"c{name}"),
                                         F.col("n").alias(f"n{name}"), F.col("left_over").alias(f"l{name}"))
        # At the first shingle of the common order that both have, no more can be common than both have left over.
        enough = F.least("la", "lb") * (DEN + NUM) >= (F.col("na") + F.col("nb")) * NUM
        pairs = side("a").join(side("b"), "token").filter(F.expr("a < b and ca != cb") & enough).select("a", "b").distinct()
        self._verify(self._plausible(pairs))
        discard(sized)

    def result(self, doc_id: str = "doc_id") -> DataFrame:
        """doc_id, n_shingles, component_id per document."""
        rows = self._comp(self.rows.select("id", "node", "n"), "node", "comp")
        smallest = rows.filter("n > 0").groupBy("comp").agg(F.min("id").alias("component_id"))
        out = rows.join(smallest, "comp", "left")
        return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                          F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def link_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every document."""
    return JaccardJoin(docs, doc_id=doc_id, text=text).run().result(doc_id)
