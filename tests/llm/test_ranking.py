"""Top-k search, lexical ranking and hard negatives against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import maxscore, pair_bounds, zone_negatives
from riskloom.llm.queries import QUERIES
from tests.comparison import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("name", ["op11_maxscore", "op12_pair_bounds", "op13_zone_negatives"])
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name].run(spark, SF_DIR), QUERIES[name].oracle, connect(SF_DIR)) is None


def _rows(seed, n, dims, distinct=40):
    """Vectors with many ties, zeros, equal and opposite ones; some rows repeat, some are unusable."""
    rnd = random.Random(seed)
    pool = [[rnd.choice([0.0, 0.0, rnd.uniform(-1, 1), 0.25]) for _ in range(dims)] for _ in range(distinct)]
    pool += [[-x for x in v] for v in pool[:10]] + [[0.0] * dims]
    rows = [(i, rnd.choice(pool), rnd.randrange(3)) for i in range(n)]
    bad = [(None, pool[0], 1), (n, None, 1), (n + 1, [float("nan")] * dims, 1), (n + 2, [float("inf")] * dims, 1),
           (n + 3, [None] + [0.5] * (dims - 1), 1), (n + 4, pool[0], None), (n + 5, [0.5], 1), (n + 50, [], 1)]
    return rows + rows[:20] + bad


def _whole(rows):
    usable = [(i, tuple(math.floor(256 * x) for x in v), c) for i, v, c in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return sorted(set((i, v) for i, v, _ in usable)), sorted(set((i, v, c) for i, v, c in usable if c is not None))


def _dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def _by_search(rows, k, every):
    whole, _ = _whole(rows)
    out = []
    for own in sorted({i for i, _ in whole if i % every == 0}):
        query = min((len(v), v) for i, v in whole if i == own)[1]
        found = sorted((-_dot(query, v), i) for i, v in whole if i != own and len(v) == len(query))[:k]
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return out


@pytest.mark.parametrize("dims", [1, 12])
def test_maxscore_finds_what_brute_force_finds(spark, clash, dims):
    rows = _rows(dims, 300, dims) + [(50, [-1.0] * dims, 0)]
    frame = clash(spark.createDataFrame(rows, SCHEMA))
    found = maxscore.MaxScoreIndex.build(frame, shard_rows=60, window=16).search(frame.filter("vec_id % 10 = 0"), k=5, query_block=7)
    assert sorted(map(tuple, found.collect())) == _by_search(rows, 5, 10)


def test_maxscore_leaves_postings_untouched():
    rnd = np.random.default_rng(5)
    held = rnd.random((4_000, 60)) < 0.1
    vectors = np.where(held, rnd.integers(1, 40, held.shape), 0)
    vectors[np.arange(4_000), rnd.integers(0, 4, 4_000)] = rnd.integers(500, 1_000, 4_000)   # a few heavy terms
    index = maxscore.Postings(np.arange(4_000), vectors)
    query = vectors[17]
    found = index.search(17, query, 5)
    assert found == sorted(((int(s), i) for i, s in enumerate(vectors @ query) if i != 17), key=lambda x: (-x[0], x[1]))[:5]
    assert index.traversed < (vectors[:, query > 0] > 0).sum()


def test_maxscore_of_few_and_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert maxscore.MaxScoreIndex.build(empty).search(empty).count() == 0
    two = spark.createDataFrame([(0, [1.0], 0), (1, [-1.0], 0)], SCHEMA)
    assert [tuple(r) for r in maxscore.MaxScoreIndex.build(two).search(two.filter("vec_id = 0")).collect()] == [(0, 1, 1, -65536)]
    with pytest.raises(ValueError):
        maxscore.exact_type(4, 1 << 31, 1 << 31)


# Lexical ranking

def _ranked(docs, items, k):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    held = [(doc, collections.Counter(words(t)), len(words(t))) for doc, t in docs if words(t)]
    n, size = len(held), sum(x[2] for x in held)
    df = collections.Counter(t for _, counts, _ in held for t in counts)
    out = []
    texts = {}
    for item, text in items:
        if item is not None:
            texts[item] = min([x for x in (texts.get(item), text) if x is not None], default=None)
    for item, text in texts.items():
        scores = []
        for doc, counts, length in held:
            m = 100 - 25 + (25 * length * n) // size
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                        for t in words(text) if t in counts)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out


def test_ranking_equals_brute_force(spark, clash):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "naïve", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: rnd.choice([" ", "-", "_\n"]).join(rnd.choices(vocabulary, weights, k=n))
    docs = [(i, text(rnd.randint(1, 60))) for i in range(400)]
    docs += docs[:30] + [(i + 500, docs[3][1]) for i in range(50)] + [(None, docs[3][1]), (900, None), (901, ""), (902, "-- !"),
                                                                     (903, "W1 " * 20_000)]
    items = [(i, text(rnd.randint(1, 30))) for i in range(25)]
    items += [(30, docs[3][1]), (31, None), (32, "unknown words only"), (33, ""), (34, "w1"), (34, "w2"), (None, "w1")]
    frame = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    asked = clash(spark.createDataFrame(items, "item_id long, text string"))
    expected = sorted(_ranked(docs, items, 7), key=str)
    for chars in (pair_bounds.ITEM_CHARS, 700):       # asked together and in blocks
        found = pair_bounds.rank_documents(frame, asked, k=7, item_chars=chars, chunk_docs=16)
        assert sorted(map(tuple, found.collect()), key=str) == expected
    assert pair_bounds.rank_documents(frame.limit(0), asked).count() == 0
    assert pair_bounds.rank_documents(frame, asked.limit(0)).count() == 0


def test_pair_bounds_hold_and_are_tighter():
    rnd = random.Random(3)
    rare = [f"r{i}" for i in range(20)]
    docs = [" ".join(rnd.choices(["a", "b", "c"], k=20) + [rnd.choice(rare)] * rnd.randint(1, 3)) for _ in range(500)]
    items = pair_bounds.Items([(0, " ".join(rare[:6] + rare[:2] + ["a"]))])
    import pandas as pd

    batch = pd.DataFrame({"id": range(500), "lacks": False, "t": docs})
    row = next(pair_bounds._chunks(iter([batch]), items.vocabulary))
    weights = [1000 + i for i in range(len(items.vocabulary))]
    held = items.order(weights)[0]
    index = pair_bounds.PairIndex(row.chunk[0], 500, 11_000, weights, pair_bounds.neighbours({0: held}))
    bounds, alone = index.bounds(held), np.cumsum([0] + [n * index.top[t] for t, n in held])
    assert bounds[-1] < alone[-1]
    for i in range(len(held) + 1):
        sums = np.zeros(500, np.int64)
        for term, n in held[:i]:
            places, score = index.lists[term]
            sums[places] += n * score
        assert sums.max(initial=0) <= bounds[i] <= alone[i]
    best = index.search(held, 3, None)
    before = index.traversed
    again = index.search(held, 3, (best[0] + 10 ** 12, best[1], best[2]))
    assert index.traversed == before and (again[2] == best[2]).all()      # the whole chunk is skipped


# Hard negatives

def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = zone_negatives.hilbert(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1)
        assert (steps == 1).all()


def test_intervals_hold_every_product():
    rnd = np.random.default_rng(2)
    block, anchors = rnd.integers(-50, 50, (40, 6)), rnd.integers(-50, 50, (9, 6))
    least, most = zone_negatives.intervals(anchors, block.min(0)[None], block.max(0)[None])
    products = anchors @ block.T
    assert (least[:, 0] <= products.min(1)).all() and (products.max(1) <= most[:, 0]).all()


def _negatives(rows, every, positives, negatives):
    _, whole = _whole(rows)
    out = []
    for own in sorted({i for i, _, _ in whole if i % every == 0}):
        label, _, anchor = min((c, len(v), v) for i, v, c in whole if i == own)
        others = [(-_dot(anchor, v), i, c) for i, v, c in whole if i != own and len(v) == len(anchor)]
        for s, i, _ in sorted(x for x in others if x[2] == label)[:positives]:
            fits = sorted((t, j) for t, j, c in others if c != label and 30 * -s <= 100 * -t <= 90 * -s)[:negatives]
            out += [(own, i, rank, j, -s, -t) for rank, (t, j) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("dims", [2, 10])
def test_negatives_equal_brute_force(spark, clash, dims):
    rows = _rows(dims + 20, 260, dims) + [(10, [1.0] * dims, 2), (20, [-0.5] * dims, 1)]
    rows += [(1_000 + i, rows[7][1], 2) for i in range(120)]          # one vector in many rows
    frame = clash(spark.createDataFrame(rows, SCHEMA))
    found = zone_negatives.mine(frame, F.col("id") % 10 == 0, positives=3, negatives=4, segment_rows=50, block_rows=8)
    assert sorted(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) \
        == _negatives(rows, 10, 3, 4)


def test_no_vectors_no_negatives(spark):
    assert zone_negatives.mine(spark.createDataFrame([], SCHEMA), F.col("id") % 2 == 0).count() == 0


def test_zone_maps_spare_far_segments(spark):
    rnd = random.Random(9)
    rows = [(i, [(4.0 if i % 2 else -4.0) + rnd.random() for _ in range(6)], i % 3) for i in range(400)]
    zoned = zone_negatives.ZonedVectors.build(spark.createDataFrame(rows, SCHEMA), segment_rows=40)
    anchors = zoned.rows.filter("id = 1").selectExpr("id as anchor", "label", "dim", "v", "segment")
    high = F.array(F.struct(F.lit(0).alias("win"), F.lit(1_000).cast("long").alias("low"),
                            F.lit(1 << 40).cast("long").alias("high"))).cast(zone_negatives.WINDOWS)
    reached = zoned._reached(anchors.withColumn("asked", high), same_label=False).count()
    assert 0 < reached <= zoned.zones.count() // 2
