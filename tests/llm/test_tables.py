"""Operators on whole tables against brute force: line dedup, mixing, neighbours, Jaccard links, URL rules, pipeline."""

import collections
import hashlib
import itertools
import random
import re
import time
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import common, jaccard_join, line_dedup, source_mix, url_rules, vptree
from tests.comparison import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_line_dedup", "op8_jaccard_join", "op9_source_mix"])
def test_query_equals_its_sql(spark, name):
    from riskloom.llm.queries import QUERIES

    assert difference(QUERIES[name].run(spark, SF_DIR), QUERIES[name].oracle, connect(SF_DIR)) is None


# Line dedup

def _plain_dedup(texts, counted, min_docs):
    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
    counts = collections.Counter(k for t in counted for k in {key(x) for x in (t or "").split("\n")} if k)
    return ["\n".join(x for x in (t or "").split("\n") if counts[key(x)] < min_docs) for t in texts]


def _cleaned(index, frame):
    return [r.text for r in index.clean(frame).orderBy("doc_id").collect()]


LINES = [None, "", "  Menu \nbody one", "menu\nbody two\nMENU", "\tMENU\x0b\nbody", "other\r\n\nx", "menu\nbody two\nMENU", "y\n" * 30_000]


def test_line_dedup_is_reversible(spark, docs, clash, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 1)
    base, more = docs(LINES), docs(["menu\nnew line", "new line\nbody", "y\nnew line"], start=100)
    index = line_dedup.LineIndex.build(clash(base), min_docs=3)
    assert _cleaned(index, clash(base)) == _plain_dedup(LINES, LINES, 3)
    grown = index.add(more)
    all_texts = LINES + [r.text for r in more.collect()]
    assert _cleaned(grown, base) == _plain_dedup(LINES, all_texts, 3)
    back = grown.remove(more)
    assert _cleaned(back, base) == _plain_dedup(LINES, LINES, 3)
    less = back.remove(base.filter("doc_id = 3"))
    assert _cleaned(less, base) == _plain_dedup(LINES, LINES[:3] + LINES[4:], 3)
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_index_grows_from_nothing(spark, docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 400)
    index, texts, shards = line_dedup.LineIndex.build(docs([]), min_docs=2), [], set()
    for step, n in enumerate((30, 270, 900)):
        more = [f"line {step} {i}\nown {step} {i} {j}" for i in range(n) for j in range(2)]
        index = index.add(docs(more, start=len(texts)))
        texts += more
        shards.add(index.shards)
        held = index.filters.collect()
        assert sum(np.count_nonzero(np.frombuffer(r.prints, np.uint16)) for r in held) <= 30 + 270 + 900
    assert len(shards) > 1
    assert _cleaned(index, docs(texts)) == _plain_dedup(texts, texts, 2)
    gone = texts[:400]
    less = index.remove(docs(gone))
    assert _cleaned(less, docs(texts)) == _plain_dedup(texts, texts[400:], 2)
    with pytest.raises(ValueError):
        less.remove(docs(gone))


def test_filters_in_rounds_find_the_same(spark, docs, monkeypatch):
    texts = [f"common {i % 40}\nown {i}" for i in range(200)]
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 10)
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", 1)
    assert _cleaned(line_dedup.LineIndex.build(docs(texts), min_docs=5), docs(texts)) == _plain_dedup(texts, texts, 5)


def test_cuckoo_filter_has_no_false_negatives_and_deletes():
    hashes = np.random.default_rng(1).integers(0, 2 ** 64, 20_000, np.uint64)
    cuckoo = line_dedup.CuckooFilter.load(line_dedup.CuckooFilter.of(hashes).dump())
    assert cuckoo.contains(hashes).all()
    others = np.random.default_rng(2).integers(0, 2 ** 64, 20_000, np.uint64)
    assert cuckoo.contains(others).mean() < 0.001
    assert all(cuckoo.delete(h) for h in hashes[:10_000])
    assert cuckoo.contains(hashes[10_000:]).all() and cuckoo.contains(hashes[:10_000]).mean() < 0.01


# Mixing

def test_flow_is_cheapest_of_all():
    """Overlapping sources: the same amount as, and no dearer than, the best of all integer flows."""
    rnd = random.Random(3)
    for _ in range(25):
        sizes = {("a",): rnd.randint(0, 2), ("a", "b"): rnd.randint(0, 2), ("b", "c"): rnd.randint(0, 2)}
        quotas = {"a": rnd.randint(0, 4), "b": rnd.randint(0, 4), "c": rnd.randint(0, 3)}
        flow = source_mix.route(sizes, quotas, 2)
        edges = [(p, s) for p in sizes for s in p]

        def cost(amounts):
            used = {p: sum(n for (q, _), n in amounts.items() if q == p) for p in sizes}
            got = {s: sum(n for (_, t), n in amounts.items() if t == s) for s in quotas}
            if any(used[p] > 2 * sizes[p] for p in sizes) or any(got[s] > quotas[s] for s in quotas):
                return None
            return -sum(used.values()), sum(max(0, used[p] - sizes[p]) for p in sizes)

        every = (cost(dict(zip(edges, c))) for c in itertools.product(range(5), repeat=len(edges)))
        assert cost({e: flow.get(e, 0) for e in edges}) == min(c for c in every if c is not None)


def test_mix_hits_targets_and_reruns_agree(spark, clash):
    rows = [(i, f"s{i % 3}" if i % 11 else None, "w " * (1 + i % 13)) for i in range(900)] + [(5000, "s0", None), (5001, "s9", ""), (1, "s1", "w w")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    uses, plan = source_mix.mix(clash(frame))
    first = uses.select("doc_id", "source", "mix_size", "mix_uses").collect()
    again = source_mix.mix(clash(frame.repartition(7)))[0].select("doc_id", "source", "mix_size", "mix_uses").collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    taken = collections.Counter()
    for r in first:
        taken[r.source] += r.mix_size * r.mix_uses
        assert r.mix_uses <= 3
    for source, target in plan.targets.items():
        assert abs(taken[source] - target) <= 13
    assert abs(sum(plan.targets.values()) - sum(plan.pattern_sizes.values())) < 1e-6
    assert source_mix.mix(frame.limit(0))[0].count() == 0
    mixed = source_mix.mixed_documents(frame)
    assert mixed.columns == frame.columns and mixed.count() == sum(r.mix_uses for r in first if r.mix_size)


@pytest.mark.parametrize("ids, size, extra", [([7] * 1000, 2, 1000), ([None] * 300, 2, 1200), ([5] * 400 + list(range(400)), 3, 700)])
def test_mix_decides_rows_of_one_id_one_by_one(spark, ids, size, extra):
    rows = [(i, "a", "w " * size) for i in ids] + [(10_000 + i, "b", "w " * 4) for i in range(extra // 4)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    uses, plan = source_mix.mix(frame)
    taken = {r.source: r.t for r in uses.groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_uses")).alias("t")).collect()}
    for source, target in plan.targets.items():
        assert abs(taken[source] - target) <= 4
    mixed = source_mix.mixed_documents(frame.withColumn("mix_size", F.lit("x")))
    assert mixed.columns == [*frame.columns, "mix_size"]
    words = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w"))).alias("n")).collect()}
    assert words == taken


def test_overlapping_membership(spark):
    frame = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["a"], "w w") for i in range(100)], "doc_id long, sets array<string>, text string")
    uses, plan = source_mix.mix(frame, sources=F.col("sets"), weigh=lambda s: {"a": 1.0, "b": 1.0})
    assert set(plan.flows) == {(("a",), "a"), (("a", "b"), "a"), (("a", "b"), "b")}
    assert sum(r.mix_size * r.mix_uses for r in uses.collect()) == sum(plan.taken.values())


# Neighbours

def _plain_neighbours(rows, k):
    rows = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q, x in rows:
        if q % 50 == 0:
            near = sorted(((-vptree._scores(x, y[None])[0], i) for i, y in rows if i != q and len(y) == len(x)))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


def test_search_is_exact_at_factor_one_and_good_below(spark, clash):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(size=16) * 0.3]) for i in range(1500)]
    rows += [(i, [1.0] * 16) for i in range(2000, 2300)] + [(3000, None), (3050, [0.0] * 16), (3100, [1.0] * 15 + [None]), (3150, [float("nan")] * 16), (3200, [1.0, 2.0])]
    frame = clash(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    index = vptree.VpIndex.build(frame, shard_rows=300)
    queries = frame.filter("vec_id % 50 = 0")
    want = _plain_neighbours(rows, 5)
    got = sorted(tuple(r) for r in index.search(queries, k=5).collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert max(abs(g[3] - w[3]) for g, w in zip(got, want)) < 1e-12
    relaxed = {tuple(r)[::2] for r in index.search(queries, k=5, relax=0.7).select("query_id", "rank", "vec_id").collect()}
    assert len(relaxed & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)
    assert vptree.VpIndex.build(frame.limit(0)).search(queries.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["scaled", "noisy", "opposite"])
def test_search_is_exact_among_nearly_equal_vectors(kind):
    rng = np.random.default_rng(len(kind))
    base = rng.normal(size=(40, 64))
    own = base[rng.integers(0, 40, 500)]
    change = {"scaled": own * rng.uniform(0.1, 9, (500, 1)), "noisy": own + rng.normal(size=own.shape) * 1e-9,
              "opposite": own * rng.choice([-1.0, 1.0], (500, 1))}[kind]
    ids = np.arange(500)
    tree = vptree.VpTree(ids, change)
    found = tree.search(ids, change, 5, 1.0)
    for i in range(500):
        scores = vptree._scores(change[i], change)
        best = [j for j in np.lexsort((ids, -scores)).tolist() if j != i][:5]
        assert [j for _, j in found[i]] == best, i


# Jaccard links

def _plain_links(rows):
    sets, holders, parent = {}, collections.defaultdict(list), {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = collections.Counter(j for s in sets[i] for j in holders[s])
        for s in sets[i]:
            holders[s].append(i)
        for j, k in common.items():
            if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def _near_copies(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    bases = [[rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 7, 9, 10, 12, 16, 20, 25, 30, 60, 120]))] for _ in range(n // 40)]
    shared = [rnd.choice(vocab) for _ in range(25)]
    out = []
    for i in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            k = rnd.randrange(len(words))
            words[k:k + 1] = rnd.choice([[], [rnd.choice(vocab)], [words[k], rnd.choice(vocab)]]) or [words[k]]
        if rnd.random() < 0.3:
            words[len(words) // 2:len(words) // 2] = shared
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("frequent", [3, 32])
def test_links_equal_brute_force(spark, clash, monkeypatch, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rows = _near_copies(frequent, 600) + [(9000, None), (9001, ""), (9002, " \n"), (9003, "A b"), (9004, "a  B"), (9005, "x " * 40_000)]
    frame = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_documents(frame).collect()}
    assert got == _plain_links(rows)


def test_pipeline_keeps_one_row_of_a_group_whatever_its_id(spark):
    long, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(3, long), (3, long), (2, long + " end"), (None, long), (None, other), (None, other), (9, other), (5, ""), (5, ""), (None, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, frame, SF_DIR).collect()]
    assert collections.Counter(kept) == collections.Counter([(2, long + " end"), (9, other), (5, ""), (5, ""), (None, "")])


def test_signatures_are_sent_packed_and_whole(monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_SIGNATURES", 5_000)
    rows = pd.DataFrame(_near_copies(5, 600), columns=["id", "t"])
    sent = pd.concat(list(jaccard_join._signed(iter([rows[:250], rows[250:]]), 7)))
    packs = sent[sent.part == jaccard_join.SIGNATURES]
    wanted, holders = collections.Counter(), collections.defaultdict(set)
    for i, t in zip(rows.id, rows.t):
        tokens = jaccard_join.shingles(t)
        for band, sigs, slack in jaccard_join.signatures(tokens):
            for sig in sigs:
                holders[int(sig)].add(i)
                wanted[int(sig), jaccard_join._node(tokens), 64 * max(slack, 0) + band] += 1
    # Before, a signature and the name of its set took 8 bytes each, its band and slack 4 more.
    assert packs.packed.map(len).sum() == 8 * sum(wanted.values()) and sent.chunk.nunique() > 1
    types = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("packed", pa.binary()), ("id", pa.int64()),
                       ("node", pa.int64()), ("n", pa.int64()), ("short", pa.bool_()), ("bits", pa.binary())])
    met = [jaccard_join._shared(pa.Table.from_pandas(g, types, preserve_index=False)).to_pandas() for _, g in sent.groupby("bucket")]
    met = pd.concat(met)
    assert (met.part == jaccard_join.DOCUMENT).sum() == 600
    mask, got = (1 << 48) - 1, collections.Counter()
    for _, g in met[met.part != jaccard_join.DOCUMENT].groupby("chunk"):
        columns = types.remove(8).remove(7).remove(6).remove(5).remove(4)
        named = jaccard_join._named(pa.Table.from_pandas(g[columns.names], columns, preserve_index=False)).to_pandas()
        got.update((s & mask, n, a) for s, n, a in named.itertuples(index=False))
    expected = collections.Counter()
    for (sig, node, aux), k in wanted.items():
        if len(holders[sig]) > 1:
            expected[sig & mask, node, aux] += k
    assert got == expected


def test_join_leaves_no_large_tables_and_no_shuffle_files(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "work_folder", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    rows = [t for _, t in _near_copies(5, 60)]
    frame = common.stored(docs(rows), "docs")
    files = disk.getAllFiles().size()
    linked = common.stored(jaccard_join.link_documents(frame), "linked")
    left = {path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir()}
    assert left <= {"docs", "linked", "ids", "labels", "jaccard-rows", "jaccard-nodes", "jaccard-short"}
    for _ in range(100):                      # Spark removes the files of a write soon after it
        if disk.getAllFiles().size() <= files:
            break
        time.sleep(0.1)
    assert disk.getAllFiles().size() <= files
    assert linked.count() == len(rows) and spark.conf.get(common.SHUFFLE_CLEANUP) == "false"


def test_copies_in_a_chunk_are_named_once():
    rows = pd.DataFrame([(i, "one two three four five six seven eight nine ten " * 3) for i in range(20)], columns=["id", "t"])
    sent = pd.concat(list(jaccard_join._signed(iter([rows]), 7)))
    types = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("packed", pa.binary())])
    chunk = pa.Table.from_pandas(sent[sent.part != jaccard_join.DOCUMENT][types.names], types, preserve_index=False)
    every, once = jaccard_join._named(chunk), jaccard_join._named_once(chunk)
    assert once.schema == every.schema and every.num_rows == 20 * once.num_rows
    assert set(zip(*once.to_pydict().values())) == set(zip(*every.to_pydict().values()))


def test_chunks_of_signatures_stay_small():
    texts = [" ".join(f"w{i}x{j}" for j in range(9_000)) for i in range(80)]
    sent = pd.concat(list(jaccard_join._signed(iter([pd.DataFrame({"id": range(80), "t": texts})]), 16)))
    packed = sent[sent.part == jaccard_join.SIGNATURES].groupby("chunk").packed.agg(lambda p: p.map(len).sum())
    assert packed.sum() > 3_500_000 and packed.max() < 3_500_000     # a worker holds several times that


def test_no_documents_no_links(spark, docs):
    assert jaccard_join.link_documents(docs([])).count() == 0


# URL rules

RULES = [url_rules.HostRule("block", "net/"), url_rules.HostRule("allow", "example.net/en/"),
         url_rules.HostRule("block", "example.com/de/"), url_rules.HostRule("allow", "org/fr/")]
URLS = [None, "", "no scheme", "http://A.Example.NET/en/1?x#y", "https://example.net", "https://example.net/de/", "http://notexample.com/de/1",
        "http://example.com/de/1", "http://x.example.com/de", "ftp://a.org/fr/", "://b.org/fr/x", "http://a.org?u=http://b.net/", "http://net/x", "http://a.net/" + "p/" * 30_000]


def _plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.sub("[A-Z]", lambda m: m.group().lower(), re.match("[^/?#]*", rest).group())
    path = re.match("[^?#]*", rest[len(host):]).group()
    fits = [r.text for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=len, default=None)


def test_host_rules_equal_brute_force(spark, clash):
    frame = clash(spark.createDataFrame(list(enumerate(URLS)) + [(0, None)], "page_id long, url string"))
    rows = url_rules.judge(frame, RULES).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        assert (r.host, r.path, r.rule) == _plain_rule(URLS[r.page_id])
        if r.rule:
            assert r.verdict == next(x.verdict for x in RULES if x.text == r.rule)
    assert {r.verdict for r in rows if r.page_id < 3} == {"allow"}
    assert url_rules.judge(frame.limit(0), RULES).count() == 0


def test_mined_rules_equal_all_combinations(spark):
    rnd = random.Random(4)
    data = [(sorted(rnd.sample("abcdef", rnd.randint(1, 4))),) for _ in range(200)]
    data = [(t, "block" if "a" in t and "b" in t or rnd.random() < 0.1 else "allow") for (t,) in data]
    rules, classes = url_rules.mine_rules(spark.createDataFrame(data, "tokens array<string>, verdict string"), min_rows=4, min_confidence=0.7)
    got = {tuple(r.tokens) for r in rules.collect()}
    assert all(r["token"] == r["class"] for r in classes.collect())
    sure = {}
    for size in range(1, 5):
        for combo in itertools.combinations("abcdef", size):
            own = [v for t, v in data if set(combo) <= set(t)]
            blocked = own.count("block")
            if own and blocked >= 0.02 * len(data) and blocked >= 0.7 * len(own):
                sure[combo] = blocked / len(own)
    want = {c for c, s in sure.items() if not any(set(d) < set(c) and sure[d] >= s for d in sure)}
    assert got == want and ("a", "b") in got


def test_repeated_long_urls_and_rare_hosts_are_learned(spark):
    words = "/".join(f"word{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(8))
    rows = [(i, f"http://long.example/{words}") for i in range(60)]                    # forty words, always together
    rows += [(100 + i, f"http://ok.example/{'news' if i % 2 else 'blog'}/x{chr(97 + i % 20)}") for i in range(6_000)]
    rows += [(9_000 + i, f"http://rare.example/{chr(97 + i % 20)}{chr(97 + i // 20)}") for i in range(55)]   # under one in a hundred
    new = [(20_000, "http://else.example/wordaa"), (20_001, "http://rare.example/new"), (20_002, "http://ok.example/news/new")]
    bad = [i for i, u in rows if "ok." not in u]
    labels = spark.createDataFrame([(i, "block" if i in set(bad) else "allow") for i, _ in rows], "page_id long, verdict string")
    frame = spark.createDataFrame(rows + new, "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(frame, RULES, labels).collect()}
    assert {verdicts[i] for i in bad} == {"block"} and {verdicts[i] for i, u in rows if "ok." in u} == {"allow"}
    assert [verdicts[i] for i, _ in new] == ["block", "block", "allow"]


# Pipeline

def test_pipeline_stages_against_brute_force(spark):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept, stages = frame, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_copies", "mix_sources", "byte_bpe"]
    for name, stage in list(stages.items())[:-1]:
        before = {r.doc_id: r for r in kept.collect()}
        kept = stage(spark, kept, SF_DIR).cache()
        assert kept.columns == frame.columns
        after = collections.Counter(r.doc_id for r in kept.collect())
        texts = {r.doc_id: r.text for r in kept.collect()}
        if name == "line_dedup":
            ids = sorted(before)
            plain = _plain_dedup([before[i].text for i in ids], [before[i].text for i in ids], 10)
            assert texts == dict(zip(ids, plain))
        elif name == "near_copies":
            assert set(after) == {i for i, (_, c) in _plain_links([(i, r.text) for i, r in before.items()]).items() if c == i}
        elif name == "mix_sources":
            uses = {r.doc_id: r.mix_uses for r in source_mix.mix(spark.createDataFrame(list(before.values()), frame.schema))[0].collect()}
            assert after == collections.Counter({i: n for i, n in uses.items() if n})
    out = corpus_pipeline.encode(spark, kept, SF_DIR).collect()
    assert len(out) == kept.count() and all(r.round_trip for r in out)
    assert all(re.fullmatch("[0-9a-f]{64}", r.ids_sha256) for r in out) and hashlib.sha256(b"").hexdigest()
