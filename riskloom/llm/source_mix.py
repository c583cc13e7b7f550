"""Mixing overlapping sources to target weights by min-cost flow.

Documents are counted by membership pattern (the set of sources a document belongs to).  Token
capacity flows from the patterns to the quotas of the sources; the first use of a pattern's words
is free, every repetition costs more than the one before.  Whole documents are then selected in a
seeded order until a pattern's flow is used up.

Defined results: a missing source is a source of its own and comes last; a missing or empty text
has size 0, its document is never taken; every row is a document and decided by itself, also where an
id is repeated or missing (rows alike in id, source and size are interchangeable); an empty table gives
no rows and no flow; further columns are carried along.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, stored, whole_text

# Patterns and sources are summed on the cluster; only their sums reach the driver.
MAX_PATTERNS = 100_000
SEED = "mix-1"


@dataclass(frozen=True)
class Mix:
    """targets: words per source; pattern_sizes, taken: words per pattern; flows: words per (pattern, source)."""

    pattern_sizes: dict
    targets: dict
    taken: dict
    flows: dict


def water_fill(sizes: dict, weights: dict, max_uses: int) -> dict:
    """Share the sum of all sizes by weight; a source stops at `max_uses` times its size, the excess goes to the others."""
    total, weight = sum(sizes.values()), sum(weights[s] for s in sizes)
    targets, capped = {}, 0
    for source in sorted(sizes, key=lambda s: (max_uses * sizes[s] / weights[s], s is None, s or "")):
        level = (total - capped) / weight
        targets[source] = min(float(max_uses * sizes[source]), weights[source] * level)
        if max_uses * sizes[source] < weights[source] * level:
            capped += max_uses * sizes[source]
            weight -= weights[source]
    return targets


def route(pattern_sizes: dict, quotas: dict, max_uses: int) -> dict:
    """Words from each pattern to each of its sources.

    The cost of a pattern's words depends on how often they are used already and grows with every use
    (convex), so shortest augmenting paths are found cost level by cost level: the capacity of one more
    use is opened for all patterns and the flow is made maximal before the next, dearer level opens.
    An augmentation never takes flow back from a pattern, so earlier levels stay optimal.
    """
    patterns = sorted(pattern_sizes, key=lambda p: [(s is None, s or "") for s in p])
    flow = {(p, s): 0 for p in patterns for s in p if s in quotas}
    of_source: dict = {s: [] for s in quotas}
    for p, s in flow:
        of_source[s].append(p)
    used, left = dict.fromkeys(patterns, 0), dict(quotas)
    for level in range(1, max_uses + 1):
        open_now = {p: level * pattern_sizes[p] - used[p] for p in patterns}
        while True:
            # Breadth first from all patterns with capacity to a source with an open quota.
            came: dict = {("p", p): None for p in patterns if open_now[p] > 0}
            queue, end = deque(came), None
            while queue and end is None:
                kind, node = at = queue.popleft()
                if kind == "p":
                    following = [("s", s) for s in node if s in quotas]
                else:
                    following = [("p", p) for p in of_source[node] if flow[p, node] > 0]
                for to in following:
                    if to not in came:
                        came[to] = at
                        queue.append(to)
                        if to[0] == "s" and left[to[1]] > 0:
                            end = to
                            break
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            back = [flow[path[i + 1][1], path[i][1]] for i in range(1, len(path) - 1, 2)]
            amount = min([open_now[path[0][1]], left[end[1]], *back])
            for i in range(0, len(path) - 1):
                if path[i][0] == "p":
                    flow[path[i][1], path[i + 1][1]] += amount
                else:
                    flow[path[i + 1][1], path[i][1]] -= amount
            open_now[path[0][1]] -= amount
            used[path[0][1]] += amount
            left[end[1]] -= amount
    return flow


def plan_mix(pattern_sizes: dict, weigh, max_uses: int) -> Mix:
    """`weigh(sources)` gives each source's weight."""
    sizes: dict = {}
    for pattern, size in pattern_sizes.items():
        for source in pattern:
            sizes[source] = sizes.get(source, 0) + size
    targets = water_fill(sizes, weigh(list(sizes)), max_uses) if sizes else {}
    flows = route(pattern_sizes, {s: int(t + 0.5) for s, t in targets.items()}, max_uses)
    taken = dict.fromkeys(pattern_sizes, 0)
    for (pattern, _), words in flows.items():
        taken[pattern] += words
    return Mix(pattern_sizes, targets, taken, flows)


def cycle_weights(sources: list) -> dict:
    """1, 2, 3, repeating, by code point; a missing source comes last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: float(1 + i % 3) for i, s in enumerate(ordered)}


def mix(docs: DataFrame, *, sources: Column | None = None, weigh=cycle_weights, max_uses: int = 3,
        seed: str = SEED, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> tuple[DataFrame, Mix]:
    """Each row's columns with `mix_size`, `mix_uses` (how often the mix takes the document) and the plan.

    `sources` is an array of the sources a row belongs to; without it the column `source` alone.
    Row columns kept: all of `docs` but the text, with `keep_text` all.  Bounded on the driver: one sum per pattern.
    """
    member = sources if sources is not None else F.array(F.col("source"))
    rest = [c for c in docs.columns if (c != text or keep_text) and c not in ("mix_size", "mix_uses")]
    # __row numbers the stored rows, so that rows alike in everything else are decided one by one.
    sized = stored(docs.select(
        *rest,
        F.regexp_count(whole_text(text), F.lit(WORD)).cast("long").alias("__size"),
        F.array_sort(F.array_distinct(member)).alias("__pattern"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary")).alias("__draw"),
        F.monotonically_increasing_id().alias("__row"),
    ), "mix-sizes")
    sized = sized.withColumns({"__bin": F.substring("__draw", 1, 3), "__key": F.struct("__draw", F.col(doc_id).alias("id"), "__size")})
    sums = sized.groupBy("__pattern").agg(F.sum("__size").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    pattern_sizes = {tuple(r[0]): r[1] for r in sums}
    plan = plan_mix(pattern_sizes, weigh, max_uses)

    # Full uses of every document of a pattern, and the words that remain for one more use of some.
    spark = docs.sparkSession
    quota = spark.createDataFrame(
        [(list(p), plan.taken[p] // n if n else 0, plan.taken[p] % n if n else 0) for p, n in pattern_sizes.items()],
        "__pattern array<string>, __full long, __rest long")
    quota = F.broadcast(quota)  # at most MAX_PATTERNS rows
    cut = F.broadcast(stored(_cut(sized, quota), "mix-cut"))  # one row per pattern
    once_more = (F.col("__rest") > 0) & (
        (F.col("__bin") < F.col("__edge"))
        | ((F.col("__bin") == F.col("__edge")) & (F.col("__key") < F.col("__last")))
        | ((F.col("__key") == F.col("__last")) & (F.col("__row") <= F.col("__last_row"))))
    out = sized.join(quota, "__pattern").join(cut, "__pattern", "left")
    uses = F.col("__full") + F.coalesce(once_more, F.lit(False)).cast("long")
    return out.select(*rest, F.col("__size").alias("mix_size"),
                      F.when(F.col("__size") > 0, uses).otherwise(0).alias("mix_uses")), plan


def _cut(sized: DataFrame, quota: DataFrame) -> DataFrame:
    """Per pattern the last row in draw order that is used once more: its bin, its key and its number.

    Found level by level, so that no task sees all rows of a pattern, nor all that share a key: sums of bins, of
    the keys of one bin, row counts of the partitions that hold one key, the rows of that key in one of them.
    A row is used if the words before it and half its own fit into the remainder, which no later one can then miss.
    """
    def running(value: str, *order: str, within: tuple[str, ...] = ("__pattern",)) -> Column:
        before = W.partitionBy(*within).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    bins = sized.groupBy("__pattern", "__bin").agg(F.sum("__size").alias("n")).withColumn("__start", running("n", "__bin"))
    edge = (bins.join(quota, "__pattern").filter("__start <= __rest and __rest < __start + n")
            .select("__pattern", F.col("__bin").alias("__edge"), "__start", "__rest"))
    inside = sized.join(F.broadcast(edge), "__pattern").filter("__bin = __edge")
    keys = (inside.groupBy("__pattern", "__edge", "__start", "__rest", "__key").agg(F.count("*").alias("copies"))
            .withColumn("words", F.col("copies") * F.col("__key.__size")))
    keys = keys.withColumn("before", F.col("__start") + running("words", "__key"))
    # Of a key's rows, which are of one size, so many fit.
    size = F.col("__key.__size")
    room = F.greatest(2 * (F.col("__rest") - F.col("before")) + size, F.lit(0))
    fitting = F.when(size == 0, F.col("copies")).otherwise(F.least(F.call_function("div", room, 2 * size), F.col("copies")))
    keys = keys.withColumn("fitting", fitting).filter("fitting > 0 and 2 * before <= 2 * __rest")
    last = keys.groupBy("__pattern", "__edge").agg(F.max(F.struct("__key", "fitting")).alias("m")).select(
        "__pattern", "__edge", F.col("m.__key").alias("__last"), F.col("m.fitting").alias("__fit"))
    rows = inside.select("__pattern", "__key", "__row").join(F.broadcast(last), "__pattern").filter("__key = __last")
    rows = rows.withColumn("__part", F.shiftright("__row", 33))
    parts = rows.groupBy("__pattern", "__part").agg(F.count("*").alias("n"), F.first("__fit").alias("__fit"))
    parts = parts.withColumn("done", running("n", "__part")).filter("done < __fit and __fit <= done + n")
    at = rows.drop("__fit").join(F.broadcast(parts.select("__pattern", "__part", "__fit", "done")), ["__pattern", "__part"])
    place = F.row_number().over(W.partitionBy("__pattern").orderBy("__row"))
    last_row = at.withColumn("place", F.col("done") + place).filter("place = __fit").select("__pattern", F.col("__row").alias("__last_row"))
    # A bin in which nothing fits still parts the bins before it from those behind it.
    return edge.select("__pattern", "__edge").join(last.drop("__edge", "__fit"), "__pattern", "left").join(last_row, "__pattern", "left")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every taken document as often as it is used, columns as before."""
    own = {c: f"__own_{c}" for c in ("mix_size", "mix_uses") if c in docs.columns}
    uses, _ = mix(docs.withColumnsRenamed(own), keep_text=True, **options)
    each = uses.filter("mix_uses > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_uses"))))
    return each.drop("mix_size", "mix_uses").withColumnsRenamed({there: c for c, there in own.items()}).select(*docs.columns)
