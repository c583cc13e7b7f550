"""URL filters: explicit host/path rules, and association rules mined from labelled URLs.

Explicit rules decide where they fit.  For the rest, FP-growth mines token combinations from labelled
URLs; combinations that imply the block label with enough support (a number of URLs) and confidence become
rules, a rule that is no surer than a shorter one inside it is pruned, and an inverted index (rarest token -> rule)
matches them against the URLs.  Tokens that are in just the same labelled URLs are one item there, so a long
URL that is repeated makes no combinations of its own words.

Defined results: a missing URL or one without `://` has an empty host and path, fits no rule and is
allowed; equal URLs are judged equally; without labels or frequent combinations everything else is
allowed; an empty table gives an empty one; other columns are kept, but for those named like a result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, stored

BLOCK, ALLOW = "block", "allow"
LABEL = "label="
MAX_HOST_RULES = 1_000    # explicit rules become one expression
MIN_ROWS = 50             # labelled URLs a rule needs, however many there are in all
SENT_ROWS = 200_000       # rows sent to every task at most


@dataclass(frozen=True)
class HostRule:
    verdict: str
    text: str             # host, then the path from its first slash on

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: list[HostRule], host: Column, path: Column) -> Column:
    """Text of the longest rule that fits, else null."""
    if len(rules) > MAX_HOST_RULES:
        raise ValueError(f"more than {MAX_HOST_RULES} host rules")
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        own = F.lit(rule.host)
        fits = ((host == own) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, rule.text).otherwise(out)
    return out


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: the host's labels and the path's words; numbers count as one token."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    words = F.transform(F.split(ascii_lower(path), r"[^\p{L}\p{N}]+"),
                        lambda x: F.when(x.rlike(r"^\p{N}+$"), F.lit("p:#")).otherwise(F.concat(F.lit("p:"), x)))
    return F.array_sort(F.array_distinct(F.filter(F.concat(labels, words), lambda x: F.char_length(x) > 2)))


def sent_if_small(rows: DataFrame) -> DataFrame:
    """Stored rows: up to SENT_ROWS of them go to every task, more are joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def always_together(baskets: DataFrame, min_rows: int) -> DataFrame:
    """(token, class) of the tokens in at least `min_rows` baskets (row, tokens).

    Tokens that are in just the same baskets are one class, named by the least of them: they would make every
    combination of themselves frequent, and all would say the same.  Equal baskets are told by count and two hash sums.
    """
    seen = baskets.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"),
        F.sum(F.xxhash64(F.lit(1), "row").cast("decimal(38,0)")).alias("s")).filter(F.col("n") >= min_rows)
    first = seen.groupBy("n", "x", "s").agg(F.min("token").alias("class"))
    return seen.join(first, ["n", "x", "s"]).select("token", "class")


def mine_rules(labelled: DataFrame, *, min_rows: int = MIN_ROWS, min_confidence: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Block rules (tokens, confidence, support) from rows (tokens, verdict), over classes of tokens; and the classes."""
    rows = stored(labelled.filter(F.size("tokens") > 0).select("tokens", "verdict", F.monotonically_increasing_id().alias("row")), "url-labelled")
    classes = stored(always_together(rows, min_rows), "url-classes")
    kept = (rows.select("row", "verdict", F.explode("tokens").alias("token")).join(sent_if_small(classes), "token")
            .groupBy("row", "verdict").agg(F.collect_set("class").alias("tokens")))     # a row's own tokens
    baskets = stored(kept.select(F.concat("tokens", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items")), "url-baskets")
    support = min(1.0, min_rows / max(1, baskets.count()))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules.filter(F.col("consequent") == F.array(F.lit(LABEL + BLOCK)))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    # A longer rule must be surer than every rule it contains; rules sharing a token meet once.
    parts = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    inner = parts.select(F.col("tokens").alias("less"), F.col("confidence").alias("sure"), "token")
    beaten = (parts.join(inner, "token").filter("size(less) < size(tokens) and sure >= confidence")
              .filter(F.size(F.array_except("less", "tokens")) == 0).select("tokens").distinct())
    return rules.join(beaten, "tokens", "left_anti"), classes


def matching_sets(sets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct token sets (column `tokens`) that hold a token of every class of some rule; found by the rule's rarest class."""
    held = (sets.select("tokens", F.explode("tokens").alias("token")).join(sent_if_small(classes), "token")
            .groupBy("tokens").agg(F.collect_set("class").alias("classes")))
    held = stored(held, "url-sets")
    terms = held.select("tokens", "classes", F.explode("classes").alias("class"))
    counts = terms.groupBy("class").agg(F.count("*").alias("n"))
    keyed = (rules.select(F.col("tokens").alias("rule")).withColumn("class", F.explode("rule")).join(counts, "class")
             .groupBy("rule").agg(F.min_by("class", F.struct("n", "class")).alias("class")))
    return (terms.join(keyed, "class").filter(F.size(F.array_except("rule", "classes")) == 0)
            .select("tokens").distinct())


def judge(urls: DataFrame, host_rules: list[HostRule], labels: DataFrame | None = None, *, url: str = "url",
          key_id: str = "page_id", min_rows: int = MIN_ROWS, min_confidence: float = 0.8) -> DataFrame:
    """Adds host, path, rule, verdict.

    Labels for mining are the verdicts of the explicit rules and, where none fits, `labels`
    (`key_id`, `verdict`), if given.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = urls.withColumns({"host": host, "path": path})
    rows = rows.withColumns({"rule": fitting_rule(host_rules, F.col("host"), F.col("path")),
                             "__tokens": url_tokens(F.col("host"), F.col("path"))})
    verdict_of = F.lit(None).cast("string")
    for rule in host_rules:
        verdict_of = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(verdict_of)
    labelled = rows.select(F.col(key_id).alias("__id"), F.col("__tokens").alias("tokens"), verdict_of.alias("verdict"))
    if labels is not None:
        given = labels.groupBy(F.col(key_id).alias("__id")).agg(F.max("verdict").alias("given"))
        labelled = labelled.join(given, "__id", "left").withColumn("verdict", F.coalesce("verdict", "given"))
    rules, classes = mine_rules(labelled.filter(F.col("verdict").isNotNull()), min_rows=min_rows, min_confidence=min_confidence)
    hit = matching_sets(rows.select(F.col("__tokens").alias("tokens")).distinct(), rules, classes)
    hit = stored(hit.select(F.col("tokens").alias("__tokens"), F.lit(True).alias("__hit")), "url-hits")
    judged = rows.join(sent_if_small(hit), "__tokens", "left")
    verdict = F.coalesce(verdict_of, F.when(F.col("__hit"), BLOCK).otherwise(ALLOW))
    return judged.withColumn("verdict", verdict).select(
        *[c for c in urls.columns if c not in ("host", "path", "rule", "verdict")], "host", "path", "rule", "verdict")
