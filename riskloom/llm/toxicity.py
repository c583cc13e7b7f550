"""Toxicity of deobfuscated text by a noisy-channel decoder and a learned lexicon.

Words written in leetspeak, s p a c e d out or with repeeeated letters, or in several of these ways, are lattices of
possible letters; a written span of any length is one lattice.
A Viterbi search finds the reading that is likeliest under a character 4-gram model of the whole corpus
times the cost of the disguise; the restored words, not the written ones, are scored.  The lexicon holds
words and word beginnings that labelled toxic documents use far more often than clean ones; a score is
the posterior of the label given the entries found.

Defined results: a missing or empty text has no entries and gets the score of a document without any;
how often an entry is repeated does not matter; equal texts get equal scores; rows without a label are
scored but teach nothing; of several labels of one id the toxic one counts; without labelled rows of both kinds every score is 0; an empty table gives an
empty one; other columns are kept and never read for the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import release_model, stored, whole_text, worker_model

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = 27                       # 0 is a word boundary
ORDER = 4
CELLS = SYMBOLS ** ORDER           # bound of the model's size, whatever the corpus
# What a disguise may stand for, and what each step of a disguise costs (negative log probability).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "[": "c", "€": "e", "£": "l", "¥": "y",
    "*": "aeiou", "#": "h", "%": "x", "?": "", "&": "",
}
SUBSTITUTE, INSERT, REPEAT, JOIN, PART = 2.0, 3.0, 1.2, 0.2, 3.0
MAX_LABELLED = 20_000              # labelled rows the lexicon is learned from at most, in a seeded order
MAX_LEXICON = 20_000               # entries kept, best evidence first
MIN_TOXIC = 4                      # toxic training documents an entry needs
MIN_ODDS, MIN_EVIDENCE = 2.5, 6.0  # log odds and log likelihood gain an entry needs
FIRST, LATER, ROUNDS = 0.3, 0.1, 4 # share of the best entry's evidence that is enough in a round; rounds at most
BAR = 0.6                          # share of a spotless entry's weight at which a document counts as toxic
STEMS = (4, 5, 6, 7, 8)            # lengths of word beginnings that can become entries
THRESHOLD = 0.7
LOGIT = math.log(THRESHOLD / (1 - THRESHOLD))
MEMO = 60_000                      # spans, and words, that a worker keeps
MEMO_CHARS = 100                   # a longer span is not kept
GRAM_BLOCK = 1 << 19               # characters whose 4-grams are counted at once
BLOCK = 4_096                      # characters after which the readings of a span are packed into strings

# Three or more letters, digits or leet symbols, each alone or repeated, parted by blanks or punctuation, which may also stand
# around them.
_LETTER = r"[a-z0-9@$!|+(<{\[*#%]"
_SPACED = (rf"(?<!\S)[\"'(\[{{<]{{0,2}}(?P<first>{_LETTER})(?P=first)*+(?:[\s.,;:?'\"\-_/~=)\]}}>]++(?P<next>{_LETTER})(?P=next)*+){{2,}}"
           r"[.,;:?!'\"\-_/~=)\]}>*]*+(?!\S)")
_READABLE = re.compile(r"[a-z0-9@$!|+(<{\[#%]")   # stars alone could be any vowels
_MAYBE_SPACED = re.compile(_SPACED)
_SPAN = re.compile(rf"(?P<spaced>{_SPACED})|(?P<word>\S+)")
_PLAIN = re.compile(r"[a-z]+")
_NOISE = re.compile(r"[a-z][^a-z\s]+[a-z]|[0-9@$!|+*][a-z]|[a-z][0-9@$!|+]|([a-z])\1\1")


def fold(text: str) -> str:
    """Lower case without accents; letters of other scripts vanish."""
    text = text.lower()
    return text if text.isascii() else unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def gram_counts(texts: Iterator[str]) -> np.ndarray:
    """Counts of letter 4-grams; everything between letters is one boundary."""
    code = np.zeros(256, np.uint8)
    code[[ord(c) for c in LETTERS]] = range(1, SYMBOLS)
    total, before, tail = np.zeros(CELLS, np.int64), 0, np.zeros(3, np.int32)
    for block in _blocks(texts):
        symbols = code[np.frombuffer(fold(block).encode(), np.uint8)]
        if not len(symbols):
            continue
        letter = symbols > 0
        letter[1:] |= symbols[:-1] > 0        # letters and the first boundary after one
        letter[0] |= before > 0
        s = np.concatenate([tail, symbols[letter].astype(np.int32)])
        total += np.bincount(((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:], minlength=CELLS)
        before, tail = symbols[-1], s[-3:]
    return total


def _blocks(texts: Iterator[str]) -> Iterator[str]:
    """The texts joined by \\n, and a blank, in blocks of about GRAM_BLOCK characters; long texts are cut."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text)), GRAM_BLOCK):
            held.append(("\n" if i and not start else "") + text[start:start + GRAM_BLOCK])
            size += len(held[-1])
            if size >= GRAM_BLOCK:
                yield "".join(held)
                held, size = [], 0
    yield "".join(held) + " "


class Decoder:
    """Viterbi search over letter lattices; `counts` are 4-gram counts by cell."""

    def __init__(self, counts: np.ndarray):
        grams = counts.reshape(-1, SYMBOLS).astype(np.float64)
        tri = grams.reshape(SYMBOLS, -1, SYMBOLS).sum(0)
        bi = tri.reshape(SYMBOLS, -1, SYMBOLS).sum(0)
        uni = (bi.sum(0) + 1) / (bi.sum() + SYMBOLS)
        # Witten-Bell: a history that is followed by many different letters trusts itself less.
        p = uni
        for table in (bi, tri, grams):
            kinds = (table > 0).sum(1, keepdims=True)
            lower = np.tile(p, (len(table) // max(1, len(p) if p.ndim == 2 else 1), 1)) if p.ndim == 2 else np.tile(p, (len(table), 1))
            p = (table + kinds * lower + 1e-6 * lower) / (table.sum(1, keepdims=True) + kinds + 1e-6)
        self.cost = (-np.log(p)).tolist()
        self.known: dict[str, str] = {}

    def restore(self, span: str) -> str:
        """The likeliest words behind a written span (folded); words are parted by blanks."""
        out = self.known.get(span)
        if out is None:
            out = self._viterbi(span) if _READABLE.search(span) else span
            if len(span) <= MEMO_CHARS:
                if len(self.known) >= MEMO:
                    self.known.clear()
                self.known[span] = out
        return out

    def _viterbi(self, span: str) -> str:
        # State: last three symbols and the last written letter read; value: cost and the reading so far, a chain of
        # (reading before, text added), so that a step costs the same however long the span is.
        cost, square = self.cost, SYMBOLS * SYMBOLS
        states: dict[tuple[int, str], tuple[float, tuple | None]] = {(0, ""): (0.0, None)}
        for at, c in enumerate(span, 1):
            following: dict[tuple[int, str], tuple[float, tuple | None]] = {}
            letter, space = "a" <= c <= "z", c.isspace()
            readings = [(c, ord(c) - 96, 0.0)] if letter else [(x, ord(x) - 96, SUBSTITUTE) for x in LEET.get(c, "")]
            blank = space or not c.isalnum()
            skip = JOIN if space else INSERT / 2 if blank else INSERT
            for (history, last), (so_far, text) in states.items():
                row, moved = cost[history], (history % square) * SYMBOLS
                for x, symbol, extra in readings:
                    key, value = (moved + symbol, x), so_far + extra + row[symbol]
                    old = following.get(key)
                    if old is None or value < old[0]:
                        following[key] = value, (text, x)
                    if x == last:                       # one letter written twice
                        key, value = (history, last), so_far + REPEAT + extra
                        old = following.get(key)
                        if old is None or value < old[0]:
                            following[key] = value, text
                if not letter:
                    key, value = (history, last if blank else ""), so_far + skip   # repeated letters can be spaced, too
                    old = following.get(key)
                    if old is None or value < old[0]:
                        following[key] = value, text
                    if blank and history % SYMBOLS:      # a real end of word
                        key, value = (moved, ""), so_far + PART + row[0]
                        old = following.get(key)
                        if old is None or value < old[0]:
                            following[key] = value, (text, " ")
            # Exact: every state is kept, and a symbol has only a few readings.
            states = following
            if not at % BLOCK:
                states = _packed(states)
        ends = [(value + (cost[history][0] if history % SYMBOLS else 0.0), text) for (history, _), (value, text) in states.items()]
        return _written(min(ends, key=lambda end: end[0])[1]).strip()


def _packed(states: dict) -> dict:
    """The same states; what each has added since the last packing is one string (of two characters or more)."""
    done: dict[int, tuple | None] = {}
    out = {}
    for key, (value, text) in states.items():
        if id(text) not in done:
            parts, node = [], text
            while node is not None and len(node[1]) == 1:
                parts.append(node[1])
                node = node[0]
            done[id(text)] = (node, "".join(reversed(parts))) if parts else node
        out[key] = value, done[id(text)]
    return out


def _written(text: tuple | None) -> str:
    parts = []
    while text is not None:
        text, part = text
        parts.append(part)
    return "".join(reversed(parts))


@dataclass(frozen=True)
class Lexicon:
    """Log odds of each entry, and their sum at which a document is as likely toxic as the threshold says."""

    weights: dict[str, float]
    bar: float
    fitted: bool


def entries_of(word: str) -> list[str]:
    return [word] + [word[:n] + "-" for n in STEMS if len(word) >= n]


def entries(words: set[str]) -> set[str]:
    return {e for w in words for e in entries_of(w)}


def squeezed(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


class Reader:
    """Words of a text after restoring its disguised spans, and the evidence in them."""

    def __init__(self, decoder: Decoder, lexicon: Lexicon | None = None):
        self.decoder = decoder
        self.known = lexicon.weights if lexicon else {}
        self.weight_of: dict[str, float] = {}
        # Doubled letters are natural: such a word is read anew only where its squeezed form begins like an entry's.
        self.doubles: dict[str, str] = {}
        for e in self.known:
            self.doubles.setdefault(squeezed(e.rstrip("-")), e.rstrip("-"))

    def words(self, text: str) -> set[str]:
        folded = fold(text)
        out = set(_PLAIN.findall(folded))
        for span in disguised(folded):
            out.update(self.decoder.restore(span).split())
        return out

    def evidence(self, text: str) -> dict[str, float]:
        """Weight of every word that is an entry or begins with one: the strongest of its entries."""
        weight_of, out = self.weight_of, {}
        for w in self.words(text):
            weight = weight_of.get(w)
            if weight is None:
                if len(weight_of) >= MEMO:
                    weight_of.clear()
                weight = weight_of[w] = self._weight(w)
            if weight:
                out[w] = weight
        return out

    def _weight(self, word: str) -> float:
        s = squeezed(word)
        forms = {word} if s == word else {word} | {self.doubles[s[:n]] + s[n:] for n in range(4, len(s) + 1) if s[:n] in self.doubles}
        return max((self.known[e] for form in forms for e in entries_of(form) if e in self.known), default=0.0)


def disguised(folded: str) -> set[str]:
    """Written spans that may hide a word: single characters in a row, and words with a noise pattern."""
    spans, end = {m.group() for m in _MAYBE_SPACED.finditer(folded)}, 0
    for m in _NOISE.finditer(folded):
        if m.start() >= end:
            start = m.start()
            while start and not folded[start - 1].isspace():
                start -= 1
            end = _WORD_END.search(folded, m.start()).start()
            spans.add(folded[start:end])
    return spans


_WORD_END = re.compile(r"\s|\Z")


def restore_text(decoder: Decoder, text: str) -> str:
    """The text with every disguised span replaced by its likeliest reading; the rest as written."""
    folded = fold(text)
    return _SPAN.sub(lambda m: decoder.restore(m.group()) if m["spaced"] or _NOISE.search(m["word"]) else m.group(), folded)


def score_text(lexicon: Lexicon, reader: Reader, text: str) -> tuple[float, list[str]]:
    """Score and the words that gave it.  A word and its beginnings are one piece of evidence."""
    if not lexicon.fitted:
        return 0.0, []
    found = reader.evidence(text)
    evidence = math.fsum(found.values()) - lexicon.bar
    return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, evidence + LOGIT)))), sorted(found)


class ToxicityModel:
    """Character model (at most CELLS counts) and lexicon (at most MAX_LEXICON entries), both broadcast."""

    def __init__(self, spark, counts: np.ndarray, lexicon: Lexicon):
        self.sent = spark.sparkContext.broadcast((counts, lexicon))

    @classmethod
    def fit(cls, corpus: DataFrame, labels: DataFrame, *, text: str = "text", label: str = "toxic", key_id: str = "doc_id") -> ToxicityModel:
        """The character model reads all texts of `corpus`, the lexicon those of at most MAX_LABELLED rows of `labels`.

        `labels` (key_id, label) is small by that bound and is sent to the texts, which stay where they are.
        """
        counts = corpus_counts(corpus, text)
        some = (labels.filter(F.col(label).isNotNull() & F.col(key_id).isNotNull()).groupBy(key_id).agg(F.max(label).alias(label))
                .orderBy(F.xxhash64(key_id), key_id).limit(MAX_LABELLED))
        some = stored(some.select(F.col(key_id).alias("__id"), F.col(label).alias("__label")), "toxic-labels")
        labelled = (corpus.select(F.col(key_id).alias("__id"), F.col(text).alias(text)).join(F.broadcast(some), "__id")
                    .select(text, F.col("__label").alias(label)))
        return cls(corpus.sparkSession, counts, fit_lexicon(labelled, counts, text, label))

    def score(self, docs: DataFrame, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
        """Adds score, predicted and the entries found (`toxic_terms`)."""
        sent = self.sent

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            counts, lexicon = sent.value
            reader = Reader(_decoder(counts.tobytes()), lexicon)
            for batch in batches:
                got = [score_text(lexicon, reader, t) for t in batch]
                yield pd.DataFrame({"score": [s for s, _ in got], "terms": [f for _, f in got]})

        scored = docs.withColumn("__s", F.pandas_udf(run, "score double, terms array<string>")(whole_text(text)))
        return scored.withColumns({"score": F.col("__s.score"), "toxic_terms": F.col("__s.terms"),
                                   "predicted": (F.col("__s.score") >= threshold).cast("int")}).drop("__s")

    def restore(self, docs: DataFrame, *, text: str = "text", restored: str = "restored") -> DataFrame:
        """Adds the folded text with disguised spans restored."""
        sent = self.sent

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            decoder = _decoder(sent.value[0].tobytes())
            for batch in batches:
                yield pd.Series([restore_text(decoder, t) for t in batch], dtype=object)

        return docs.withColumn(restored, F.pandas_udf(run, "string")(whole_text(text)))


def _decoder(raw: bytes) -> Decoder:
    return worker_model(raw, lambda: Decoder(np.frombuffer(raw, np.int64)))


def corpus_counts(corpus: DataFrame, text: str) -> np.ndarray:
    """4-gram counts over every text, summed per partition and then by cell."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_model()
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            total += gram_counts(batch[text])
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells, "n": total[cells]})

    sums = (corpus.select(whole_text(text).alias(text)).mapInPandas(count, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(CELLS, np.int64)
    out[sums.cell.to_numpy(np.int64)] = sums.n.to_numpy(np.int64)
    return out


def fit_lexicon(labelled: DataFrame, counts: np.ndarray, text: str, label: str) -> Lexicon:
    """Entries whose document frequency in toxic training rows is far above that in clean ones.

    Selection goes in rounds: the strongest entries first, then those that explain the toxic documents the
    earlier ones leave unexplained.  So words that merely stand beside a toxic word, or were copied with it,
    are not taken for toxic themselves.
    """
    rows = labelled.filter(F.col(label).isNotNull()).select(whole_text(text).alias("t"), (F.col(label) == 1).cast("long").alias("toxic"))
    kinds = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = kinds.get(1, 0), kinds.get(0, 0)
    if not n1 or not n0:
        return Lexicon({}, 0.0, False)
    spark = labelled.sparkSession
    sent = spark.sparkContext.broadcast(counts)

    def counted(some: DataFrame, known: dict[str, float]) -> DataFrame:
        """Documents per entry; documents that hold a known entry are left out."""
        taken = spark.sparkContext.broadcast(known)

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            reader, old = Reader(_decoder(sent.value.tobytes())), taken.value
            for batch in batches:
                found: dict[str, int] = {}
                for t in batch.t:
                    own = entries(reader.words(t))
                    if not (old and any(e in old for e in own)):
                        for e in own | {""}:                  # the empty entry counts documents
                            found[e] = found.get(e, 0) + 1
                yield pd.DataFrame({"entry": pd.Series(list(found), dtype=object), "n": list(found.values())})

        return some.mapInPandas(read, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))

    toxic = rows.filter("toxic = 1")
    first = counted(toxic, {}).filter(F.col("n") >= MIN_TOXIC)
    clean = counted(rows.filter("toxic = 0"), {}).withColumnRenamed("n", "clean")
    # Only entries of enough toxic documents matter: the clean counts are stored for those.
    both = stored(first.join(clean, "entry", "left").fillna(0, ["clean"]), "toxic-entries")
    weights: dict[str, float] = {}
    for turn in range(ROUNDS):
        now = both if not turn else counted(toxic, weights).join(both.select("entry", "clean"), "entry")
        left = (now.filter("entry = ''").first() or {"n": 0})["n"]
        if left < MIN_TOXIC:
            break
        odds = F.log((F.col("n") + 0.01) / n1) - F.log((F.col("clean") + 0.5) / n0)
        gain = F.col("n") * F.log(F.col("n") * (n0 + left) / ((F.col("n") + F.col("clean")) * left))
        ranked = (now.filter(f"entry != '' and n >= {MIN_TOXIC}").select("entry", odds.alias("odds"), gain.alias("gain"))
                  .filter((F.col("odds") > MIN_ODDS) & (F.col("gain") > MIN_EVIDENCE))
                  .orderBy(F.desc("gain"), "entry").limit(MAX_LEXICON - len(weights)).collect())
        strong = [r for r in ranked if r.gain >= (FIRST if not turn else LATER) * ranked[0].gain]
        if not strong:
            break
        weights |= {r.entry: float(r.odds) for r in strong}
    # An entry never seen in clean training rows weighs about log(2 n0).
    return Lexicon(weights, BAR * math.log(2 * n0), True)
