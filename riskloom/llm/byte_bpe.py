"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decode.

A text is cut by the vocabulary's pattern; each piece runs through the transducer on its own.  A
sequence of tokens is the BPE encoding of its bytes exactly if its first token encodes to itself and
every neighbouring pair does, so the merges compile into a transducer: a nondeterministic state is a
place in the token trie together with the token before it, and for every prefix of a piece exactly one
such path ends on a whole token.  The deterministic state is the set of paths still open; it is built
the first time a byte leads to it.  The transducer puts out that whole token for every byte; the tokens of
the piece are read back from its end.

Defined results: a missing or empty text has no ids and decodes to the empty text; special-token strings
are ordinary text; bytes that are no UTF-8 decode to U+FFFD as Python's decoder would; rows are
independent, so repeated rows repeat and an empty table gives an empty one; other columns are kept.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import whole_text, worker_model

START = -1
PLACE = 24                # bits of a place in the trie, and of a state's number
PLACES = (1 << PLACE) - 1
NEVER = 1 << 60
MEMO_BYTES = 20_000_000   # estimated size of each of a worker's two generations of pieces; the older goes when the newer is full
ENTRY_BYTES = 200         # of a remembered piece besides its characters and ids
MEMO_PAIRS = 200_000      # answers about token pairs kept by a worker
MEMO_STATES = 400_000     # transitions kept by a worker; later ones are worked out each time they are needed
MEMO_CHARS = 32           # longer pieces are not kept
PACKERS = [struct.Struct(f"<{n}I").pack for n in range(41)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes pieces; `ranks` gives each token's id, lower ids merge first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        # The token trie: child[node * 256 + byte], whether a node has children, the token that ends there.
        self.child: dict[int, int] = {}
        self.inner, self.token_at = bytearray(1), array("i", [START])
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = 1
                node = self.child.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.inner.append(0)
                    self.token_at.append(START)
            self.token_at[node] = rank
        self.follows: dict[int, bool] = {}            # by (token before << PLACE | token)
        self.halves: dict[int, tuple[int, int]] = {}
        # A path: the token before it << PLACE | its place in the trie.  A state is a set of paths.
        self.states: list[bytes] = [array("q", [START << PLACE]).tobytes()]
        self.number: dict[bytes, int] = {self.states[0]: 0}
        self.moves: dict[int, int] = {}               # state << 8 | byte: the token that ends there << PLACE | next state

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge made this one; a token that no merge makes has none (START, START)."""
        known = self.halves.get(token)
        if known is None:
            raw = self.bytes_of[token]
            parts = [raw[i:i + 1] for i in range(len(raw))]
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], NEVER), i))
                if parts[best] + parts[best + 1] not in self.ranks:
                    break
                parts[best:best + 2] = [parts[best] + parts[best + 1]]
            known = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (START, START)
            self.halves[token] = known
        return known

    def may_follow(self, before: int, token: int) -> bool:
        """Do the two tokens' bytes encode to just these tokens?

        Merges are undone from the last one back.  At any time a left and a right piece touch at the
        border; had their bytes been a token of lower rank than the merge undone just now, that merge
        across the border would have come first.  Of two equal ranks the left one merges first.
        """
        if len(self.bytes_of[token]) > 1 and self._halves(token)[0] == START:
            return False
        if before == START:
            return True
        known = self.follows.get(before << PLACE | token)
        if known is None:
            left, right = before, token
            done_left = done_right = NEVER       # rank of the merge that ended each piece's life
            known = True
            while True:
                across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], NEVER)
                if across < done_left and across <= done_right and across != NEVER:
                    known = False
                    break
                split_left = len(self.bytes_of[left]) > 1 and (left > right or len(self.bytes_of[right]) == 1)
                if split_left:
                    done_left, left = left, self._halves(left)[1]
                elif len(self.bytes_of[right]) > 1:
                    done_right, right = right, self._halves(right)[0]
                else:
                    break
            if len(self.follows) >= MEMO_PAIRS:
                self.follows.clear()
            self.follows[before << PLACE | token] = known
        return known

    def _move(self, paths: Iterable[int], byte: int) -> tuple[int, list[int]]:
        """Determinise one step: advance every open path, add the one that just completed a token."""
        open_paths, ended = [], START
        child, token_at, inner, follows = self.child, self.token_at, self.inner, self.follows
        for path in paths:
            to = child.get((path & PLACES) << 8 | byte)
            if to is None:
                continue
            before, token = path >> PLACE, token_at[to]
            if token != START and ended == START:
                fits = follows.get(before << PLACE | token)
                if self.may_follow(before, token) if fits is None else fits:
                    ended = token
            if inner[to]:
                open_paths.append(before << PLACE | to)
        if ended == START:
            raise ValueError(f"byte {byte} is in no token")
        open_paths.append(ended << PLACE)
        return ended, open_paths

    def _learn(self, state: int, byte: int) -> int:
        """A move that is met for the first time is kept, with the state it leads to."""
        token, open_paths = self._move(array("q", self.states[state]), byte)
        paths = array("q", open_paths).tobytes()
        at = self.number.get(paths)
        if at is None:
            at = self.number[paths] = len(self.states)
            self.states.append(paths)
        move = self.moves[state << 8 | byte] = token << PLACE | at
        return move

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []                          # the last token of each beginning of the piece
        state, moves = 0, self.moves
        for i, byte in enumerate(piece):
            move = moves.get(state << 8 | byte)
            if move is None:
                if len(moves) >= MEMO_STATES:
                    self._unkept(last, state, piece[i:])
                    break
                move = self._learn(state, byte)
            last.append(move >> PLACE)
            state = move & PLACES
        # Read back from the end: the token before one is the last token of what it leaves.
        out, at, sizes = [], len(last), self.sizes
        while at:
            out.append(last[at - 1])
            at -= sizes[out[-1]]
        out.reverse()
        return out

    def _unkept(self, last: list[int], state: int, rest: bytes) -> None:
        """The same machine for the rest of a piece, without keeping anything."""
        paths = array("q", self.states[state])
        for byte in rest:
            token, paths = self._move(paths, byte)
            last.append(token)


class Utf8Stream:
    """Incremental UTF-8 decoder over tokens: holds the open bytes of at most one character."""

    def __init__(self):
        self.open = b""

    @staticmethod
    def _need(lead: int) -> int:
        return 1 if 0xC2 <= lead <= 0xDF else 2 if 0xE0 <= lead <= 0xEF else 3 if 0xF0 <= lead <= 0xF4 else 0

    @staticmethod
    def _fits(held: bytes, byte: int) -> bool:
        """May `byte` continue the character begun by `held`?  Second bytes exclude overlong forms, surrogates, > U+10FFFF."""
        low, high = 0x80, 0xBF
        if len(held) == 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(held[0], low)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(held[0], high)
        return low <= byte <= high

    def feed(self, raw: bytes) -> str:
        out = []
        for byte in raw:
            if self.open:
                if self._fits(self.open, byte):
                    self.open += bytes([byte])
                    if len(self.open) == 1 + self._need(self.open[0]):
                        out.append(self.open.decode())
                        self.open = b""
                    continue
                out.append("�")
                self.open = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif self._need(byte):
                self.open = bytes([byte])
            else:
                out.append("�")
        return "".join(out)

    def close(self) -> str:
        rest, self.open = "�" if self.open else "", b""
        return rest


class Codec:
    """Texts to packed ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0                             # estimated bytes of the newer generation
        size = max(ranks.values()) + 1
        self.raw = [b""] * size
        for token, i in ranks.items():
            self.raw[i] = token
        self.alone = np.zeros(size, bool)         # tokens that are whole characters
        self.text: list[str] = [""] * size
        for i, token in enumerate(self.raw):
            try:
                self.text[i] = token.decode()
                self.alone[i] = True
            except UnicodeDecodeError:
                pass

    @cached_property
    def machine(self) -> Transducer:
        return Transducer(self.ranks)

    def _piece(self, piece: str) -> bytes:
        """A piece that the newer generation does not hold; pieces in use move over from the older one."""
        packed = self.older.get(piece)
        if packed is None:
            ids = self.machine.encode(piece.encode("utf-8"))
            packed = np.array(ids, "<u4").tobytes() if len(ids) > 40 else PACKERS[len(ids)](*ids)
        if len(piece) <= MEMO_CHARS:
            if self.held >= MEMO_BYTES:
                self.older, self.memo, self.held = self.memo, {}, 0
            self.memo[piece] = packed
            self.held += ENTRY_BYTES + 4 * len(piece) + len(packed)
        return packed

    def encode(self, text: str) -> bytes:
        memo, piece = self.memo, self._piece
        return b"".join([memo.get(m) or piece(m) for m in self.split.findall(text)])

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        torn = np.flatnonzero(~self.alone[ids])
        if not len(torn):
            return "".join(map(self.text.__getitem__, ids.tolist()))
        out, at, stream, listed = [], 0, Utf8Stream(), ids.tolist()
        for start in torn.tolist():
            if start < at:
                continue
            out += map(self.text.__getitem__, listed[at:start])
            at = start
            # Token by token until no character is open: whole tokens go through the machine, too.
            while at < len(listed):
                out.append(stream.feed(self.raw[listed[at]]))
                at += 1
                if not stream.open:
                    break
        out += map(self.text.__getitem__, listed[at:])
        out.append(stream.close())
        return "".join(out)


def _codec(raw: bytes, pattern: str) -> Codec:
    return worker_model((raw, pattern), lambda: Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}, pattern))


class ByteBpe:
    """Spark side: the vocabulary (a file of fixed size, read on the driver) is broadcast, texts stay where they are."""

    def __init__(self, spark: SparkSession, rank_file: str, pattern: str):
        with open(rank_file, "rb") as file:
            self.sent = spark.sparkContext.broadcast((file.read(), pattern))

    def _mapped(self, kind: str, work: Callable[[Codec], Callable]):
        sent = self.sent

        @F.pandas_udf(kind)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            each = work(_codec(*sent.value))
            for batch in batches:
                yield pd.Series([each(x) for x in batch], dtype=object)

        return run

    def encode(self, docs: DataFrame, *, text: str = "text", ids: str = "ids") -> DataFrame:
        """Adds `ids`: the token ids of the whole text, packed as little-endian unsigned 32-bit integers."""
        return docs.withColumn(ids, self._mapped("binary", lambda codec: codec.encode)(whole_text(text)))

    def round_trip(self, docs: DataFrame, *, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """Adds `ids` and `decoded`, what the ids stand for, in one pass: a task has one Python worker with one vocabulary."""
        sent = self.sent

        @F.pandas_udf("ids binary, decoded string")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            codec = _codec(*sent.value)
            for batch in batches:
                packed = [codec.encode(x) for x in batch]
                yield pd.DataFrame({"ids": packed, "decoded": [codec.decode(p) for p in packed]}, dtype=object)

        both = docs.withColumn("__both", run(whole_text(text)))
        return both.withColumns({ids: F.col("__both.ids"), decoded: F.col("__both.decoded")}).drop("__both")

    def decode(self, rows: DataFrame, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
        """Adds `text`: what packed ids stand for; missing ids decode to the empty text."""
        return rows.withColumn(text, self._mapped("string", lambda codec: codec.decode)(F.coalesce(F.col(ids), F.lit(b""))))
