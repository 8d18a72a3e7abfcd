"""Byte-level BPE encoding by a lazily determinised finite-state transducer, and streaming
decoding by an incremental UTF-8 state machine.

Encoding. Merging by rank gives each byte string exactly one token sequence, and that sequence
is known by its neighbours alone: two tokens may stand side by side if no merge, undone from
the last to the first, would have crossed the border between them. So every prefix of a text
has one last token, and reading a byte only has to follow, among the borders that can still
matter, those whose open bytes begin some token. A state of the transducer is what this
depends on: the last token emitted and the bytes read since. States and transitions are built
when first met and kept (up to ``max_states``, then dropped and built anew). As soon as all open
paths share their next tokens these are emitted, so at most about two tokens' length of input
is ever pending.

Decoding. A state is the list of bytes of an unfinished character (three at most); the machine
is lifted from bytes to tokens, a transition being built when first met. Ill-formed input gives
U+FFFD for each maximal part of a character, as UTF-8 decoders do.

Defined cases: null and empty text have no tokens and decode to the empty text; long texts are
cut by the pattern into matches as they are read; null ids decode to null; repeated rows are
encoded alike; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import held, read, ship_package

NEVER = 1 << 62
ROOT = 0


class MergeTransducer:
    """States are numbered. ``paths[state]`` holds the open paths, each as (trie node of the bytes
    since its last border, token that ends at that border, tokens not emitted yet up to it);
    ``moves[state << 8 | byte]`` the next state, or the tokens that are then certain and it."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 300_000, max_pieces: int = 350_000):
        self.ranks, self.bytes = ranks, {i: b for b, i in ranks.items()}
        self.max_states, self.max_pieces = max_states, max_pieces
        # trie: (node << 8 | byte) -> child; token_at[node]: the token that ends there
        self.trie: dict[int, int] = {}
        self.token_at: list[int | None] = [None]
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                child = self.trie.get(node << 8 | byte)
                if child is None:
                    child = self.trie[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(None)
                node = child
            self.token_at[node] = rank
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.sides: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.paths: list[tuple] = []
        self.moves: dict[int, int | tuple[tuple[int, ...], int]] = {}
        self.shared: dict[tuple, tuple] = {}  # one object for equal paths of different states
        self.start = self._state(((ROOT, None, ()),))

    def _state(self, paths: tuple) -> int:
        state = self.states.get(paths)
        if state is None:
            paths = tuple([self.shared.setdefault(p, p) for p in paths])
            state = self.states[paths] = len(self.paths)
            self.paths.append(paths)
        return state

    # -- which tokens may stand side by side ------------------------------------------------

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for one that no merge makes."""
        if token not in self.splits:
            self.splits[token] = None
            b, get = self.bytes[token], self.ranks.get
            for k in range(1, len(b)):
                left, right = get(b[:k]), get(b[k:])
                if left is not None and right is not None and left < token and right < token and \
                        self.reachable(left) and self.reachable(right) and self._apart(left, right, token):
                    self.splits[token] = left, right
                    break
        return self.splits[token]

    def reachable(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self.split(token) is not None

    def _apart(self, x: int, y: int, limit: int) -> bool:
        """No merge of a rank below ``limit`` crosses the border between x and y: undo the later
        of the two last merges, again and again, and see whether the tokens then at the border
        would have merged before it. Of merges of one rank the left one comes first."""
        name, get = self.bytes, self.ranks.get
        while True:
            joint = get(name[x] + name[y])
            if joint is not None and joint < limit:
                return False
            a = x if len(name[x]) > 1 else -1
            b = y if len(name[y]) > 1 else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, x = a, self.split(x)[1]
            else:
                limit, y = b + 1, self.split(y)[0]

    def fit(self, x: int | None, y: int) -> bool:
        if x is None:
            return self.reachable(y)
        known = self.sides.get(x << 32 | y)
        if known is None:
            if len(self.sides) > self.max_states // 3:
                self.sides.clear()
            known = self.sides[x << 32 | y] = self.reachable(y) and self._apart(x, y, NEVER)
        return known

    # -- the transducer -----------------------------------------------------------------------

    def step(self, state: int, byte: int) -> int | tuple[tuple[int, ...], int]:
        """Build a transition."""
        paths, border, after, token_at = [], None, self.trie.get, self.token_at
        for node, last, held in self.paths[state]:
            child = after(node << 8 | byte)
            if child is not None:
                paths.append((child, last, held))
                if border is None:
                    token = token_at[child]
                    if token is not None and self.fit(last, token):
                        border = ROOT, token, (*held, token)  # the one token that can end here
        if border:
            paths.append(border)
        # tokens that all open paths begin with are certain; the first path holds the fewest
        first = paths[0][2]
        n = len(first)
        if n:
            for path in paths:
                held = path[2]
                while held[:n] != first[:n]:
                    n -= 1
            if n:
                paths = [(node, last, held[n:]) for node, last, held in paths]
        following = self._state(tuple(paths))
        move = self.moves[state << 8 | byte] = (first[:n], following) if n else following
        return move

    def _rest(self, state: int) -> tuple[int, ...]:
        """What is left if the input ends here: the path whose last border is here stands last."""
        node, _, held = self.paths[state][-1]
        return held if node == ROOT else ()

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Tokens of one match of the pattern, each as soon as it is certain."""
        state, moves = self.start, self.moves
        for byte in data:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self.step(state, byte)
            if move.__class__ is int:
                state = move
            else:
                yield from move[0]
                state = move[1]
        yield from self._rest(state)

    def piece(self, data: bytes) -> tuple[int, ...]:
        """Tokens of one match: a match that is itself a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        if len(self.paths) > self.max_states:
            self._reset()
        # as stream(), without handing over token by token
        state, out, get = self.start, [], self.moves.get
        for byte in data:
            move = get(state << 8 | byte)
            if move is None:
                move = self.step(state, byte)
            if move.__class__ is int:
                state = move
            else:
                out += move[0]
                state = move[1]
        return (*out, *self._rest(state))


def narrow_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for the standard library, which knows no Unicode properties, over characters
    below U+0250 that are no odd white space: letters and numbers spelt out. None if the pattern
    has other properties."""
    chars = [chr(c) for c in range(0x250) if c not in ODD]
    of = lambda kind: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)
    out, inside = [], False
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern):
        inside = part == "[" or inside and part != "]"
        if part in (r"\p{L}", r"\p{N}"):
            part = of(part[3]) if inside else f"[{of(part[3])}]"
        out.append(part)
    found = "".join(out)
    return None if re.search(r"\\[pP]\{", found) else re.compile(found)


#: White space and controls below U+0250 that the two libraries see differently.
ODD = frozenset([*range(0x1C, 0x20), 0x85, 0xA0])


class Encoder(dict):
    """Tokens of texts. The dict holds, for each match met, its place in ``flat``, the tokens of all
    matches met (a bounded number)."""

    BLOCK = 1 << 16  # matches of a text that are held at a time

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.transducer = MergeTransducer(ranks)
        self.narrow = narrow_pattern(pattern)
        self.other = re.compile(f"[^{''.join(re.escape(chr(c)) for c in range(0x250) if c not in ODD)}]")
        # the tokenizer's \s is the property White_Space
        wide = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(
            r"\s", r"\p{White_Space}")
        self.wide = regex.compile(wide)
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.flat, self.start = array("I"), array("q", [0])  # match k: flat[start[k]:start[k + 1]]

    def __missing__(self, match: str) -> int:
        self.flat.extend(self.transducer.piece(match.encode()))
        self.start.append(len(self.flat))
        k = len(self.start) - 2
        if len(match) <= 64:
            self[match] = k
        return k

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pattern = self.wide if self.narrow is None or self.other.search(text) else self.narrow
        if len(text) <= 16 * self.BLOCK:
            return self._ids(pattern.findall(text))
        matches = (m[0] for m in pattern.finditer(text))
        return b"".join(iter(lambda: self._ids(list(islice(matches, self.BLOCK))), b""))

    def _ids(self, matches: list[str]) -> bytes:
        if not matches:
            return b""
        if len(self.start) > self.transducer.max_pieces:
            self._reset()
        at = np.fromiter(map(self.__getitem__, matches), np.int64, len(matches))
        starts = np.frombuffer(self.start, np.int64)  # a view: gone before the array grows
        start, size = starts[at], starts[at + 1] - starts[at]
        # the places of all tokens: each match's start, counted on
        first = np.cumsum(size) - size
        return np.frombuffer(self.flat, np.uint32)[np.repeat(start - first, size) + np.arange(size.sum())].astype(
            "<u4", copy=False).tobytes()


class Decoder:
    """Text of ids that come in any portions: ``feed`` returns the characters that are complete,
    ``finish`` what an unfinished one leaves."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = {i: b for b, i in ranks.items()}
        self.plain: dict[int, str] = {}  # tokens that are whole characters
        for i, b in self.bytes.items():
            try:
                self.plain[i] = b.decode()
            except UnicodeDecodeError:
                pass
        self.moves: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        self.open = b""

    @staticmethod
    def _accepts(held: bytes, byte: int) -> bool:
        """Whether ``byte`` goes on the unfinished character ``held`` (well-formed UTF-8 only)."""
        if len(held) > 1:
            return 0x80 <= byte <= 0xBF
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(held[0], 0x80)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(held[0], 0xBF)
        return low <= byte <= high

    @staticmethod
    def _length(lead: int) -> int:
        return 1 if lead < 0x80 else 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else \
            4 if 0xF0 <= lead <= 0xF4 else 0

    def _bytes(self, held: bytes, data: bytes) -> tuple[str, bytes]:
        out = []
        for byte in data:
            if held and not self._accepts(held, byte):
                out.append("�")
                held = b""
            if not held and not self._length(byte):
                out.append("�")
                continue
            held += bytes((byte,))
            if len(held) == self._length(held[0]):
                out.append(held.decode())
                held = b""
        return "".join(out), held

    def feed(self, ids: Iterable[int]) -> str:
        held, out, plain = self.open, [], self.plain
        for i in ids:
            if not held and i in plain:
                out.append(plain[i])
                continue
            move = self.moves.get((held, i))
            if move is None:
                move = self.moves[held, i] = self._bytes(held, self.bytes[i])
            out.append(move[0])
            held = move[1]
        self.open = held
        return "".join(out)

    def finish(self) -> str:
        out, self.open = "�" * bool(self.open), b""
        return out

    def decode(self, ids: list[int]) -> str:
        try:
            return "".join(map(self.plain.__getitem__, ids))  # no character spans two tokens
        except KeyError:
            return self.feed(ids) + self.finish()


def load_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank in each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


class Vocabulary:
    """A rank file and a pattern, shipped to the executors once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ship_package(spark)
        with open(path, "rb") as f:
            content = f.read()
        self.key = hash((content, pattern))
        self.shared: Broadcast = spark.sparkContext.broadcast((content, pattern))


def _worker(key: int, shared: Broadcast) -> tuple[Encoder, Decoder]:
    """The encoder and decoder of this Python worker."""
    def make():
        content, pattern = shared.value
        ranks = load_ranks(content)
        return Encoder(ranks, pattern), Decoder(ranks)

    return held(("bpe", key), make)


def encode(documents: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``documents`` with a binary column of ids, little-endian unsigned 32-bit integers."""
    key, shared = vocabulary.key, vocabulary.shared

    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder, _ = _worker(key, shared)
        for texts in parts:
            yield texts.map(encoder.encode)

    return documents.withColumn(ids, run(F.coalesce(documents[text], F.lit(""))))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of their binary ids."""
    key, shared = vocabulary.key, vocabulary.shared

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, decoder = _worker(key, shared)
        for coded in parts:
            yield coded.map(lambda b: None if b is None else decoder.decode(np.frombuffer(b, "<u4").tolist()))

    return rows.withColumn(text, run(rows[ids]))


def default_vocabulary(spark: SparkSession) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


SLICE = 256  # rows that a worker has as Python objects


def round_trip(documents: DataFrame, vocabulary: Vocabulary, *keep: str) -> DataFrame:
    """doc_id, the columns to keep, n_tokens, ids, and digests of the ids and of the decoded text.
    Both directions run in one Python worker, a few rows at a time."""
    key, shared = vocabulary.key, vocabulary.shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _worker(key, shared)
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                part = batch.slice(k, SLICE)
                ids = [encoder.encode(t) for t in part.column("text").to_pylist()]
                back = [decoder.decode(np.frombuffer(b, "<u4").tolist()) for b in ids]
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(ids, pa.binary()), pa.array(back, pa.string())], [*kept.schema.names, "ids", "decoded"])

    rows = documents.select("doc_id", *keep, "text")
    fields = [f for f in rows.schema.fields if f.name != "text"]
    rows = rows.mapInArrow(run, T.StructType([*fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]))
    return rows.select("doc_id", *keep, F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"), default_vocabulary(spark)).drop("ids")
