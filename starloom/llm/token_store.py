"""Token ids in seekable binary files: one independent zstandard frame per document, each with a
checksum, and a trailing seek table, so that a reader decompresses only the documents it asks for.

File format (zstandard's seekable format; plain zstandard tools read it too):

* one frame per document: its ids as little-endian unsigned integers of ``item`` bytes;
* a skippable frame (magic 0x184D2A50) with the index: item size, partition, shard, number of
  documents, whether each has an id, and the ids of the documents;
* a skippable frame (magic 0x184D2A5E) with the seek table: for each frame the compressed and
  decompressed size and the low 32 bits of the XXH64 of its data, then the footer (number of
  frames, descriptor, magic 0x8F92EAB1).

Documents are dealt to partitions by ranges of ``doc_id``, so files follow each other in ascending
order of it. Spark's writer commits the files (a lost task leaves none), to any store it can
write: each row of a binary column becomes one file.

Defined cases: null text is encoded as empty and holds the end id alone; documents without an id
come first; repeated ids are ordered by the text's hash; a special token's string in a text is that
token, as in the library; a long text is one frame, of up to 2**32
bytes; an empty table gives no files and reads back as no rows; other columns are not stored.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import broadcast_below, held, pin, read
from starloom.session import scratch_path

#: Fixed values of the file formats.
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
END_ID = 2
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\s{L}{N}]+"  # the vocabulary's own pattern

#: The parts of a tokenizer file that WORD, lower-casing and the letters below stand for.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": WORD.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}")},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]

#: The vocabulary writes bytes as letters: those of visible characters as themselves, the rest
#: from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _VISIBLE)}

SHARD_BYTES = 8 << 20  # a file is closed beyond this; one document more may pass it


class TokenFile:
    """Collects the frames of one file."""

    def __init__(self, item: int, level: int = 1):
        self.item, self.compressor = item, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames, self.table, self.docs, self.size = [], [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        data = ids.astype(f"<u{self.item}").tobytes()
        frame = self.compressor.compress(data)
        self.frames.append(frame)
        self.docs.append(doc_id)
        self.table.append(struct.pack("<III", len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.size += len(frame)

    def content(self, partition: int, shard: int) -> bytes:
        index = struct.pack("<BqqI", self.item, partition, shard, len(self.docs)) + \
            bytes(d is not None for d in self.docs) + np.array([d or 0 for d in self.docs], "<i8").tobytes()
        seek = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, FOOTER_MAGIC)
        return b"".join([*self.frames, struct.pack("<II", INDEX_MAGIC, len(index)), index,
                         struct.pack("<II", TABLE_MAGIC, len(seek)), seek])


class TokenReader:
    """Random access to the documents of one file's bytes."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        n, descriptor, magic = struct.unpack("<IBI", self.content[-9:])
        start = len(content) - 9 - 12 * n
        if magic != FOOTER_MAGIC or descriptor != CHECKSUMS or \
                struct.unpack("<II", self.content[start - 8:start]) != (TABLE_MAGIC, 12 * n + 9):
            raise ValueError("not a token file: no seek table at its end")
        self.table = np.frombuffer(self.content[start:-9], "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        head = int(self.at[-1])
        if struct.unpack("<I", self.content[head:head + 4])[0] != INDEX_MAGIC:
            raise ValueError("not a token file: no index after its frames")
        self.item, self.partition, self.shard, docs = struct.unpack("<BqqI", self.content[head + 8:head + 29])
        has = np.frombuffer(self.content[head + 29:head + 29 + docs], bool)
        ids = np.frombuffer(self.content[head + 29 + docs:head + 29 + 9 * docs], "<i8")
        self.docs = [int(i) if h else None for i, h in zip(ids, has, strict=True)]
        self.lengths = self.table[:, 1] // self.item
        self.decompressor = zstandard.ZstdDecompressor()

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only its frame is decompressed."""
        frame = self.content[self.at[k]:self.at[k + 1]]
        data = self.decompressor.decompress(frame, max_output_size=int(self.table[k, 1]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} does not match its checksum")
        return np.frombuffer(data, f"<u{self.item}").astype("<u4")


def splits_as_known(content: str) -> bool:
    """Whether a tokenizer file makes words of plain characters as :class:`WordEncoder` does, and cuts
    or pads nothing. Added tokens must be found in the text as it is."""
    file = json.loads(content)
    return file.get("normalizer") == {"type": "Sequence", "normalizers": NORMALIZERS} and \
        file.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": PRE_TOKENIZERS} and \
        not any(file.get(k) for k in ("truncation", "padding", "post_processor")) and \
        all(t.get("special") and not t.get("normalized") for t in file.get("added_tokens") or [])


class WordEncoder(dict):
    """Encodes whole texts with a `tokenizers` vocabulary whose tokens never span words.

    The library's model encodes each word when it is first met; the dict then holds the word's
    place in ``flat``, the ids of all words met (a bounded number). That holds for texts of plain
    printable characters, which normalise to their lower case; a text with any other character
    is given to the whole library as it is, and so is every text if the file normalises or splits
    otherwise (:func:`splits_as_known`)."""

    KEPT = 500_000
    BLOCK = 1 << 20  # characters of texts that are held as words at a time

    def __init__(self, content: str, ordinary_specials: bool = True):
        super().__init__()
        self.library = Tokenizer.from_str(content)
        self.library.encode_special_tokens = ordinary_specials
        self.model = self.library.model
        self.known = splits_as_known(content)
        self.item = 2 if max(self.library.get_vocab().values()) < 1 << 16 else 4
        # printable characters below U+0250 that lower-case and compose one by one
        plain = [c for c in map(chr, [9, 10, 13, *range(32, 127), *range(161, 0x250)])
                 if c != "\xad" and len(c.lower()) == 1 and ord(c.lower()) < 0x250]
        of = lambda kind: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind)
        self.other = re.compile(f"[^{''.join(map(re.escape, plain))}]")
        self.words = re.compile(WORD.replace("{L}", of("L")).replace("{N}", of("N")))
        self.specials = [] if ordinary_specials else [
            t.content for t in self.library.get_added_tokens_decoder().values()]
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.flat, self.start = array("I"), array("q", [0])  # word k: flat[start[k]:start[k + 1]]

    def __missing__(self, word: str) -> int:
        raw = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        self.flat.extend([t.id for t in self.model.tokenize(raw)])
        self.start.append(len(self.flat))
        k = self[word] = len(self)
        return k

    def _plain(self, text: str) -> bool:
        return self.known and not self.other.search(text) and not any(s in text for s in self.specials)

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; texts of about BLOCK characters are looked up together."""
        block, size = [], 0
        for text in texts:
            block.append(text or "")
            size += len(block[-1])
            if size > self.BLOCK:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> Iterator[np.ndarray]:
        short = [len(t) <= self.BLOCK and self._plain(t) for t in texts]
        words = [self.words.findall(t.lower()) for t, s in zip(texts, short, strict=True) if s]
        ids, sizes = self._ids(list(chain.from_iterable(words)))
        # the ids of the first n words end at the sum of their sizes
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, words)])]
        parts = (ids[x:y] for x, y in zip(ends, ends[1:], strict=False))
        for text, is_short in zip(texts, short, strict=True):
            if is_short:
                yield next(parts)
            elif self._plain(text):
                found = (m[0] for m in self.words.finditer(text.lower()))
                blocks = iter(lambda: list(islice(found, self.BLOCK)), [])  # noqa: B023  used at once
                yield np.concatenate([self._ids(b)[0] for b in blocks] or [np.empty(0, np.uint32)])
            else:
                yield np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has."""
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if len(self) > self.KEPT:
            self._reset()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        starts = np.frombuffer(self.start, np.int64)  # a view: gone before the array grows
        start, size = starts[at], starts[at + 1] - starts[at]
        # the places of all ids: each word's start, counted on
        first = np.cumsum(size) - size
        return np.frombuffer(self.flat, np.uint32)[np.repeat(start - first, size) + np.arange(size.sum())], size


def write_store(documents: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID,
                shard_bytes: int = SHARD_BYTES, ordinary_specials: bool = False) -> None:
    """Write the ids of ``documents`` (doc_id, text) under ``path`` in ascending doc_id order. Special
    tokens' strings in a text get the special ids, as in the library, unless they are to be ordinary."""
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    key, shared = (hash(content), ordinary_specials), spark.sparkContext.broadcast(content)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = held(("words", key), lambda: WordEncoder(shared.value, ordinary_specials))
        partition, shard = TaskContext.get().partitionId(), 0
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        out = TokenFile(encoder.item)
        for part in parts:
            ids = [None if pd.isna(i) else int(i) for i in part["doc_id"]]
            for doc_id, coded in zip(ids, encoder.encode(part["text"].tolist()), strict=True):
                out.add(doc_id, np.concatenate([coded, tail]))
                if out.size > shard_bytes:
                    yield pd.DataFrame({"content": [out.content(partition, shard)]})
                    out, shard = TokenFile(encoder.item), shard + 1
        if out.docs:
            yield pd.DataFrame({"content": [out.content(partition, shard)]})

    tie = F.xxhash64("text")
    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    files = ordered.mapInPandas(run, "content binary")
    # the text writer puts a separator after each row: the last byte of the file's own footer
    last = FOOTER_MAGIC.to_bytes(4, "little")[-1:]
    files.select(F.expr("substring(content, 1, octet_length(content) - 1)").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option(
        "lineSep", last.decode("ISO-8859-1")).text(path)


def read_store(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(part, shard, k, doc_id, n_tokens, at, ids): each document of the files, or each asked for;
    ``at`` counts the ids before it in its file. Other documents' frames are not decompressed."""
    wanted = None if doc_ids is None else frozenset(doc_ids)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for content in chain.from_iterable(p["content"] for p in parts):
            file = TokenReader(content)
            at = np.concatenate([[0], np.cumsum(file.lengths)])
            rows, size = [], 0
            for k, doc_id in enumerate(file.docs):
                if wanted is None or doc_id in wanted:
                    rows.append((file.partition, file.shard, k, doc_id, int(file.lengths[k]), int(at[k]),
                                 file.ids(k).tobytes()))
                    size += len(rows[-1][-1])
                if rows and (size > 4 << 20 or k + 1 == len(file.docs)):
                    out = pd.DataFrame(rows, columns=COLUMNS)
                    yield out.assign(doc_id=out["doc_id"].astype("Int64"))
                    rows, size = [], 0

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(run, "part long, shard long, k long, doc_id long, n_tokens long, at long, ids binary")


COLUMNS = ["part", "shard", "k", "doc_id", "n_tokens", "at", "ids"]
MAX_BROADCAST_FILES = 500_000


def with_starts(rows: DataFrame) -> DataFrame:
    """Rows of :func:`read_store` over whole files, with ``start``: the ids before each document in
    the whole store. Only one row per file is summed in order."""
    files = rows.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    before = pin(files.select("part", "shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before")), "files")
    return rows.join(broadcast_below(before, MAX_BROADCAST_FILES), ["part", "shard"]).withColumn(
        "start", F.col("before") + F.col("at")).drop("before")




def op8_token_store(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-store")
    write_store(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    rows = read_store(spark, path).select(
        "part", "shard", "doc_id", "n_tokens", "at", F.crc32("ids").alias("ids_crc32"))
    return with_starts(pin(rows, "token-store-rows")).select("doc_id", "start", "n_tokens", "ids_crc32")
