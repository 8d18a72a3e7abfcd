"""Fill-in-the-middle transformation: each text is cut twice, between lines or between characters,
and written as prefix, suffix and middle with sentinels, in one of two orders.

Cuts fall on units, lengths are wanted in code points, and the work is done on UTF-8 bytes. A
sparse exception index translates between the two (:class:`Exceptions`): it holds only the multibyte
characters of a batch, by their positions and the excess bytes up to each; a binary search finds
how many lie before a cut. Text without multibyte characters has an empty index, and a cut is
then its own translation. A batch's texts are one buffer, indexed once, and all its cuts are
looked up together; only the joining of output bytes goes text by text.

A document's cuts and form come from the SHA-256 of ``<seed>:<doc_id>``, so a lost executor's rows
are made again alike. The text is left as it is (form ``plain``) where it is empty, holds a
sentinel, or is not drawn for the transformation; so the sentinels of an output are its own, and
:func:`restored` finds the text again.

Defined cases: a null text is empty; a null id counts as an empty string in the hash; repeated rows and
ids are transformed alike, row by row; very long texts are handled whole (outputs leave in
batches of about ``BATCH_BYTES``); an empty table gives no rows; other columns are returned in the
struct ``kept``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import read

#: Fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 7, 100, 50

LINES, CHARACTERS = "lines", "characters"
BATCH_BYTES = 16 << 20
NEWLINE = 10


class Exceptions:
    """Where code points and bytes differ in a UTF-8 buffer: positions of the multibyte characters, in
    bytes and in code points, and the excess bytes up to each."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0))])
        self.place = self.at - self.excess[:-1]

    def to_characters(self, byte_cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte position (a character's start or the end)."""
        return byte_cuts - self.excess[np.searchsorted(self.at, byte_cuts)]

    def to_bytes(self, character_cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code point position."""
        return character_cuts + self.excess[np.searchsorted(self.place, character_cuts)]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array without nulls, and its len + 1 offsets into them."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def cut(data: np.ndarray, ends: np.ndarray, h1: np.ndarray, h2: np.ndarray, unit: str) -> dict[str, np.ndarray]:
    """Per text: the number of units n; where prefix and middle end, in bytes of the buffer; and the
    code points of both."""
    index = Exceptions(data)
    start, end = ends[:-1], ends[1:]
    if unit == LINES:
        stops = np.flatnonzero(data == NEWLINE)
        first, last = np.searchsorted(stops, start), np.searchsorted(stops, end)
        open_end = (end > start) & (data[np.maximum(end - 1, 0)] != NEWLINE) if len(data) else np.zeros(len(start), bool)
        n = last - first + open_end

        def byte_of(units: np.ndarray) -> np.ndarray:
            if not len(stops):
                return np.where(units > 0, end, start)
            after = stops[np.clip(first + units - 1, 0, len(stops) - 1)] + 1
            return np.where(units == 0, start, np.where(units > last - first, end, after))
    else:
        n = index.to_characters(end) - index.to_characters(start)

        def byte_of(units: np.ndarray) -> np.ndarray:
            return index.to_bytes(index.to_characters(start) + units)

    units = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
    a, b = byte_of(units[0]), byte_of(units[1])
    points = index.to_characters(np.stack([start, a, b]))
    return {"n": n, "a": a, "b": b, "prefix_chars": points[1] - points[0], "middle_chars": points[2] - points[1]}


def draws(doc_id: Column, seed: int) -> list[Column]:
    """h1 .. h4: the first four 8-digit groups of the hex SHA-256 of ``<seed>:<doc_id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def transform(documents: DataFrame, unit: str = LINES, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, kept): ``rate`` percent of the texts are
    transformed, ``spm_rate`` percent of those with the suffix first."""
    if unit not in (LINES, CHARACTERS):
        raise ValueError(f"unknown unit {unit}")
    others = [documents[f"`{c}`"] for c in documents.columns if c not in ("doc_id", "text")]
    text = F.coalesce(documents["text"], F.lit(""))
    plain = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (F.length(text) == 0)
    rows = documents.select(
        documents["doc_id"], text.alias("text"), plain.alias("plain"), *draws(documents["doc_id"], seed),
        *([F.struct(*others).alias("kept")] if others else []))
    kept = f", kept {rows.schema['kept'].dataType.simpleString()}" if others else ""
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, ends = buffer_of(batch.column("text"))
        h = [batch.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5)]
        at = cut(data, ends, h[0], h[1], unit)
        left = batch.column("plain").to_numpy(zero_copy_only=False) | (h[2] % 100 >= rate)
        spm = h[3] % 100 < spm_rate
        view, out, sizes = memoryview(data), [], np.diff(ends) + np.where(left, 0, sum(map(len, marks)))
        p, s, m = marks
        for k, (i, a, b, j) in enumerate(zip(ends[:-1].tolist(), at["a"].tolist(), at["b"].tolist(), ends[1:].tolist(), strict=True)):
            if left[k]:
                out.append(view[i:j])
            elif spm[k]:
                out += (s, view[b:j], p, view[i:a], m, view[a:b])
            else:
                out += (p, view[i:a], s, view[b:j], m, view[a:b])
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        texts = pa.Array.from_buffers(pa.utf8(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(out))])
        whole = lambda x: pa.array(x, pa.int64(), mask=left)
        columns = [batch.column("doc_id"), pa.array(at["n"], pa.int64()), pa.array(np.where(left, "plain", np.where(spm, "spm", "psm")), pa.utf8()),
                   whole(at["prefix_chars"]), whole(at["middle_chars"]), texts]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        if kept:
            columns, names = [*columns, batch.column("kept")], [*names, "kept"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ends = buffer_of(batch.column("text"))
            first = 0
            while first < len(batch):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH_BYTES)))
                yield part(batch.slice(first, last - first))
                first = last

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {doc_id}, n long, form string, prefix_chars long, middle_chars long, output string{kept}")


def restored(form: Column, output: Column) -> Column:
    """The text of an output: its parts lie between the sentinels, the middle last."""
    def between(first: str, second: str, joined) -> Column:
        a, b = F.instr(output, first), F.instr(output, MIDDLE)
        before = F.substring(output, F.lit(len(second) + 1), a - len(second) - 1)
        after = F.substring(output, a + len(first), b - a - len(first))
        return F.concat(*joined(before, after, F.substring(output, b + len(MIDDLE), F.length(output))))

    return F.when(form == "psm", between(SUFFIX, PREFIX, lambda prefix, suffix, middle: (prefix, middle, suffix))).when(
        form == "spm", between(PREFIX, SUFFIX, lambda suffix, prefix, middle: (prefix, middle, suffix))).otherwise(output)


def op11_fill_middle(spark, sf_dir: str) -> DataFrame:
    out = transform(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, t, string_split(t, chr(10)) AS x, length(t) AS size,
         sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
n AS (
  SELECT *, (len(x) - CASE WHEN x[-1] = '' THEN 1 ELSE 0 END)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
         ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3,
         ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
u AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS u1, greatest(h1 % (n + 1), h2 % (n + 1)) AS u2,
         CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE}
              THEN 'plain' WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM n),
c AS (
  SELECT *, least(size, u1 + coalesce(list_sum(list_transform(x[1:u1], lambda s: length(s))), 0))::BIGINT AS a,
         least(size, u2 + coalesce(list_sum(list_transform(x[1:u2], lambda s: length(s))), 0))::BIGINT AS b FROM u),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
              ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
