"""Benchmark decontamination: a hash set of normalised test n-grams, broadcast to the scan of
all training windows; hits are verified on the words themselves.

Words are runs of characters other than ASCII punctuation, white space and controls, after
lower-casing A-Z. A window is ``n`` consecutive words of an item; an item of fewer words (but
not none) is one window. Every window of every document is hashed inside its own row and
looked up; only hits travel further. DataFrame functions only.

Defined cases: null or empty text has no words and no hits; repeated rows and equal texts get
equal results, because results are keyed by the text's digest and not by ``doc_id`` (which may
be null or repeated); a window shared by several items counts for each of them; items with a
null id are ignored in item lists but their windows hit; an empty benchmark or document table gives zero
hits or no rows; other columns of the input are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, broadcast_below, pin

#: Fixed values of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before lower-casing
N = 13
MIN_SHARE_INVERSE = 20  # contaminated: at least 1 word in 20 is hit

#: 16 bytes a row: at most 64 MB are broadcast; beyond it the join is shuffled.
MAX_BROADCAST_WINDOWS = 4_000_000
MAX_BROADCAST_KEYS = 1_000_000  # 32-byte digests of texts with hits


def words_of(text: Column) -> Column:
    # a split at what is no word costs a sixth of extracting every match; it leaves empty strings
    # at the ends only
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def text_key(text: Column) -> Column:
    """Identity of a text: equal texts have equal results. Null for null."""
    return F.unhex(F.sha2(text, 256))


def _starts(n_words: Column, size: Column | int) -> Column:
    """1-based starts of the windows of ``size`` words."""
    last = n_words - F.lit(size) + 1
    return F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))


def _hashed(size: int) -> Column:
    return F.transform(_starts(F.size("words"), size), lambda i: F.struct(
        F.lit(size).alias("size"), i.alias("pos"),
        F.xxhash64(F.slice("words", i, F.lit(size))).alias("hash")))


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(item_id, size, window, hash): each distinct window of each item."""
    items = benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("words"))
    items = items.withColumn("size", F.least(F.size("words"), F.lit(n))).where("size > 0")
    starts = _starts(F.size("words"), F.col("size"))
    return items.select("item_id", "size", F.explode(F.transform(
        starts, lambda i: F.struct(
            F.concat_ws(" ", F.slice("words", i, F.col("size"))).alias("window"),
            F.xxhash64(F.slice("words", i, F.col("size"))).alias("hash")))).alias("w")).select(
        "item_id", "size", "w.window", "w.hash").distinct()


def hits(documents: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """(key, hits): for each document text with a verified hit, its sorted hits as
    array<struct<pos, size, item_id>>, pos counted from 1 in words."""
    bench = pin(benchmark_windows(benchmark, n), "bench-windows")
    # at most n sizes: n itself and the lengths of shorter items
    sizes = [r[0] for r in bench.select("size").distinct().collect()]
    docs = documents.select("text").where(F.col("text").isNotNull())
    words = docs.select(text_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("words"))
    hashes = F.array().cast("array<struct<size:int,pos:int,hash:bigint>>")
    if sizes:
        hashes = F.concat(*[_hashed(size) for size in sizes])
    scanned = words.select("key", F.explode(hashes).alias("w")).select("key", "w.size", "w.pos", "w.hash")
    # the set of window hashes: one row for each, however many items share it
    known = broadcast_below(bench.select("size", "hash").distinct(), MAX_BROADCAST_WINDOWS)
    found = scanned.join(known, ["size", "hash"], "left_semi")
    found = found.groupBy("key").agg(F.collect_set(F.struct("size", "pos")).alias("at"))
    # verification: the words of each hit, taken from the text again, against the items' words;
    # only texts with hits are moved
    found = pin(found, "window-hits")
    some = documents.select("text").where(F.col("text").isNotNull()).withColumn("key", text_key(F.col("text"))).join(
        broadcast_below(found.select("key"), MAX_BROADCAST_KEYS), "key", "left_semi")
    # copies of a text are verified once
    texts = some.groupBy("key").agg(F.first("text").alias("text")).join(found, "key").select("key", "at", words_of(F.col("text")).alias("words"))
    windows = texts.select("key", F.explode(F.transform("at", lambda a: F.struct(
        a["size"].alias("size"), a["pos"].alias("pos"),
        F.concat_ws(" ", F.slice("words", a["pos"], a["size"])).alias("window")))).alias("w")).select("key", "w.*")
    items = broadcast_below(bench.select("size", "window", "item_id"), MAX_BROADCAST_WINDOWS // 16)
    exact = windows.join(items, ["size", "window"])
    return exact.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("pos", "size", "item_id"))).alias("hits"))


def summary(found: DataFrame) -> DataFrame:
    """(key, n_hit, items): words inside any hit, and the hitting items sorted as strings."""
    covered = F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.sequence(h["pos"], h["pos"] + h["size"] - 1))))
    items = F.array_sort(F.array_distinct(F.transform(
        F.filter("hits", lambda h: h["item_id"].isNotNull()), lambda h: h["item_id"].cast("string"))))
    return found.select("key", F.size(covered).cast("bigint").alias("n_hit"), items.alias("items"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (MIN_SHARE_INVERSE * n_hit >= n_words)


def judge(documents: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (array), contaminated."""
    # null texts have a null key, which joins with nothing; most texts meet no partner, and with a
    # broadcast neither they nor the copies of one are moved
    found = broadcast_below(pin(summary(hits(documents, benchmark, n)), "window-summary"), MAX_BROADCAST_KEYS)
    docs = documents.select("doc_id", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"),
                            text_key(F.col("text")).alias("key"))
    out = docs.join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def remove_documents(documents: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    found = summary(hits(documents, benchmark, n))
    dirty = found.select(F.col("key").alias("__key"), F.col("n_hit").alias("__n_hit"))
    marked = documents.withColumn("__key", text_key(documents["text"]))
    # only texts with hits are counted again; most rows meet no partner
    joined = marked.join(broadcast_below(pin(dirty, "dirty"), MAX_BROADCAST_KEYS), "__key", "left")
    clean = F.col("__n_hit").isNull() | ~is_contaminated(F.col("__n_hit"), F.size(words_of(F.col("text"))))
    return joined.where(clean).select(*[F.col(f"`{c}`") for c in documents.columns])


def remove_spans(documents: DataFrame, benchmark: DataFrame, n: int = N, mask: str = " ") -> DataFrame:
    """The documents with every maximal run of hit words (and what stands between those words)
    replaced by ``mask``; other characters stay as they were."""
    found = hits(documents, benchmark, n).select(F.col("key").alias("__key"), F.array_distinct(F.flatten(
        F.transform("hits", lambda h: F.sequence(h["pos"], h["pos"] + h["size"] - 1)))).alias("__hit"))
    marked = documents.withColumn("__key", text_key(documents["text"])).join(found, "__key", "left")
    # every word position once, hit positions twice: after a sort a hit stands before its equal
    at = marked.withColumn("__words", F.regexp_extract_all("text", F.lit(CASED_WORD), F.lit(0))).withColumn(
        "__gaps", F.split("text", CASED_WORD)).withColumn("__at", F.sort_array(
            F.concat(F.sequence(F.lit(1), F.size("__words")), F.col("__hit"))))
    flags = at.withColumn("__flags", F.transform(F.filter(F.transform("__at", lambda p, k: F.struct(
        p.alias("p"), F.get("__at", k + 1).eqNullSafe(p).alias("hit"),
        F.get("__at", k - 1).eqNullSafe(p).alias("again"))), lambda x: ~x["again"]), lambda x: x["hit"]))
    parts = F.transform("__words", lambda w, k: F.concat(
        F.when(F.get("__flags", k) & F.coalesce(F.get("__flags", k - 1), F.lit(False)), "").otherwise(F.get("__gaps", k)),
        F.when(~F.get("__flags", k), w).when(F.coalesce(F.get("__flags", k - 1), F.lit(False)), "").otherwise(mask)))
    text = F.concat(F.array_join(parts, ""), F.element_at("__gaps", -1))
    clean = flags.withColumn("text", F.when(F.col("__hit").isNull(), F.col("text")).otherwise(text))
    return clean.select(*[F.col(f"`{c}`") for c in documents.columns])


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    from starloom.llm.common import read

    out = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '{WORD}') END AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM benchmark WHERE text IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), {N}) AS size,
               unnest(range(1, len(w) - least(len(w), {N}) + 2)) AS i
        FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM wins),
scan AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, sizes WHERE len(w) >= size)),
found AS (SELECT r, s.size, s.i, item_id FROM scan s JOIN wins USING (size, win)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {MIN_SHARE_INVERSE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
