"""N-gram Jaccard self-join with Bayesian pruning of candidates.

Texts are sets of shingles of ``SHINGLE`` words (lower-cased runs of letters, digits and other
non-ASCII characters). Two texts link if the Jaccard similarity of their sets is at least
``THRESHOLD``. Texts with the same set form a class, which is compared once however many
copies it has; the largest group of copies costs one partial aggregation.

1. Each text gets ``HASHES`` MinHash values: band keys (``ROWS`` values each) and one byte of each
   value. At similarity 0.8 two sets share no band with a probability below 2e-7.
2. Classes that share a band are candidates. A band bucket of up to ``PAIRED`` classes gives its
   pairs; of a larger one each class is tied to one head, so no bucket is expanded. A class in one
   large bucket only (texts with a common passage) is not tied: two sets of similarity 0.8 share a
   single band, and that a large one, with a probability below 3e-6.
3. Pairs are pruned: their bytes are compared ``STEP`` at a time, and a pair is dropped as soon as
   the posterior probability (uniform prior) that its similarity reaches the threshold falls
   below ``TOLERANCE``.
4. What remains, pairs and ties, is grouped by connected components. Members of a component are
   dealt to cells by the size of their sets, sets of linked texts lying in the same or neighbouring
   cells, and in a cell to chunks of bounded size. Each pair of chunks that may hold links is one
   group of rows: there all pairs are pruned as in 3 and the rest verified exactly on the
   shingles. It returns each member's number of links and one edge to its local root, never the
   pairs.
5. The edges' components are the near-duplicate groups.

A hot component costs, for each cell of m classes, m * m / 2 byte comparisons and as many with each
neighbouring cell, in independent tasks of bounded memory; its rows shuffled grow with
m * (m / CHUNK).

Defined cases: a null or empty text (no word) links with nothing; a text of fewer than
``SHINGLE`` words is one shingle of all its words; repeated rows and equal ids are documents of
their own; a document without an id counts as a link of others and has the class id of its
group (null if no member has an id); an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, broadcast_below, pin, read
from starloom.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
STEP, TOLERANCE = 8, 1e-9
PAIRED = 16  # classes of a band bucket that is expanded to pairs: at most 7.5 pairs a class
LEAST_HOT = 2  # large buckets of a class that is tied
CHUNK, CHUNK_SHINGLES = 1024, 1 << 20  # classes and shingles of a chunk, about
CELL = 1 / THRESHOLD + 1e-5  # ratio of the set sizes of neighbouring cells: a little over that of linked sets
MAX_BROADCAST = 500_000  # rows of up to about 60 bytes

#: Fixed values of the contract: the words.
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

_RANDOM = np.random.default_rng(20_240_901)
_A = (_RANDOM.integers(1, 1 << 32, HASHES, np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RANDOM.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler(dict):
    """Sets of shingle hashes; keeps the hashes of words met (a bounded number)."""

    KEPT = 500_000

    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles of a text in lower case."""
        if len(self) > self.KEPT:
            self.clear()
        words = WORD.findall(text)
        n = len(words)
        if not n:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.__getitem__, words), np.uint64, n)
        if n < SHINGLE:
            h = np.concatenate([h, np.zeros(SHINGLE - n, np.uint64)])
        rows = len(h) - SHINGLE + 1
        out = h[:rows].copy()
        for k in range(1, SHINGLE):
            out *= _P
            out += h[k:k + rows]
        return np.unique(_mix(out))


def minhash(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 2048):
        out = np.minimum(out, (_A[:, None] * x[None, k:k + 2048] + _B[:, None]).min(axis=1))
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    v = values.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _P
    for k in range(ROWS):
        key = _mix(key * _P + v[:, k])
    return key.view(np.int64)


def _betainc_tail(a: int, b: int, at: float) -> float:
    """P(X > at) for X ~ Beta(a, b) with whole a, b: a binomial sum."""
    n = a + b - 1
    if at <= 0:
        return 1.0
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                        + i * math.log(at) + (n - i) * math.log1p(-at)) for i in range(a))


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(compared, least matches to go on): bytes match by chance too, so similarity s shows as
    p = s + (1 - s) / 256; the posterior of p is a Beta cut at 1 / 256."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        p = threshold + (1 - threshold) / 256
        ok = next(m for m in range(n + 1) if _betainc_tail(m + 1, n - m + 1, p) >= tolerance * _betainc_tail(
            m + 1, n - m + 1, 1 / 256))
        out.append((n, ok))
    return out


LEAST = least_matches()


def survivors(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Indices of the rows (byte values of pairs) that Bayesian pruning keeps."""
    at, found = np.arange(len(left)), np.zeros(len(left), np.int32)
    for n, least in LEAST:
        found = found + (left[at, n - STEP:n] == right[at, n - STEP:n]).sum(axis=1)
        on = found >= least
        at, found = at[on], found[on]
        if not len(at):
            break
    return at


def enough(common: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Whether sets of sizes n and m with so many common members reach the threshold."""
    return common >= threshold * (n + m - common) - 1e-9


# -- Spark steps ------------------------------------------------------------------------------


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def signatures(documents: DataFrame) -> DataFrame:
    """(doc_id, key, fp, n, sig, bands) of each text: key and fp are digests of the text and of its
    shingle set. A text without a word has n = 0 and no fp, sig or bands."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for part in parts:
            rows = []
            for doc_id, key, text in zip(part["doc_id"], part["key"], part["text"], strict=True):
                s = shingler.shingles(text)
                if not len(s):
                    rows.append((doc_id, key, None, 0, None, None))
                    continue
                values = minhash(s)
                rows.append((doc_id, key, hashlib.blake2b(s.tobytes(), digest_size=16).digest(), len(s),
                             values.astype(np.uint8).tobytes(), band_keys(values)))
            out = pd.DataFrame(rows, columns=["doc_id", "key", "fp", "n", "sig", "bands"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text_key(text).alias("key"), ascii_lower(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, key binary, fp binary, n long, sig binary, bands array<long>")


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per shingle set: fp, n, sig, bands, copies, a text's key, the smallest doc_id."""
    return signed.groupBy("fp").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"),
        F.count("*").alias("copies"), F.min("key").alias("key"), F.min("doc_id").alias("doc_id"))


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of small buckets and ties (a, b) of large ones."""
    spread = classes.select("fp", F.explode("bands").alias("band"))
    buckets = spread.groupBy("band").agg(F.count("*").alias("m"), F.min("fp").alias("head")).where("m > 1")
    buckets = broadcast_below(pin(buckets, "buckets"), MAX_BROADCAST)
    members = pin(spread.join(buckets, "band"), "bucket-members")
    hot = members.where(F.col("m") > PAIRED).withColumn("hot", F.count("*").over(Window.partitionBy("fp")))
    ties = hot.where((F.col("hot") >= LEAST_HOT) & (F.col("fp") != F.col("head"))).select(
        F.col("head").alias("a"), F.col("fp").alias("b")).distinct()
    small = members.where(F.col("m") <= PAIRED).groupBy("band").agg(F.array_sort(F.collect_list("fp")).alias("x"))
    pairs = small.select("x", F.posexplode("x").alias("i", "a")).select(
        "a", F.explode(F.expr("slice(x, i + 2, size(x))")).alias("b")).distinct()
    return pairs, ties


def pruned(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that may reach the threshold, judged by size and, step by step, by MinHash."""
    side = lambda x: classes.select(F.col("fp").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                left, right = (np.frombuffer(b"".join(part[c]), np.uint8).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
                yield part.iloc[survivors(left, right)][["a", "b"]]

    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b"))
    return joined.mapInPandas(run, "a binary, b binary")


def _verify(rows: list[tuple]) -> pd.DataFrame:
    """All pairs of one pair of chunks. rows: (same, in the first chunk, fp, n, copies, sig, shingles)."""
    rows.sort(key=lambda r: r[3])
    same = rows[0][0]
    side = np.array([r[1] for r in rows])
    n = np.array([r[3] for r in rows], np.int64)
    copies = np.array([r[4] for r in rows], np.int64)
    sig = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(-1, HASHES)
    sets = [np.frombuffer(r[6], np.uint64) for r in rows]
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(n)
    mark = np.zeros(len(codes), bool)
    links, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
    for i in range(len(rows)):
        last = int(np.searchsorted(n, n[i] / THRESHOLD + 1e-6, "right"))
        others = np.arange(i + 1, last)
        if not same:
            others = others[side[others] != side[i]]
        others = others[survivors(np.broadcast_to(sig[i], (len(others), HASHES)), sig[others])] if len(others) else others
        if not len(others):
            continue
        own = codes[ends[i] - n[i]:ends[i]]
        mark[own] = True
        first, stop = others[0], others[-1] + 1
        start = ends[first] - n[first]
        common = np.add.reduceat(mark[codes[start:ends[stop - 1]]], ends[first:stop] - n[first:stop] - start, dtype=np.int64)
        mark[own] = False
        linked = others[enough(common[others - first], n[i], n[others])]
        if len(linked):
            links[i] += copies[linked].sum()
            links[linked] += copies[i]
            roots = np.unique(np.append(root[linked], root[i]))
            root[np.isin(root, roots)] = roots[0]
    hit = np.flatnonzero(links)
    named: dict[int, bytes] = {}  # a group's root is its smallest member, so that edges lead up from it
    for k in hit:
        named[root[k]] = min(rows[k][2], named.get(root[k], rows[k][2]))
    return pd.DataFrame({"fp": [rows[k][2] for k in hit], "links": links[hit], "root": [named[root[k]] for k in hit]})


def dealt(members: DataFrame) -> DataFrame:
    """``members`` (label, fp, n, ...) with their cell and chunk and the chunk pairs that they meet in:
    ``meets``, structs (lo, i, hi, j) of chunk i of cell lo and chunk j of cell hi. A group that fits one
    chunk is one cell; a label has one row a cell, some sixty at most, in the windows here."""
    members = members.withColumn("cell", F.floor(F.log("n") / math.log(CELL)))
    sizes = members.groupBy("label", "cell").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    group = Window.partitionBy("label")
    sizes = sizes.withColumn("one", (F.sum("m").over(group) <= CHUNK) & (F.sum("s").over(group) <= CHUNK_SHINGLES))
    sizes = sizes.withColumn("chunks", F.when(F.col("one"), F.lit(1).cast("bigint")).otherwise(
        F.ceil(F.greatest(F.col("m") / CHUNK, F.col("s") / CHUNK_SHINGLES))))
    by_cell, none = group.orderBy("cell"), F.lit(0).cast("bigint")
    beside = lambda f, d: F.when(~F.col("one") & (f("cell").over(by_cell) == F.col("cell") + d),
                                 f("chunks").over(by_cell)).otherwise(none)
    sizes = sizes.withColumns({"below": beside(F.lag, -1), "above": beside(F.lead, 1)}).drop("m", "s")
    out = members.join(sizes, ["label", "cell"]).withColumns({
        "cell": F.when(F.col("one"), none).otherwise(F.col("cell")), "chunk": F.pmod(F.xxhash64("fp"), F.col("chunks"))})
    own, at = F.col("cell"), F.col("chunk")

    def meet(n: Column, lo: Column, i, hi: Column, j) -> Column:
        return F.transform(F.filter(F.sequence(none, F.greatest(n - 1, none)), lambda o: o < n), lambda o: F.struct(
            lo.alias("lo"), i(o).alias("i"), hi.alias("hi"), j(o).alias("j")))

    mine, other = lambda o: at, lambda o: o
    return out.withColumn("meets", F.concat(
        meet(F.col("chunks"), own, lambda o: F.least(at, o), own, lambda o: F.greatest(at, o)),
        meet(F.col("below"), own - 1, other, own, mine),
        meet(F.col("above"), own, mine, own + 1, other))).drop("one", "chunks", "below", "above")


def linked(documents: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """(fp, links, root): exact links of each class within each pair of chunks of its group."""
    members = groups.join(classes.select("fp", "n", "copies", "sig", "key"), groups["node"] == classes["fp"]).drop("node")
    members = pin(dealt(pin(members, "groups")), "group-members")
    # one text of each class, its shingles made again
    keys = members.select("key").distinct()
    texts = documents.select("text").where(F.col("text").isNotNull()).withColumn("key", text_key(F.col("text"))).join(
        broadcast_below(pin(keys, "group-keys"), MAX_BROADCAST), "key", "left_semi").groupBy("key").agg(
        F.first("text").alias("text"))

    def shingle(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for part in parts:
            yield pd.DataFrame({"key": part["key"], "shingles": [shingler.shingles(t).tobytes() for t in part["text"]]})

    sets = texts.select("key", ascii_lower(F.col("text")).alias("text")).mapInPandas(shingle, "key binary, shingles binary")
    met = members.join(sets, "key").withColumn("at", F.explode("meets")).select(
        "label", "at.*", "cell", "chunk", "fp", "n", "copies", "sig", "shingles")
    block = ["label", "lo", "i", "hi", "j"]
    blocks = met.select(
        *block, ((F.col("lo") == F.col("hi")) & (F.col("i") == F.col("j"))).alias("same"),
        ((F.col("cell") == F.col("lo")) & (F.col("chunk") == F.col("i"))).alias("first"),
        "fp", "n", "copies", "sig", "shingles").repartition(*block).sortWithinPartitions(*block)

    def verify(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, out = None, [], []
        for part in parts:
            for r in part.itertuples(index=False):
                if (r.label, r.lo, r.i, r.hi, r.j) != at:
                    if len(held) > 1:
                        out.append(_verify(held))
                    at, held = (r.label, r.lo, r.i, r.hi, r.j), []
                held.append((r.same, r.first, r.fp, r.n, r.copies, r.sig, r.shingles))
            if out:
                yield pd.concat(out)
                out = []
        if len(held) > 1:
            yield _verify(held)

    return blocks.mapInPandas(verify, "fp binary, links long, root binary")


def join(documents: DataFrame, wordless: bool = False) -> DataFrame:
    """(doc_id, key, fp, class_id, n_links, copies) of each text with a word: ``class_id`` is the
    smallest doc_id of its near-duplicate group, ``n_links`` the number of documents it links with.
    With ``wordless``, the texts without a word too, each a class of its own."""
    every = pin(signatures(documents), "signatures")
    signed = every.where("n > 0")
    classes = pin(classes_of(signed), "classes")
    pairs, ties = candidates(classes)
    groups = components(pruned(pairs, classes).union(ties))
    found = pin(linked(documents, classes, groups), "links")
    labels = components(found.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("fp").agg(F.sum("links").alias("links"))
    named = classes.select("fp", "doc_id", "copies").join(links, "fp", "left").join(
        labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "doc_id", "copies", "links", F.coalesce("label", "fp").alias("label"))
    named = pin(named, "class-links")
    ids = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    info = named.join(ids, "label").select(
        "fp", "label", "class_id", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    found = signed.select("doc_id", "key", "fp").join(info, "fp")
    if not wordless:
        return found
    return found.unionByName(every.where("n = 0").select(
        "doc_id", "key", "fp", F.lit(None).cast("binary").alias("label"), F.col("doc_id").alias("class_id"),
        F.lit(1).cast("bigint").alias("copies"), F.lit(0).cast("bigint").alias("n_links")))


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` with one document of each near-duplicate group, that with the smallest id
    (then the smallest text digest); those without a word all stay."""
    found = pin(join(documents).where("n_links > 0").select("doc_id", "key", "label"), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = found.groupBy("label").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("__id"), F.col("first.key").alias("__k"), F.lit(True).alias("__first"))
    others = found.select(F.col("doc_id").alias("__id"), F.col("key").alias("__k")).distinct()
    firsts, others = (broadcast_below(pin(x, "decisions"), MAX_BROADCAST) for x in (first, others))
    marked = documents.select(F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row"),
                              documents["doc_id"].alias("id"), text_key(documents["text"]).alias("key"))
    same = lambda x: marked["key"].eqNullSafe(x["__k"]) & marked["id"].eqNullSafe(x["__id"])
    alone = marked.join(others, same(others), "left_anti").select("row.*")
    # repeated rows of the chosen document are one
    chosen = marked.join(firsts, same(firsts), "left_semi").dropDuplicates(["id", "key"]).select("row.*")
    return alone.unionAll(chosen)


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    return join(documents, wordless=True).select("doc_id", "class_id", "n_links", "copies")
