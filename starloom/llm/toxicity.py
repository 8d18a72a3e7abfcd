"""Toxic spans by a linear-chain conditional random field; forward-backward marginals give the
offending offsets and the document's score.

Labels mark documents, not words, so tokens are labelled first: among words and beginnings of
words whose documents are toxic far more often than others', the ones that explain most toxic
documents are taken one by one, each explaining its documents away, so that a word that merely
keeps company with them is left out. In toxic documents the words so named are the labelled
tokens. The field (states: toxic or not; features: word, beginnings, ending, writing; transitions)
is then trained on sentences around them and on sentences of clean documents.

Training reads a bounded sample: at most ``TRAIN_DOCS`` labelled ids of either kind, some
``ROWS_PER_ID`` different texts of each, and ``TRAIN_SENTENCES`` sentences, of learnable rows, chosen by
hash. Scoring reads every whole text: the state chain runs through a sentence of any length,
sentences of a block are run together. A sentence of more than ``LONGEST`` words is run in
pieces of that size side by side, and what its pieces pass on to each other is their product of
transition matrices, so its marginals are those of the whole (but for a run of more than ``BLOCK``
words without a stop, which is cut there). A document's score is a logistic function, fitted on the training documents, of
its largest toxic marginal, the sum of its marginals above ``HIT`` and its number of words: a
beginning that now and then turns up in clean texts counts when it recurs.

Defined cases: null or empty text, or one without words, scores 0; without toxic labels to learn
from every score is 0; labels may be repeated (a document is toxic if any of its labels is) or
missing; repeated rows and ties score alike; very long texts are read in blocks; an empty table
gives no rows; other columns are kept.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import held, held_out, learnable, pin, read

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?\n]")
STOPS = frozenset(".!?\n")
DIM = 1 << 18  # hashed features
PREFIXES = range(3, 9)  # lengths of beginnings
LONGEST = 128  # words of a piece; of a sentence in training

TRAIN_DOCS, TRAIN_SENTENCES, ROWS_PER_ID = 4_000, 20_000, 4
MIN_DOCS, MIN_PRECISION = 3, 0.6  # toxic documents of a unit, and their share of its documents
HIT = 0.3
PREDICT_AT = 0.7
SPAN_AT = 0.5  # marginal of an offending word, whatever its document's score
KEPT_WORDS, BLOCK = 350_000, 1 << 18


def features(token: str) -> list[int]:
    low = token.lower()
    form = "A" if token.isupper() and len(token) > 1 else "a" if token.islower() else "Aa"
    return [zlib.crc32(x.encode()) % DIM for x in (
        f"w={low}", f"s={low[-3:]}", f"f={form}", "bias", *(f"p={low[:n]}" if len(low) > n else f"w={low}" for n in PREFIXES))]


def units(word: str) -> list[str]:
    """What a word may be known by: itself (marked at its end) and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) > n)]


# -- the field ----------------------------------------------------------------------------------


class Chains:
    """Chains of different lengths, longest first, run side by side: at place t the first
    ``count[t]`` chains go on. Positions are given as flat indices ``at[t]`` into the words."""

    def __init__(self, starts: np.ndarray, sizes: np.ndarray):
        order = np.argsort(-sizes, kind="stable")
        self.order, self.last = order, starts + sizes - 1
        starts, sizes = starts[order], sizes[order]
        longest = int(sizes[0]) if len(sizes) else 0
        self.count = np.searchsorted(-sizes, -np.arange(longest), "left")
        self.at = [starts[:c] + t for t, c in enumerate(self.count)]

    def marginals(self, odds: np.ndarray, trans: np.ndarray, before: np.ndarray | None = None,
                  after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(toxic marginal of each word, forward, backward), the two as ratios toxic / other.
        odds: exp of each word's score; trans[a, b]: weight of going from state a to b.
        before: the forward ratio of the word before each chain (NaN where none is); after: the
        backward ratio of its last word."""
        step = lambda r: (trans[0, 1] + r * trans[1, 1]) / (trans[0, 0] + r * trans[1, 0])
        forward, backward = np.empty_like(odds), np.ones_like(odds)
        if after is not None:
            backward[self.last] = after
        for t, at in enumerate(self.at):
            if t:
                forward[at] = odds[at] * step(forward[at - 1])
            elif before is None:
                forward[at] = odds[at]
            else:
                r = before[self.order]
                forward[at] = odds[at] * np.where(np.isnan(r), 1.0, step(np.nan_to_num(r)))
        for t in range(len(self.at) - 2, -1, -1):
            at = self.at[t][:self.count[t + 1]]
            s = odds[at + 1] * backward[at + 1]
            backward[at] = (trans[1, 0] + trans[1, 1] * s) / (trans[0, 0] + trans[0, 1] * s)
        both = forward * backward
        return both / (1 + both), forward, backward


def passed_on(odds: np.ndarray, trans: np.ndarray, starts: np.ndarray, sizes: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, after) of :meth:`Chains.marginals` for the pieces of sentences, given in order."""
    before, after = np.full(len(starts), np.nan), np.ones(len(starts))
    goes_on = np.flatnonzero(sentence[1:] == sentence[:-1]) + 1  # pieces that are not their sentence's first
    if not len(goes_on):
        return before, after
    long = np.unique(np.concatenate([goes_on, goes_on - 1]))
    opens = ~np.isin(long, goes_on)
    # the product of a piece's steps: into the next state, times its word's weights
    m = np.broadcast_to(np.eye(2), (len(long), 2, 2)).copy()
    for t in range(int(sizes[long].max())):
        on = sizes[long] > t
        step = np.broadcast_to(trans, (int(on.sum()), 2, 2)).copy()
        if t == 0:
            step[opens[on]] = 1.0  # nothing leads into a sentence's first word
        step[:, :, 1] *= odds[starts[long[on]] + t, None]
        m[on] = m[on] @ step
        m[on] /= m[on].sum(axis=(1, 2), keepdims=True)
    at = {int(k): i for i, k in enumerate(long)}
    for k in goes_on:
        v = np.array([0.5, 0.5]) if opens[at[k - 1]] else np.array([1.0, before[k - 1]])
        v = v @ m[at[k - 1]]
        before[k] = v[1] / v[0]
    for k in goes_on[::-1]:
        v = m[at[k]] @ np.array([1.0, after[k]])
        after[k - 1] = v[1] / v[0]
    return before, after


class Field:
    def __init__(self, weights: np.ndarray | None = None, trans: np.ndarray | None = None):
        self.weights = weights  # None: nothing was learnt
        self.document = np.zeros(4)
        self.trans = np.zeros((2, 2)) if trans is None else trans

    def train(self, sentences: list[list[str]], labels: list[list[int]], rounds: int = 60, rate: float = 0.5,
              decay: float = 1e-4) -> Field:
        """Full-batch AdaGrad on the conditional log-likelihood."""
        sizes = np.array([len(s) for s in sentences])
        starts = np.cumsum(sizes) - sizes
        chains = Chains(starts, sizes)
        rows: dict[str, list[int]] = {}
        feats = np.array([rows.get(w) or rows.setdefault(w, features(w)) for s in sentences for w in s])
        y = np.array([x for row in labels for x in row], float)
        inner = np.setdiff1d(np.arange(len(y)), starts)  # words with one before them in their chain
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[inner - 1].astype(int), y[inner].astype(int)), 1)
        weights, trans = np.zeros(DIM), np.zeros((2, 2))
        gw, gt = np.full(DIM, 1e-8), np.full((2, 2), 1e-8)
        for _ in range(rounds):
            odds, t = np.exp(np.clip(weights[feats].sum(axis=1), -30, 30)), np.exp(trans)
            p, forward, backward = chains.marginals(odds, t)
            pairs = np.empty((2, 2, len(inner)))
            s = odds[inner] * backward[inner]
            for a, left in ((0, 1.0), (1, forward[inner - 1])):
                pairs[a, 0], pairs[a, 1] = left * t[a, 0], left * t[a, 1] * s
            pairs /= pairs.sum(axis=(0, 1))
            grad = np.bincount(feats.ravel(), np.repeat(y - p, feats.shape[1]), DIM) - decay * len(y) * weights / 100
            grad_t = seen - pairs.sum(axis=2) - decay * trans
            gw, gt = gw + grad ** 2, gt + grad_t ** 2
            weights, trans = weights + rate * grad / np.sqrt(gw), trans + rate * grad_t / np.sqrt(gt)
        self.weights, self.trans = weights, np.exp(trans)
        return self

    def calibrate(self, rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rounds: int = 25) -> Field:
        """Newton's method for the document's logistic function. rows: as of :func:`evidence`."""
        w, ridge = np.zeros(rows.shape[1]), 0.1 * np.eye(rows.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
            grad = rows.T @ (weight * (toxic - p)) - ridge @ w
            w = w + np.linalg.solve((rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge, grad)
        self.document = w
        return self


def evidence(largest: np.ndarray, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    largest = np.clip(largest, 1e-4, 1 - 1e-4)
    return np.column_stack([np.ones_like(largest), np.log(largest / (1 - largest)), np.log1p(hits), np.log1p(words)])


# -- learning from document labels --------------------------------------------------------------


def training_texts(documents: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS) -> tuple[DataFrame, float]:
    """(doc_id, text, toxic) of a bounded sample of labelled learnable rows, and the number of
    documents that a clean one of it stands for, against a toxic one."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(learnable(F.col("doc_id")))
    sizes = {r[0]: r[1] for r in marks.groupBy((F.col("toxic") > 0).alias("t")).count().collect()}
    spread = 1 << 30
    share = {t: min(1.0, max_docs / sizes.get(t, 1)) for t in (True, False)}
    limit = F.when(F.col("toxic") > 0, int(spread * share[True])).otherwise(int(spread * share[False]))
    marks = pin(marks.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(spread)) < limit), "toxicity-ids")
    texts = documents.where(F.col("text").isNotNull()).select("doc_id", "text")
    # ids may repeat: of one with many rows some are drawn, and of equal rows one
    rows = texts.select("doc_id").join(F.broadcast(marks), "doc_id").groupBy("doc_id").count()
    drawn = F.pmod(F.xxhash64("text", F.lit("row")), F.lit(spread)) < spread * F.least(F.lit(1.0), ROWS_PER_ID / F.col("count"))
    sample = texts.join(F.broadcast(marks.join(rows, "doc_id")), "doc_id").where(drawn).withColumn("digest", F.xxhash64("text"))
    return sample.dropDuplicates(["doc_id", "digest"]).select(
        "doc_id", "text", (F.col("toxic") > 0).alias("toxic")), share[True] / share[False]


def toxic_units(texts: DataFrame, clean_weight: float = 1.0) -> list[str]:
    """The words and beginnings that explain the toxic documents of the sample."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            tables = {True: Counter(), False: Counter()}
            for r in part.itertuples(index=False):
                tables[bool(r.toxic)].update(_units_of(r.text))
            yield pd.DataFrame([(u, tables[True][u], tables[False][u]) for u in tables[True] | tables[False]],
                               columns=["unit", "t", "c"])

    sizes = {r[0]: r[1] for r in texts.groupBy("toxic").count().collect()}
    if not sizes.get(True):
        return []
    counts = texts.mapInPandas(count, "unit string, t long, c long").groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    precise = F.col("t") * (1 - MIN_PRECISION) >= MIN_PRECISION * F.col("c") * clean_weight
    often = pin(counts.where((F.col("t") >= MIN_DOCS) & precise), "toxic-units")
    # a unit's documents as bits; the sample's toxic documents are numbered from 1
    number = F.row_number().over(Window.orderBy("doc_id", F.xxhash64("text")))
    numbered = pin(texts.where("toxic").select(number.alias("number"), "text"), "toxic-documents")
    size = max(1, -(-int(sizes[True]) // 8))
    units_ = numbered.mapInPandas(_unit_rows, "number long, unit string").join(often, "unit")
    bits = units_.withColumn("block", F.bitmap_bucket_number("number")).groupBy("unit", "block").agg(
        F.substring(F.bitmap_construct_agg(F.bitmap_bit_position("number")), 1, size).alias("bits"))
    found: dict[str, int] = {}
    for r in bits.toLocalIterator():  # some hundred bytes a unit
        found[r["unit"]] = found.get(r["unit"], 0) | int.from_bytes(r["bits"], "little") << 32_768 * (r["block"] - 1)
    precision = {r["unit"]: r["t"] / (r["t"] + r["c"] * clean_weight) for r in often.collect()}
    support = {u: d.bit_count() for u, d in found.items()}  # of the sample's documents
    taken = []
    while found:
        unit = max(found, key=lambda u: (found[u].bit_count() * precision[u], len(u), u))
        docs = found.pop(unit)
        if docs.bit_count() < MIN_DOCS:
            break
        taken.append(unit)
        found = {u: rest for u, d in found.items() if (rest := d & ~docs)}
    # what others explained away, but is as frequent and hardly ever clean, is toxic all the same
    usual = sorted(support[u] for u in taken)[len(taken) // 2] if taken else 0
    return taken + sorted(u for u in support if u not in taken and precision[u] >= 0.95 and 2 * support[u] >= usual)


def _units_of(text: str) -> set[str]:
    return {u for w in {t.lower() for t in TOKEN.findall(text)} - STOPS for u in units(w)}


def _unit_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        yield pd.DataFrame([(r.number, u) for r in part.itertuples(index=False) for u in _units_of(r.text)],
                           columns=["number", "unit"])


def sentences_of(text: str) -> Iterator[list[str]]:
    out = []
    for token in TOKEN.findall(text):
        if token in STOPS or len(out) == LONGEST:
            if out:
                yield out
            out = []
        if token not in STOPS:
            out.append(token)
    if out:
        yield out


def fit(documents: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS) -> Field:
    texts, clean_weight = training_texts(documents, labels, max_docs)
    texts = pin(texts, "toxicity-sample")
    known = frozenset(toxic_units(texts, clean_weight))
    if not known:
        return Field()

    def pick(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sentences with a known unit, and a twentieth of the other clean ones."""
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                for k, s in enumerate(sentences_of(r.text)):
                    y = [int(not known.isdisjoint(units(w.lower()))) for w in s]
                    order = zlib.crc32(f"{r.doc_id} {k}".encode())
                    if any(y) or not r.toxic and order % 20 == 0:
                        rows.append((order, k, r.doc_id, s, y if r.toxic else [0] * len(s)))
            yield pd.DataFrame(rows, columns=["order", "k", "doc_id", "s", "y"])

    kept = texts.mapInPandas(pick, "order long, k long, doc_id long, s array<string>, y array<int>").orderBy(
        "order", "doc_id", "k").limit(TRAIN_SENTENCES).collect()
    field = Field().train([list(r["s"]) for r in kept], [list(r["y"]) for r in kept])
    shared = documents.sparkSession.sparkContext.broadcast(field)

    def weigh(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(shared.value)
        for part in parts:
            largest, hits, words = tagger.read(part["text"].tolist())
            yield pd.DataFrame({"a": largest, "b": hits, "c": words, "toxic": part["toxic"].astype(float)})

    rows = texts.mapInPandas(weigh, "a double, b double, c double, toxic double").toPandas()
    rows = rows.sort_values(list(rows.columns)).to_numpy()  # the same order, so the same sums, each time
    rows = rows[rows[:, 2] > 0]
    return field.calibrate(evidence(rows[:, 0], rows[:, 1], rows[:, 2]), rows[:, 3], np.where(rows[:, 3] > 0, 1.0, clean_weight))


# -- scoring --------------------------------------------------------------------------------------


class Tagger(dict):
    """Marginals of texts; keeps the scores of words met (a bounded number)."""

    def __init__(self, field: Field):
        super().__init__()
        self.field, self.odds = field, np.ones(KEPT_WORDS + BLOCK + 1)
        self.weights = None if field.weights is None else field.weights.tolist()
        self.update(dict.fromkeys(STOPS, 0))

    def __missing__(self, token: str) -> int:
        k = self[token] = len(self)
        weights = self.weights
        self.odds[k] = math.exp(max(-30.0, min(30.0, sum([weights[i] for i in features(token)]))))
        return k

    def marginals(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(toxic marginal, place) of the words among at most BLOCK tokens, besides stops."""
        if len(self) > KEPT_WORDS:
            self.clear()
            self.update(dict.fromkeys(STOPS, 0))
        ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        place = np.flatnonzero(ids)
        if not len(place):
            return np.empty(0), place
        # chains: runs of words without a stop between, in pieces of LONGEST
        first = np.flatnonzero(np.diff(place, prepend=-2) > 1)
        sizes = np.diff(np.append(first, len(place)))
        pieces = -(-sizes // LONGEST)
        starts = np.repeat(first, pieces) + LONGEST * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        sizes = np.minimum(LONGEST, np.repeat(first + sizes, pieces) - starts)
        odds, trans = self.odds[ids[place]], self.field.trans
        between = passed_on(odds, trans, starts, sizes, np.repeat(np.arange(len(first)), pieces))
        return Chains(starts, sizes).marginals(odds, trans, *between)[0], place

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: the largest marginal, the sum of those from HIT on, the number of words."""
        largest, hits, words = np.zeros((3, len(texts)))
        held, ends, size = [], [], 0

        def run() -> None:
            # a stop between texts; the places of a text are those below its end
            p, place = self.marginals([t for tokens in held for t in (*tokens, "\n")])
            cut = np.searchsorted(place, np.cumsum([len(t) + 1 for t in held]))
            for k, a, b in zip(ends, np.append(0, cut[:-1]), cut, strict=True):
                if b > a:
                    own = p[a:b]
                    largest[k] = max(largest[k], own.max())
                    hits[k] += own[own >= HIT].sum()
                    words[k] += b - a

        for k, text in enumerate(texts):
            if not text:
                continue
            tokens = (m[0] for m in TOKEN.finditer(text)) if len(text) > 8 * BLOCK else iter(TOKEN.findall(text))
            while part := list(islice(tokens, BLOCK)):
                if size + len(part) > BLOCK:  # marginals() has room for BLOCK new words
                    run()
                    held, ends, size = [], [], 0
                held.append(part)
                ends.append(k)
                size += len(part)
        if held:
            run()
        return largest, hits, words

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: the score and the largest marginal."""
        if self.field.weights is None:
            return np.zeros(len(texts)), np.zeros(len(texts))
        largest, hits, words = self.read(texts)
        odds = np.clip(evidence(largest, hits, words) @ self.field.document, -30, 30)
        return np.where(words > 0, 1 / (1 + np.exp(-odds)), 0.0), largest

    def spans(self, text: str, at: float = SPAN_AT) -> list[tuple[int, int, float]]:
        """(start, end, marginal) of the words of a text that are toxic with at least ``at``."""
        if self.field.weights is None:
            return []
        out, matches = [], TOKEN.finditer(text)
        while found := list(islice(matches, BLOCK)):  # the blocks of :meth:`read`
            p, place = self.marginals([m[0] for m in found])
            out += [(*found[place[k]].span(), float(p[k])) for k in np.flatnonzero(p >= at)]
        return out


def tag(documents: DataFrame, field: Field) -> DataFrame:
    """``documents`` with ``score`` and ``spans`` (character offsets of toxic words)."""
    shared, key = documents.sparkSession.sparkContext.broadcast(field), uuid.uuid4().hex

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,marginal:double>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = held(("toxicity", key), lambda: Tagger(shared.value))
        for texts in parts:
            texts = texts.tolist()
            scores, largest = tagger.scores(texts)
            yield pd.DataFrame({"score": scores, "spans": [
                [dict(zip(("start", "end", "marginal"), s, strict=True)) for s in tagger.spans(t)] if p >= SPAN_AT else []
                for t, p in zip(texts, largest, strict=True)]})

    out = documents.withColumn("__toxic", run(documents["text"]))
    return out.withColumns({"score": F.col("__toxic.score"), "spans": F.col("__toxic.spans")}).drop("__toxic")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    out = tag(documents, fit(documents, read(spark, sf_dir, "labels", "doc_id", "toxic")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))
