"""Language identification, word first: known words score by their log frequency in each
language; a word never seen falls back to its longest known character n-grams, tried from long
to short at each place of the word.

The model is counted from labelled texts of the learning folds: at most ``TRAIN_DOCS`` documents
of each language (a hash of the id decides), and of each language's counts its ``MAX_WORDS`` most
frequent words and ``MAX_GRAMS`` n-grams, however many languages there are. Learnt are the
``MAX_LANGUAGES`` languages with the most documents (then the first in the alphabet); a column of
free text in place of languages gives as many, and ends no job. Words and n-grams keep the
languages that they occur in only (the others share one value), so that the broadcast model is
bounded by languages times words. Every text is then scored whole, in its own row.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text
when there is nothing to learn from; equal scores go to the language first in the alphabet; words without any
known n-gram say nothing; repeated rows are scored alike; very long texts are read piece by
piece; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import held, held_out, learnable, pin, read

UNKNOWN = "und"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
MAX_N = 5  # longest n-gram of "^word$"

TRAIN_DOCS = 5_000  # learnt from, for each language
MAX_WORDS, MAX_GRAMS = 25_000, 25_000  # of each language
MAX_LANGUAGES = 100
SMOOTHING = 0.5
MIN_SCORE = 0.5  # a document below it is rejected by :func:`keep`
KEPT_WORDS = 200_000  # words whose scores a worker remembers
BLOCK = 1 << 16  # words held at a time


def grams(word: str) -> Iterator[str]:
    marked = f"^{word}$"
    for n in range(1, MAX_N + 1):
        for i in range(len(marked) - n + 1):
            yield marked[i:i + n]


def training_rows(documents: DataFrame, max_docs: int = TRAIN_DOCS) -> DataFrame:
    """(lang, text) of the labelled rows to learn from."""
    rows = documents.where(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return rows.select("lang", "text").limit(0)
    spread = 1 << 30
    limits = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], int(spread * min(1.0, max_docs / r["count"])))])
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(spread)) < limits[F.col("lang")]).select(
        "lang", "text")


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        counts = {}
        for lang, text in zip(part["lang"], part["text"], strict=True):
            words = Counter(m.lower() for m in WORD.findall(text))
            counts.setdefault(lang, Counter()).update(words)
        for lang, words in counts.items():
            found = Counter()
            for w, c in words.items():
                for g in grams(w):
                    found[g] += c
            for kind, table in (("w", words), ("g", found)):
                yield pd.DataFrame({"lang": lang, "kind": kind, "item": list(table), "n": list(table.values())})


class Model:
    """Log frequencies by language of words and n-grams. ``words`` and ``grams`` give an item's row in
    one sparse table: the languages it occurs in, and by how much its log frequency there exceeds
    that of an item the language lacks (``lacking``, one vector for words and one for n-grams)."""

    def __init__(self, langs: list[str], words: dict[str, dict[str, int]], grams_: dict[str, dict[str, int]],
                 totals: dict[tuple[str, str], int]):
        self.langs = langs
        place = {x: k for k, x in enumerate(langs)}
        self.words = {w: k for k, w in enumerate(words)}
        self.grams = {g: k + len(words) for k, g in enumerate(grams_)}
        rows = [*words.values(), *grams_.values()]
        self.start = np.concatenate([[0], np.cumsum([len(by) for by in rows])]).astype(np.int64)
        self.lang = np.fromiter((place[x] for by in rows for x in by), np.int32)
        self.gain = np.log(np.fromiter((n for by in rows for n in by.values()), float) + SMOOTHING) - math.log(SMOOTHING)
        # n-grams compete with n-grams only
        self.lacking = np.array([[math.log(SMOOTHING) - math.log(totals.get((kind, x), 0) + SMOOTHING * (len(table) + 1))
                                  for x in langs] for kind, table in (("w", words), ("g", grams_))]).reshape(2, len(langs))

    def found(self, word: str) -> tuple[int, list[int]]:
        """(0 and the row of a known word), or (1 and the rows of the n-grams that stand for it)."""
        known = self.words.get(word)
        if known is not None:
            return 0, [known]
        marked, out, i = f"^{word}$", [], 0
        while i < len(marked):
            for n in range(min(MAX_N, len(marked) - i), 0, -1):
                row = self.grams.get(marked[i:i + n])
                if row is not None:
                    out.append(row)
                    i += n
                    break
            else:
                i += 1
        return 1, out

    def word(self, word: str) -> np.ndarray:
        """The word's score in each language."""
        kind, rows = self.found(word)
        out = len(rows) * self.lacking[kind]
        for r in rows:
            out[self.lang[self.start[r]:self.start[r + 1]]] += self.gain[self.start[r]:self.start[r + 1]]
        return out


def fit(documents: DataFrame, max_docs: int = TRAIN_DOCS) -> Model:
    counts = training_rows(documents, max_docs).mapInPandas(
        _count, "lang string, kind string, item string, n long").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    counts = pin(counts, "language-counts")
    totals = {(r["kind"], r["lang"]): r["n"] for r in counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    # a language's items are those of TRAIN_DOCS documents
    place = F.row_number().over(Window.partitionBy("kind", "lang").orderBy(F.desc("n"), "item"))
    best = counts.withColumn("place", place).where(F.col("place") <= F.when(F.col("kind") == "w", MAX_WORDS).otherwise(MAX_GRAMS))
    tables: dict[str, dict[str, dict[str, int]]] = {"w": {}, "g": {}}
    for r in best.select("kind", "lang", "item", "n").toLocalIterator():
        tables[r["kind"]].setdefault(r["item"], {})[r["lang"]] = r["n"]
    return Model(sorted({lang for _, lang in totals}), tables["w"], tables["g"], totals)


class Scorer(dict):
    """Scores texts; keeps the sparse scores of the words met (a bounded number)."""

    KEPT_ENTRIES = 1 << 22

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.rows = np.zeros((3, KEPT_WORDS + BLOCK), np.int64)  # first entry, entries; kind and items as one number
        self.lang, self.gain, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 16), 0

    def __missing__(self, word: str) -> int:
        m = self.model
        kind, found = m.found(word)
        at = [slice(m.start[r], m.start[r + 1]) for r in found]
        n = sum(x.stop - x.start for x in at)
        while self.used + n > len(self.lang):
            self.lang, self.gain = np.resize(self.lang, 2 * len(self.lang)), np.resize(self.gain, 2 * len(self.gain))
        k, to = len(self), self.used
        self.rows[:, k] = to, n, 2 * len(found) + kind
        for x in at:
            self.lang[to:to + x.stop - x.start], self.gain[to:to + x.stop - x.start] = m.lang[x], m.gain[x]
            to += x.stop - x.start
        self.used, self[word] = to, k
        return k

    def _sum(self, words: list[str]) -> np.ndarray:
        if len(self) > KEPT_WORDS or self.used > self.KEPT_ENTRIES:
            self.forget()
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        first, n, kinds = self.rows[:, ids]
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        total = np.bincount(self.lang[at], self.gain[at], len(self.model.langs))
        items = kinds >> 1
        known = int(items[kinds & 1 == 0].sum())
        return total + known * self.model.lacking[0] + (int(items.sum()) - known) * self.model.lacking[1]

    def score(self, text: str | None) -> tuple[str, float]:
        if not self.model.langs or not text:
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.model.langs)), 0
        if len(text) <= BLOCK:
            words = WORD.findall(text.lower())
            total, n = (self._sum(words), len(words)) if words else (total, 0)
        else:
            found = (m[0].lower() for m in WORD.finditer(text))
            while words := list(islice(found, BLOCK)):
                total, n = total + self._sum(words), n + len(words)
        if not n:
            return UNKNOWN, 0.0
        # words of a text depend on each other: the evidence grows as the root of their number
        odds = np.exp((total - total.max()) / math.sqrt(n))
        best = int(np.argmax(total))
        return self.model.langs[best], float(odds[best] / odds.sum())


def predict(documents: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``documents`` with the predicted language of their text and its probability."""
    shared, key = documents.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("lang string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = held(("language", key), lambda: Scorer(shared.value))
        for texts in parts:
            yield pd.DataFrame([scorer.score(t) for t in texts], columns=["lang", "score"])

    out = documents.withColumn("__language", run(documents["text"]))
    return out.withColumns({lang: F.col("__language.lang"), score: F.col("__language.score")}).drop("__language")


def keep(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language can be told, with their columns as they were."""
    rows = documents.select(F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row"), documents["text"])
    marked = predict(rows, fit(documents), "lang", "score")
    return marked.where((F.col("lang") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    out = predict(documents.select("doc_id", "text"), fit(documents.select("doc_id", "text", "lang")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
