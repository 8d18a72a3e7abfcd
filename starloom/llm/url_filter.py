"""URL filtering: rules first; other URLs by their words. Host names are split into words by a
unigram Viterbi search, and a multinomial naive Bayes model scores the words of host and path.

Word frequencies are counted over the visible text of all pages, but only for strings that some
host holds: a join of the hosts' substrings with the words decides, so no vocabulary is gathered.
Each distinct part of a host name (a whole run of letters) is split once, in its own row; a word
has at most ``MAX_WORD`` letters, as many as a label can hold. The naive Bayes model learns from weak labels: a URL whose words hold one
of ``SEEDS`` is an example of a blocked one. It reads at most ``TRAIN_URLS`` distinct (host,
path), chosen by hash, and knows all their words.

Defined cases: a null url or one without ``://`` has empty host and path, no word and the verdict
of the prior; rules of equal length that fit both: the first in the alphabet; without any URL
to learn from all are allowed; hosts without letters have no word; long hosts and paths are read
whole; repeated rows are judged alike; an empty table gives no rows; other columns are kept, but an input column named like a result is
replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, broadcast_below, pin, read

#: Fixed values of the contract.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
MAX_RULES = 1_000  # each URL is held against each rule in its own row

SEEDS = ("casino", "poker", "bet", "bets", "betting", "pills", "viagra", "adult", "porn", "xxx", "spam", "ads", "malware")
MIN_WORD_COUNT = 2
MAX_WORD = 63  # letters of a word (a label's limit)
TRAIN_URLS = 100_000
MAX_BROADCAST = 500_000

HOST, PATH = 1, 2
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_part(url: Column, group: int) -> Column:
    """Host (in lower case) or path of a url; empty for null or one without ``://``."""
    found = F.coalesce(F.regexp_extract(url, _URL, group), F.lit(""))
    return ascii_lower(found) if group == HOST else found


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    table = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"),
                               F.lit(r.partition("/")[0].lower()).alias("host"),
                               F.lit("/" + r.partition("/")[2]).alias("path"))
                      for r, v in sorted(rules, key=lambda x: (-len(x[0]), x[0]))])
    fits = F.filter(table, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    first = F.get(fits, 0)
    return F.when(first.isNotNull(), F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


# -- word segmentation ----------------------------------------------------------------------------


def parts_of(host: Column) -> Column:
    """Runs of letters of all labels but the last (the registry's)."""
    names = F.regexp_replace(host, r"\.?[^.]*$", "")
    return F.filter(F.split(names, r"[^\p{L}]+"), lambda x: x != "")


def page_words(html: Column) -> Column:
    """Words of a page's visible text, in lower case."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return F.array_remove(F.split(F.lower(F.coalesce(bare, F.lit(""))), r"[^\p{L}]+"), "")


def substrings(parts: DataFrame) -> DataFrame:
    """(id, at, word): every substring of a part of up to MAX_WORD letters."""
    # pieces that start every MAX_WORD letters and reach as far as a word from there can
    pieces = F.regexp_extract_all("part", F.lit(f"(?s)(?=(.{{1,{2 * MAX_WORD - 1}}})).{{1,{MAX_WORD}}}"), F.lit(1))
    n = F.length("piece")
    starts = parts.select("id", F.posexplode(pieces).alias("k", "piece")).select(
        "id", "k", "piece", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), n))).alias("i"))
    return starts.select("id", "k", "piece", "i", F.explode(
        F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), n - F.col("i") + 1))).alias("size")).select(
        "id", (F.col("k") * MAX_WORD + F.col("i")).alias("at"),
        F.substring(F.col("piece"), F.col("i"), F.col("size")).alias("word"))


def viterbi(part: str, words: dict[tuple[int, str], int], total: int) -> list[str]:
    """The likeliest split by word frequencies; an unknown run costs as much as a word that is
    rarer the longer it is."""
    best, back = [0.0] + [-math.inf] * len(part), [0] * (len(part) + 1)
    for end in range(1, len(part) + 1):
        for start in range(max(0, end - MAX_WORD), end):
            word = part[start:end]
            n = words.get((start, word))
            p = math.log(n / total) if n else math.log(10 / total) - (end - start) * math.log(10)
            if best[start] + p > best[end]:
                best[end], back[end] = best[start] + p, start
    out, end = [], len(part)
    while end:
        out.append(part[back[end]:end])
        end = back[end]
    return out[::-1]


def segment(parts: DataFrame, pages: DataFrame) -> DataFrame:
    """(part, words) for the distinct parts of host names, by the word counts of ``pages``."""
    parts = pin(parts.select(F.monotonically_increasing_id().alias("id"), "part"), "host-part-ids")
    held = pin(substrings(parts), "host-substrings")
    wanted = broadcast_below(pin(held.select("word").distinct(), "host-words"), MAX_BROADCAST)
    # counted before they are joined: a frequent word is one row a task, whatever the join
    counts = pages.select(F.explode(page_words(F.col("html"))).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= MIN_WORD_COUNT).join(wanted, "word", "left_semi")
    counts = pin(counts, "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 1
    # the seeds are words, whether pages use them or not
    seeds = parts.sparkSession.createDataFrame([(s, MIN_WORD_COUNT) for s in SEEDS], "word string, n bigint")
    counts = counts.unionByName(seeds).groupBy("word").agg(F.max("n").alias("n"))
    found = held.join(counts, "word").groupBy("id").agg(F.collect_list(F.struct("at", "word", "n")).alias("words"))
    rows = parts.join(found, "id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [viterbi(p, {} if w is None else {(x["at"] - 1, x["word"]): x["n"] for x in w}, total)
                   for p, w in zip(batch["part"], batch["words"], strict=True)]
            yield pd.DataFrame({"part": batch["part"], "words": out})

    return rows.mapInPandas(run, "part string, words array<string>")


def host_words(hosts: DataFrame, pages: DataFrame) -> DataFrame:
    """(host, words) for distinct hosts."""
    split = pin(hosts.select("host", F.posexplode(parts_of(F.col("host"))).alias("k", "part")), "host-parts")
    done = pin(segment(split.select("part").distinct(), pages), "host-segments")
    return split.join(broadcast_below(done, MAX_BROADCAST), "part").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("k", "words"))).alias("x")).select(
        "host", F.flatten(F.col("x.words")).alias("words"))


# -- naive Bayes ------------------------------------------------------------------------------------


class Bayes:
    """Multinomial naive Bayes of two classes."""

    def __init__(self, counts: dict[str, tuple[int, int]], urls: tuple[int, int]):
        totals = [sum(c[k] for c in counts.values()) + len(counts) + 1 for k in (0, 1)]
        self.prior = math.log((urls[1] + 1) / (urls[0] + 1))
        self.unknown = math.log(totals[0] / totals[1])
        self.weights = {w: math.log((c[1] + 1) / (c[0] + 1)) + self.unknown for w, c in counts.items()}

    def score(self, words: list[str]) -> float:
        """Probability that a URL of these words is to be blocked."""
        odds = self.prior + sum(self.weights.get(w, self.unknown) for w in words)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def path_words(path: Column) -> Column:
    """Words of a path, in lower case; a number is one word, whatever it is."""
    marked = F.regexp_replace(F.lower(path), r"\p{N}+", " 0 ")
    return F.array_remove(F.split(marked, r"[^\p{L}0]+"), "")


def fit(urls: DataFrame) -> Bayes:
    """From rows (host, path, words): a bounded sample of the distinct URLs, weakly labelled."""
    rows = urls.select("host", "path", "words").dropDuplicates(["host", "path"])
    n, spread = urls.select("host", "path").distinct().count(), 1 << 30
    rows = rows.where(F.pmod(F.xxhash64("host", "path"), F.lit(spread)) < int(spread * min(1.0, TRAIN_URLS / max(1, n))))
    rows = pin(rows.withColumn("bad", F.arrays_overlap("words", F.array(*map(F.lit, SEEDS))).cast("int")), "url-sample")
    sizes = dict(rows.groupBy("bad").count().collect())
    table = rows.select("bad", F.explode("words").alias("w")).groupBy("w").agg(
        F.sum(1 - F.col("bad")).alias("good"), F.sum("bad").alias("bad")).collect()  # words of TRAIN_URLS URLs
    return Bayes({r["w"]: (r["good"], r["bad"]) for r in table}, (sizes.get(0, 0), sizes.get(1, 0)))


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the model's block probability ``score``."""
    rows = pages.withColumns({"__host": url_part(pages["url"], HOST), "__path": url_part(pages["url"], PATH)})
    hosts = rows.select(F.col("__host").alias("host")).distinct()
    words = pin(host_words(hosts, pages), "hosts").select(F.col("host").alias("__h"), F.col("words").alias("__hw"))
    rows = rows.join(broadcast_below(words, MAX_BROADCAST), F.col("__host") == F.col("__h"), "left")
    none = F.array().cast("array<string>")
    rows = rows.withColumn("__words", F.concat(F.coalesce("__hw", none), path_words(F.col("__path"))))
    model = fit(rows.select(F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__words").alias("words")))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(shared.value.score)

    out = rows.withColumns({"__score": score("__words"), "__rule": fitting_rule(F.col("__host"), F.col("__path"), rules)})
    by_model = F.when(F.col("__score") >= 0.5, "block").otherwise("allow")
    return out.select(*[F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")],
                      F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule.rule").alias("rule"),
                      F.coalesce("__rule.verdict", by_model).alias("verdict"), F.col("__score").alias("score"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict", "score")
