"""Exact length histogram: documents are counted by their encoded length, and suffix sums over
that histogram answer totals, quantiles and truncated totals for every context limit.

The histogram has one row per distinct length, however many documents there are. Its suffix
sums are made in two levels, within blocks of ``BLOCK`` lengths and over the blocks' totals, so
no task sums more than one block of lengths or one row per block.

Defined cases: null text has length 0, as empty text has; repeated rows count each; lengths
that many documents share are one row; a limit beyond the longest document truncates nothing;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.bpe import Encoder, Vocabulary, load_ranks
from starloom.llm.common import held, pin, read

BLOCK = 4096
LONG = 1 << 20  # characters from which on a text is read match by match, in bounded memory

def with_lengths(documents: DataFrame, vocabulary: Vocabulary, out: str = "n_tokens") -> DataFrame:
    """``documents`` with the number of tokens of their whole text."""
    key, shared = vocabulary.key, vocabulary.shared

    def make():
        content, pattern = shared.value
        ranks = load_ranks(content)
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), Encoder(ranks, pattern)

    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fast, long = held(("counts", key), make)
        for texts in parts:
            yield texts.map(lambda t: len(fast.encode_ordinary(t)) if len(t) < LONG else len(long.encode(t)) // 4)

    return documents.withColumn(out, run(F.coalesce(documents["text"], F.lit(""))))


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """(length, n_docs)."""
    return lengths.groupBy(F.col(column).alias("length")).agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length of the histogram: below (the next smaller length, null for the smallest),
    docs_at_least and tokens_at_least (documents of this length or more, and their tokens), and
    total_docs and total_tokens of all documents."""
    rows = hist.withColumn("block", F.floor(F.col("length") / BLOCK))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("length")).alias("t"),
                                       F.max("length").alias("m"))
    up, whole = Window.orderBy("block"), Window.partitionBy()
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"), F.lag("m").over(up).alias("m"),
        F.sum("d").over(whole).alias("total_docs"), F.sum("t").over(whole).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(blocks, "block").select(
        "length", "n_docs",
        F.coalesce(F.lead("length").over(Window.partitionBy("block").orderBy(F.desc("length"))), "m").alias("below"),
        (F.sum("n_docs").over(inside) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum(F.col("n_docs") * F.col("length")).over(inside) + F.col("tokens_after")).alias("tokens_at_least"),
        "total_docs", "total_tokens")


def _answer(limit, docs_at_least, tokens_at_least):
    """docs_over and truncated tokens at a limit, given the suffix sums from that limit on."""
    return F.col("total_tokens") - tokens_at_least + limit * docs_at_least


def at_lengths(sums: DataFrame) -> DataFrame:
    """The answers at every length that occurs: documents that fit, quantile, and the tokens that
    remain if every document is cut to that length."""
    over = F.col("docs_at_least") - F.col("n_docs")
    return sums.select(
        F.col("length").alias("context_limit"), "n_docs", over.alias("docs_over"),
        (F.col("total_docs") - over).alias("docs_fitting"),
        ((F.col("total_docs") - over) / F.col("total_docs")).alias("quantile"),
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_docs") * F.col("length")).alias("tokens_fitting"),
        _answer(F.col("length"), F.col("docs_at_least"), F.col("tokens_at_least")).alias("truncated_tokens"),
        "total_tokens")


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_at_least, truncated_tokens) for any limits: each falls between two
    lengths of the histogram, or beyond the longest."""
    wanted = F.array(*[F.lit(int(x)).cast("bigint") for x in sorted(set(limits))])
    between = sums.withColumn("context_limit", F.explode(F.filter(
        wanted, lambda x: (x <= F.col("length")) & (x > F.coalesce("below", F.lit(-1)))))).select(
        "context_limit", "docs_at_least",
        _answer(F.col("context_limit"), F.col("docs_at_least"), F.col("tokens_at_least")).alias("truncated_tokens"))
    longest = sums.where("docs_at_least = n_docs")
    return between.union(longest.withColumn("context_limit", F.explode(F.filter(wanted, lambda x: x > F.col("length")))).select(
        "context_limit", F.lit(0).cast("bigint"), "total_tokens"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of the documents does not pass."""
    fitting = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    wanted = F.array(*[F.lit(float(q)) for q in shares])
    return sums.withColumn("share", F.explode(F.filter(wanted, lambda q: (
        q * F.col("total_docs") <= fitting) & ((q * F.col("total_docs") > fitting - F.col("n_docs")) |
                                               F.col("below").isNull())))).select("share", "length")


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    lengths = with_lengths(read(spark, sf_dir, "documents", "text"), vocabulary)
    return at_lengths(suffix_sums(pin(histogram(lengths), "length-histogram")))
