"""Distinct counts of dense numbers by bitmaps: a bit a number, 64 numbers a word.

``COUNT(DISTINCT x)`` sends every (group, x) pair through a shuffle unless rows lie together by x.
With dense numbers each task sets the bits of its own numbers and sends one word for each group and
64 numbers that it met; words are merged by OR, and the set bits are added up. So a group costs at most
one row of some bytes for each of its numbers, however often a number occurs, and a 64th of that where
neighbouring numbers lie in the same task. A sparse group costs no more: a bitmap of 4 KB for 32,768
numbers would be built by every task for every group and block, which grows with tasks times numbers.
Bitmaps can also be stored and merged with those of later loads (:func:`merged`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "__block", "__bits"
WORD_BITS = 6  # 64 numbers a word


def bitmaps(df: DataFrame, groups: Sequence[str], number: str, *sums: Column) -> DataFrame:
    """(groups, block, bits, further aggregates) of the non-null numbers (1, 2, ...) of each group."""
    n = F.col(number).cast("long") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (n.bitwiseAND(F.lit(63))).cast("int"))
    return df.withColumn(BLOCK, F.shiftright(n, WORD_BITS)).withColumn(BITS, bit).groupBy(*groups, BLOCK).agg(
        F.bit_or(BITS).alias(BITS), *sums)


def merged(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of several loads as one for each group and block."""
    return parts.groupBy(*groups, BLOCK).agg(F.bit_or(BITS).alias(BITS))


def n_set() -> Column:
    """The distinct numbers of a group, as an aggregate over its blocks' bitmaps."""
    return F.sum(F.when(F.col(BLOCK).isNotNull(), F.bit_count(BITS)).otherwise(0))
