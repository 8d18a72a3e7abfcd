"""Hot-group handling for per-group numbering and keyed joins.

``ROW_NUMBER() OVER (PARTITION BY g ORDER BY o)`` sends each group to one task, and so does
a sort-merge join on ``g``. When a single group holds a large share of all rows (one huge
order, say), that task works alone. The operators here count rows per group first (a
partial aggregate, so the count itself is skew-proof) and split the input:

* ordinary groups keep the plain window / shuffle join;
* the few hot groups are joined against a broadcast of their (few) partner rows and
  numbered with the distributed range-partitioned numbering of ``ranking.row_number`` over
  ``(g, o)``, re-based to start at 1 inside each group.

Hot groups are found by counting the rows of hash groups of keys first (at most ``HASH_GROUPS`` rows a
task): only a hash group with more rows than the threshold can hold a hot key, and only the
keys of such groups are counted one by one. There are at most ``rows / threshold`` hot keys, so the
table is broadcast; when no group is hot the extra branch is skipped entirely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators import ranking as R

# A group with more rows than this is treated as hot.
HOT_GROUP_ROWS = 1_000_000
# Groups that keys are hashed to for the first count.
HASH_GROUPS = 65_536


def hot_keys(df: DataFrame, keys: Sequence[str], threshold: int | None = None) -> DataFrame:
    """Key values that hold more than ``threshold`` rows, pinned (a small table)."""
    threshold = HOT_GROUP_ROWS if threshold is None else threshold
    group = F.pmod(F.xxhash64(*keys), F.lit(HASH_GROUPS))
    large = df.groupBy(group.alias("__group")).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > F.lit(threshold))
    groups = [r["__group"] for r in large.select("__group").collect()]  # at most HASH_GROUPS, nearly always none
    df = df.where(group.isin(groups)) if groups else df.where(F.lit(False))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return R.pin(counts.where(F.col("__rows") > F.lit(threshold)).select(*keys))


def split_hot(
    df: DataFrame, keys: Sequence[str], threshold: int | None = None, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups or None, hot keys or None). ``counted``: a table
    with the same rows' keys that is cheaper to count."""
    keys = list(keys)
    hot = hot_keys(df if counted is None else counted, keys, threshold)
    if hot.isEmpty():
        return df, None, None
    hot_b = F.broadcast(hot)  # at most rows / threshold keys
    return df.join(hot_b, keys, "left_anti"), df.join(hot_b, keys, "left_semi"), hot


def number_hot(
    hot_rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, out_type: str = "int"
) -> DataFrame:
    """Per-group row numbers for rows of hot groups, without a per-group task."""
    keys, order = list(keys), list(order)
    numbered = R.row_number(hot_rows, [R.asc(c, nulls_first=True) for c in keys + order], out="__grn")
    first = numbered.groupBy(*keys).agg(F.min("__grn").alias("__first"))
    return (
        numbered.join(F.broadcast(first), keys)
        .withColumn(out, (F.col("__grn") - F.col("__first") + 1).cast(out_type))
        .drop("__grn", "__first")
    )


def row_number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    threshold: int | None = None,
    out_type: str = "int",
    partitions: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) that never gives one task more
    than ``threshold`` rows of a single group to sort. ``partitions``: the rows are partitioned into
    so many by the keys, for a step that needs them to lie like that (a bucketed write). ``counted``:
    a written table with the same rows' keys, which are then counted there and not by evaluating ``df``."""
    keys, order = list(keys), list(order)
    w = Window.partitionBy(*keys).orderBy(*order)
    normal, hot_rows, _ = split_hot(df, keys, threshold, counted)
    if partitions:
        normal = normal.repartition(partitions, *keys)
    numbered = normal.withColumn(out, F.row_number().over(w).cast(out_type))
    if hot_rows is None:
        return numbered
    return numbered.unionByName(number_hot(hot_rows, keys, order, out, out_type).select(*numbered.columns))
