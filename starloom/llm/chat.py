"""Chat formatting with cumulative-snapshot collapse: logs often hold a conversation again each
time it grew. A conversation whose turns are the first turns of a longer one, or that repeats
another, is dropped; what remains is rendered.

Each turn's place, role and text are hashed; the running sums of four 32-bit parts of that
SHA-256 are the prefix's identity (with its length), so prefixes of all conversations are
compared as short keys: equal conversations meet in one aggregation, and an anti-join drops
those that are a proper prefix. Sums are made in parts of ``BLOCK`` turns and over the parts'
totals, so that a conversation of very many turns is spread over tasks and never gathered; its
rendering comes part by part.

Turns are taken in the order of (turn, role, text). Defined cases: a null role or text is
rendered as empty and differs from no other empty one; turns without a number come first; equal
turn numbers are ordered by role and text; equal rows are turns of their own; rows without a
conversation id belong to none and are left out; of equal conversations that with the smallest id stays; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import pin, read
from starloom.operators.skew import row_number_within

BLOCK = 256  # turns of a part
#: Fixed values of the format.
OPEN, CLOSE, END = "<|im_start|>", "<|im_end|>", "\n"
SUMS = ["s0", "s1", "s2", "s3"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, place, role, text): turns with their place, from 1, and the part of BLOCK
    turns that they belong to, from 0. A conversation of very many rows is numbered by ranges."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = row_number_within(rows, ["conv_id"], ["turn", "role", "text"], "place", out_type="bigint")
    return placed.select("conv_id", F.expr(f"(place - 1) div {BLOCK}").alias("part"), "place", "role", "text")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, s0..s3): the identity of each conversation's first ``place`` turns."""
    digest = F.sha2(F.concat_ws("\x1f", F.col("place").cast("string"), F.length("role").cast("string"), "role", "text"), 256)
    parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(s) for i, s in enumerate(SUMS)]
    rows = turns.select("conv_id", "part", "place", *parts)
    totals = rows.groupBy("conv_id", "part").agg(*[F.sum(s).alias(s) for s in SUMS])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("conv_id", "part", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"b_{s}") for s in SUMS])
    inside = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("conv_id", "part", "place", *[F.sum(s).over(inside).alias(s) for s in SUMS]).join(
        starts, ["conv_id", "part"]).select("conv_id", "place", *[(F.col(s) + F.col(f"b_{s}")).alias(s) for s in SUMS])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that no other continues, one of equal ones."""
    found = pin(prefixes(turns), "turn-prefixes")
    ends = found.groupBy("conv_id").agg(F.max_by(F.struct("place", *SUMS), "place").alias("e")).select("conv_id", "e.*")
    whole = ends.groupBy("place", *SUMS).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    lengths = ends.select("conv_id", F.col("place").alias("n"))
    proper = found.join(lengths, "conv_id").where("place < n").select("place", *SUMS).distinct()
    return whole.join(proper, ["place", *SUMS], "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "copies")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, part, turns, text): each part of a conversation, at most BLOCK turns, as one string."""
    return turns.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct(
        "place", F.concat(F.lit(OPEN), "role", F.lit(END), "text", F.lit(CLOSE + END)).alias("line")))).alias("x")).select(
        "conv_id", "part", F.size("x").cast("bigint").alias("turns"), F.array_join(F.col("x.line"), "").alias("text"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, turns, text, n_turns, copies) of the maximal conversations."""
    turns = pin(ordered_turns(conversations), "turns")
    kept = pin(maximal(turns), "maximal-conversations")
    return render(turns.join(kept.select("conv_id"), "conv_id", "left_semi")).join(kept, "conv_id")


def op10_chat_format(spark, sf_dir: str) -> DataFrame:
    return format_chats(read(spark, sf_dir, "conversations"))


SQL = rf"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
  SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY place) AS turns, count(*) AS n FROM t GROUP BY conv_id),
one AS (SELECT turns, n, min(conv_id) AS conv_id, count(*) AS copies FROM whole GROUP BY turns, n),
proper AS (SELECT DISTINCT k AS n, turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n)) AS k FROM one)),
kept AS (SELECT conv_id, n AS n_turns, copies FROM one ANTI JOIN proper USING (n, turns))
SELECT conv_id, part, turns, text, n_turns, copies
FROM (SELECT conv_id, (place - 1) // {BLOCK} AS part, count(*) AS turns,
             string_agg('{OPEN}' || role || chr(10) || text || '{CLOSE}' || chr(10), '' ORDER BY place) AS text
      FROM t GROUP BY ALL) JOIN kept USING (conv_id)
"""
