"""Quality rules with adaptive thresholds: instead of fixed cut-offs, each (lang, source) group
gets fences from mergeable quantile sketches of its own measures; documents outside the fences
of their group are rejected. DataFrame functions only.

Sketches (KLL, ``K`` items a level) are built with partial aggregation, so a hot source costs
each task one sketch, and they can be stored and merged with those of later loads
(:func:`merge_sketches`). A group of fewer than ``MIN_GROUP`` measured documents takes the
merged sketch of its language, and a language of fewer that of all documents. A fence lies
``FENCE`` times the distance of two quantiles beyond them, plus a margin for measures that are
the same in almost all documents; so a usual document stays however many are measured. The
quantiles are the quartiles or, for repetition, of which most documents have none, the median
and the highest hundredth.

Defined cases: null text has no words and fails the base rules (as empty text does); null lang
or source is a group of its own; repeated rows and ties are measured and judged alike; groups
without any document that passes the base rules give no sketch and reject nothing further; an
empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import broadcast_below, pin, read

#: Fixed values of the contract.
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3

K = 4000  # KLL parameter: rank error about 0.05 %; groups of fewer documents are exact
MIN_GROUP = 30
FENCE = 3.0
#: measure -> (low quantile, high quantile, least distance of a fence from it, whether the low side is
#: fenced too)
FENCES = {"symbol_share": (0.25, 0.75, 0.02, False), "word_length": (0.25, 0.75, 1.0, True),
          "dup_line_share": (0.5, 0.99, 0.1, False), "repeat_share": (0.5, 0.99, 0.1, False)}
MAX_BROADCAST_GROUPS = 100_000


def _words(text: Column) -> Column:
    # trimmed first, so that the split has no empty strings
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def measured(documents: DataFrame) -> DataFrame:
    """``documents`` with the struct ``__m``: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and n_lines (lines with a word)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    df = documents.withColumn("__w", _words(text)).withColumn("__lines", lines)
    # the windows of 3 words; words hold no white space, so the joined string is unambiguous
    df = df.withColumn("__g", F.when(F.size("__w") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("__w") - WINDOW, F.lit(0))),
        lambda i: F.concat_ws(" ", F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))).otherwise(
        F.array().cast("array<string>")))
    # most texts repeat no window and need no sort
    df = df.withColumn("__s", F.when(F.size("__g") > F.size(F.array_distinct("__g")), F.sort_array(
        F.transform("__g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<g:string,i:int>>")))
    # starts of windows with an equal neighbour, in text order
    df = df.withColumn("__i", F.sort_array(F.filter(F.transform("__s", lambda x, k: F.when(
        x["g"].eqNullSafe(F.get("__s", k - 1)["g"]) | x["g"].eqNullSafe(F.get("__s", k + 1)["g"]), x["i"])),
        lambda i: i.isNotNull())))
    # each start covers 3 words, or as many as lie before the next start
    covered = F.aggregate(F.transform("__i", lambda i, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get("__i", k + 1) - i, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b)
    # the generator keeps filters on __m above it: pushed below, they would evaluate all of this
    # again, inside the lambdas for every element
    df = df.withColumn("__m", F.explode(F.array(F.struct(
        F.size("__w").cast("bigint").alias("n_words"),
        F.length(F.translate(text, WHITE, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
        F.size("__lines").cast("bigint").alias("n_lines")))))
    return df.drop("__w", "__lines", "__g", "__s", "__i")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def measures(m: Column) -> dict[str, Column]:
    """The fenced measures of a document; null where there is nothing to divide by."""
    share = lambda a, b: m[a] / F.nullif(m[b], F.lit(0))
    return {"symbol_share": share("n_symbols", "word_chars"), "word_length": share("word_chars", "n_words"),
            "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words")}


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, n, <measure>...): sketches over rows of :func:`measured` that pass the base
    rules, one row per group, in a form that can be stored and merged."""
    m = F.col("__m")
    ok = rows.where(~base_failed(m)).select("lang", "source", *[c.alias(k) for k, c in measures(m).items()])
    return ok.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(k, F.lit(K)).alias(k) for k in FENCES])


def merge_sketches(stored: DataFrame, *keys: str) -> DataFrame:
    """Stored sketches merged to coarser groups, or over several loads with the same keys."""
    return stored.groupBy(*keys).agg(F.sum("n").alias("n"), *[
        F.kll_merge_agg_double(k).alias(k) for k in FENCES])


def fences(stored: DataFrame) -> DataFrame:
    """(lang, source, <measure>_lo, <measure>_hi) for each group of ``stored``."""
    langs, whole = merge_sketches(stored, "lang"), merge_sketches(stored)
    wide = stored.join(_as(langs, "l"), F.col("lang").eqNullSafe(F.col("l_lang")), "left").join(
        F.broadcast(_as(whole, "a")))  # one row
    out = []
    for k, (q_low, q_high, margin, low) in FENCES.items():
        sketch = F.when(F.col("n") >= MIN_GROUP, F.col(k)).when(
            F.col("l_n") >= MIN_GROUP, F.col(f"l_{k}")).otherwise(F.col(f"a_{k}"))
        below, above = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (q_low, q_high))
        reach = FENCE * (above - below) + margin
        out += [(below - reach if low else F.lit(0.0)).alias(f"{k}_lo"), (above + reach).alias(f"{k}_hi")]
    return wide.select("lang", "source", *out)


def _as(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def judge(rows: DataFrame) -> DataFrame:
    """Rows of :func:`measured` with ``__base_failed`` and ``__kept``."""
    fence = pin(fences(sketches(rows)), "quality-fences")
    fence = _as(fence, "__f")
    joined = rows.join(broadcast_below(fence, MAX_BROADCAST_GROUPS),
                       rows["lang"].eqNullSafe(fence["__f_lang"]) & rows["source"].eqNullSafe(fence["__f_source"]),
                       "left")
    m = F.col("__m")
    inside = F.lit(True)
    for k, value in measures(m).items():
        inside &= F.coalesce(value.between(F.col(f"__f_{k}_lo"), F.col(f"__f_{k}_hi")), F.lit(True))
    return joined.withColumn("__base_failed", base_failed(m)).withColumn(
        "__kept", ~F.col("__base_failed") & inside).drop(*fence.columns)


def keep(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were. They are measured once: sketches
    and verdicts read the written rows."""
    rows = documents.select(F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row"), "text", "lang", "source")
    return judge(pin(measured(rows).drop("text"), "quality-measures")).where("__kept").select("row.*")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    # measured once: the narrow table serves the sketches and the verdicts
    out = judge(pin(measured(read(spark, sf_dir, "documents")).drop("text"), "quality-measures"))
    return out.select("doc_id", "__m.n_words", "__m.word_chars", "__m.n_symbols", "__m.n_dup_lines",
                      "__m.n_repeat_words", F.col("__base_failed").alias("base_failed"),
                      F.col("__kept").alias("kept"))


def _sql_fence(k: str) -> str:
    _, _, margin, low = FENCES[k]
    q = lambda p: (f"CASE WHEN n >= {MIN_GROUP} THEN {k}_{p} WHEN l_n >= {MIN_GROUP} THEN l_{k}_{p} "  # noqa: E731
                   f"ELSE a_{k}_{p} END")
    below, above = q("below"), q("above")
    reach = f"({FENCE} * (({above}) - ({below})) + {margin})"
    return f"{f'({below}) - {reach}' if low else '0.0'} AS {k}_lo, ({above}) + {reach} AS {k}_hi"


def _sql_quantiles(prefix: str) -> str:
    return f"count(*) AS {prefix}n, " + ", ".join(
        f"quantile_disc({k}, {q}) AS {prefix}{k}_{i}" for k, x in FENCES.items() for i, q in zip(("below", "above"), x, strict=False))


#: Exact quantiles: the sketches' own up to K documents in a group.
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, lang, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (
  SELECT r, i, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN covered USING (r)),
b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         n_symbols / nullif(word_chars, 0)::DOUBLE AS symbol_share,
         word_chars / nullif(n_words, 0)::DOUBLE AS word_length,
         n_dup_lines / nullif(n_lines, 0)::DOUBLE AS dup_line_share,
         n_repeat_words / nullif(n_words, 0)::DOUBLE AS repeat_share FROM m),
f AS (
  SELECT lang, source, {", ".join(_sql_fence(k) for k in FENCES)}
  FROM (SELECT lang, source, {_sql_quantiles("")} FROM b WHERE NOT base_failed GROUP BY ALL) x
  LEFT JOIN (SELECT lang AS l_lang, {_sql_quantiles("l_")} FROM b WHERE NOT base_failed GROUP BY ALL) y
    ON lang IS NOT DISTINCT FROM l_lang
  CROSS JOIN (SELECT {_sql_quantiles("a_")} FROM b WHERE NOT base_failed) z)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"coalesce({k} BETWEEN {k}_lo AND {k}_hi, true)" for k in FENCES)} AS kept
FROM b LEFT JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
"""
