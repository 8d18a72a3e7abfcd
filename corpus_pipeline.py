"""The corpus pipeline: stages over ``documents``, each by one operator of ``starloom.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in
the shared checkpoint folder and read again as the next stage's input. All but the last return
the columns of ``documents``; a stage learns (thresholds, languages) from what reaches it.

1. quality_rules: documents that fail the base rules or lie outside the adaptive fences of their
   language and source go.
2. language_id: documents without a letter, or whose language cannot be told, go.
3. jaccard_join: of each near-duplicate group one document stays, that with the smallest id.
4. benchmark_decontamination: contaminated documents go.
5. byte_level_bpe: doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit integers) and
   the SHA-256 of ids and decoded text, one row per document that is left.

Null ids, texts and other columns, empty tables and further columns pass through as the
operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bpe, decontaminate, jaccard_join, language_id, quality
from starloom.llm.common import pin, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, bpe.default_vocabulary(spark), "lang", "source")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language),
    ("jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL can express neither the language model nor byte-level BPE; tests/llm/test_pipeline.py
#: compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
