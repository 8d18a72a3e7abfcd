"""The pipeline and the registered queries against plain versions on the smallest tables."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from cases import brute_hits, brute_links, edge_rows

import corpus_pipeline
from starloom.llm import bpe, language_id, quality
from starloom.llm.common import pin, read
from starloom.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "pages", "conversations")


def duck(rows=None):
    con = duckdb.connect()
    for t in TABLES:
        if t == "documents" and rows is not None:
            con.register("documents", rows.toArrow())
        else:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    got, want = QUERIES[name](spark, SMALL).toArrow(), duck().execute(SQL[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    rows = lambda t: sorted(zip(*(t[c].to_pylist() for c in columns), strict=True), key=repr)
    assert rows(got) == rows(want)


def plain_pipeline(spark, docs, benchmark):
    """The documents each stage keeps, in plain Python (thresholds by SQL, the language model as fitted)."""
    rows = {k: tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for k, r in enumerate(docs.collect())}
    frame = spark.createDataFrame([(k, *r[1:]) for k, r in rows.items()], "doc_id long, text string, lang string, source string")
    kept = {r[0] for r in duck(frame).execute(f"SELECT doc_id, kept FROM ({quality.SQL})").fetchall() if r[1]}
    rows = {k: r for k, r in rows.items() if k in kept}
    yield rows
    model = language_id.fit(spark.createDataFrame(list(rows.values()), "doc_id long, text string, lang string, source string"))
    kept = set()
    for k, r in rows.items():
        words = language_id.WORD.findall(r[1].lower())
        if words and model.langs:
            s = np.sum([model.word(w) for w in words], axis=0)
            p = np.exp((s - s.max()) / np.sqrt(len(words)))
            if p.max() / p.sum() >= language_id.MIN_SCORE:
                kept.add(k)
    rows = {k: r for k, r in rows.items() if k in kept}
    yield rows
    keys = list(rows)
    sets, _, label = brute_links([rows[k] for k in keys])
    order = lambda k: (rows[k][0] is None, rows[k][0] or 0, hashlib.md5(rows[k][1].encode()).digest())
    groups = {}
    for k, s, x in zip(keys, sets, label, strict=True):
        groups.setdefault(x if s else ("alone", k), []).append(k)
    rows = {k: rows[k] for k in (min(g, key=order) for g in groups.values())}
    yield rows
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    found = {k: brute_hits(r[1], items) for k, r in rows.items()}
    rows = {k: r for k, r in rows.items() if not found[k][1] or 20 * len(found[k][1]) < found[k][0]}
    yield rows
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        plain = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(f.read()), special_tokens={})
    yield {k: (r[0], plain.encode_ordinary(r[1])) for k, r in rows.items()}


@pytest.mark.parametrize("case", ["documents", "edge"])
def test_pipeline_stages(spark, edge, case):
    docs = read(spark, SMALL, "documents") if case == "documents" else edge
    benchmark = read(spark, SMALL, "benchmark")
    sizes = [docs.count()]
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain_pipeline(spark, docs, benchmark), strict=True):
        before = docs.columns
        docs = pin(stage(spark, docs, SMALL), "test-stage")
        if name == "byte_level_bpe":
            got = sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in docs.collect()), key=repr)
            assert got == sorted(want.values(), key=repr)
        else:
            assert docs.columns == before
            got = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
            assert got == sorted(((r[0], r[1]) for r in want.values()), key=repr)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] >= sizes[4] == sizes[5] > 0
    assert len(edge_rows()) > sizes[-1] or case == "documents"


def test_pipeline_of_nothing(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = pin(stage(spark, docs, SMALL), "test-stage")
    assert docs.count() == 0


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "language_id", "jaccard_join", "benchmark_decontamination", "byte_level_bpe"]
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_contract_columns(spark):
    want = {
        "op2_language_id": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
        "op3_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
        "op7_byte_bpe": [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
        "op8_token_store": [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")],
        "op9_jaccard_join": [("doc_id", "bigint"), ("class_id", "bigint"), ("n_links", "bigint")],
        "op11_fill_middle": [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"),
                             ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")],
        "op13_sharding": [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                          ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")],
    }
    n = read(spark, SMALL, "documents").count()
    for name, columns in want.items():
        out = QUERIES[name](spark, SMALL)
        assert [x for x in out.dtypes if x in columns] == columns, name
        assert out.count() == n, name
