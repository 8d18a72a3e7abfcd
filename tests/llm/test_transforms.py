"""Fill-in-middle, whitening and sharding against plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import edge_rows, prose
from pyspark.sql import functions as F

from starloom.llm import fill_middle, shards, whiten
from starloom.llm.queries import QUERIES
from starloom.session import scratch_path

SMALL = "/root/testdata/sf0.001"


# -- 11 fill-in-middle


def plain_fim(doc_id, text, unit, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "lines" else list(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if h[3] % 100 < spm else "psm", len(p), len(m), out


def fim_rows():
    rows = [(r[0], r[1]) for r in edge_rows()]
    rows += [(400 + k, t) for k, t in enumerate([
        "\n", "\n\n\n", "a\n", "\na", "ü", "ü\nß\n日本\n👍🏽", "<P>", "a <S> b\nc", "x<M>", "<", "<<P", "<S\n>", "P>\n<P\n>", "é\r\nè\r\n", " a \x85b\x0c\n"])]
    rows += [(500 + k, "\n".join(prose(k * 50 + j, 1 + j % 9) + "ü日👍"[j % 3] * (j % 4) for j in range(k))) for k in range(60)]
    return rows


@pytest.mark.parametrize("unit, seed, rate, spm", [("lines", 7, 100, 50), ("characters", 3, 60, 20)])
def test_fill_middle(spark, monkeypatch, unit, seed, rate, spm):
    monkeypatch.setattr(fill_middle, "BATCH_BYTES", 3000)
    rows = fim_rows()
    want = sorted((plain_fim(*r, unit, seed, rate, spm) for r in rows), key=repr)
    df = spark.createDataFrame([(*r, "x", k, None) for k, r in enumerate(rows)], "doc_id long, text string, form string, n long, output string").repartition(3)
    out = fill_middle.transform(df, unit, seed, rate, spm)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("text", fill_middle.restored(F.col("form"), F.col("output"))).collect()
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == want
    assert {f for _, _, f, *_ in want} == {"plain", "psm", "spm"}
    for r in got:  # other columns stay with their row, and the text comes back
        assert r["text"] == (rows[r["kept"]["n"]][1] or "") and r["kept"]["form"] == "x" and r["kept"]["output"] is None
    nothing = fill_middle.transform(df.limit(0))
    assert nothing.count() == 0 and nothing.columns == [*columns, "kept"]
    with pytest.raises(ValueError):
        fill_middle.transform(df, "pages")


def test_exception_index():
    text = "aüb日c👍🏽\nplain\n" * 50 + "z"
    data = np.frombuffer(text.encode(), np.uint8)
    index = fill_middle.Exceptions(data)
    assert len(index.at) == 50 * 4  # nothing is kept for the rest
    cuts = np.arange(len(text) + 1)
    want = np.array([len(text[:k].encode()) for k in cuts])
    assert (index.to_bytes(cuts) == want).all() and (index.to_characters(want) == cuts).all()
    ascii_only = fill_middle.Exceptions(np.frombuffer(b"plain", np.uint8))
    assert not len(ascii_only.at) and (ascii_only.to_bytes(np.arange(6)) == np.arange(6)).all()
    # sliced and large Arrow arrays
    for kind in (pa.utf8(), pa.large_utf8()):
        data, ends = fill_middle.buffer_of(pa.array(["xx", "aü", "", "b"], kind).slice(1))
        assert bytes(data).decode() == "aüb" and ends.tolist() == [0, 3, 3, 4]
    assert fill_middle.buffer_of(pa.array([], pa.utf8()))[1].tolist() == [0]


# -- 12 whitening


def plain_whitening(vectors, k=4):
    """(n, deviation, whitened up to sign, explained) by numpy on the distinct integer vectors."""
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for v in vectors], np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    v = (u - s / n).T @ (u - s / n) / n
    values, e = np.linalg.eigh(v)
    values, e = values[::-1][:k], e[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ e / np.sqrt(values), values / np.trace(v)


def embedding_rows():
    r = np.random.default_rng(5)
    rows = [(k, (r.normal(size=6) * [3, 2, 1.5, 1, 0.5, 0.25]).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(40)] + [(7, rows[7][1])]  # copies
    rows += [(2000, [1000.5, -999.25, 0.0, -0.0, 1e-9, 3.0]), (None, rows[3][1])]
    return rows


def test_scatter_is_exact():
    r = np.random.default_rng(1)
    for width in (1, 9, 31, 62):
        for rows in (1, 63, 64, 65, 700):
            x = r.integers(-(1 << width), 1 << width, (rows, 5))
            x[:, 3] = 7  # a dimension without planes
            sums, cross = whiten.scatter(x)
            o = x.astype(object)
            assert sums == [int(v) for v in o.sum(axis=0)]
            assert cross == {(i, j): int((o[:, i] * o[:, j]).sum()) for i in range(5) for j in range(i, 5)}


@pytest.mark.parametrize("block", [whiten.BLOCK, 7])
def test_whitening(spark, monkeypatch, block):
    monkeypatch.setattr(whiten, "BLOCK", block)
    rows = embedding_rows()
    odd = [(3000, None), (3001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3002, [float("nan")] * 6), (3003, [float("inf")] + [0.0] * 5),
           (3004, []), (3005, [1.0, 2.0]), (3006, [1.0, 2.0])]
    df = spark.createDataFrame([(*x, f"label {x[0]}", 1) for x in rows + odd], "vec_id long, embedding array<float>, d string, whitened int").repartition(4)
    out, spaces, errors = whiten.whiten(df)
    got = out.select("row.*", "deviation", F.col("whitened").alias("z"), "d").collect()
    assert [c for c in out.columns] == ["row", "deviation", "whitened", "d"]
    vectors = [np.float32(v).tolist() for _, v in rows]
    n, deviation, z, explained = plain_whitening(vectors)
    space = spaces[6]
    assert space.n == n and np.allclose(space.explained, explained, rtol=1e-9) and errors[6] < 1e-9
    assert not len(spaces[2].values) and not len(spaces[0].values)  # one vector, or no dimension: no variance
    mine = [(r[0], r["deviation"], r["z"]) for r in got if r[-1] == 6]
    order = np.argsort([repr((r[0], int(d))) for r, d in zip(rows, deviation, strict=True)], kind="stable")
    mine.sort(key=lambda r: repr((r[0], r[1])))
    assert [(r[0], r[1]) for r in mine] == [(rows[k][0], int(deviation[k])) for k in order]
    w = np.array([r[2] for r in mine])
    for c in range(4):
        assert min(np.abs(w[:, c] - z[order, c]).max(), np.abs(w[:, c] + z[order, c]).max()) < 1e-8
    assert sorted(r[0] for r in got if r[-1] != 6) == [3004, 3005, 3006]
    empty, spaces, errors = whiten.whiten(df.limit(0))
    assert empty.count() == 0 and spaces == {} and errors == {}


def test_whitening_query(spark):
    out = QUERIES["op12_whitening"](spark, SMALL)
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                          ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    given = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet' ORDER BY vec_id").fetchall()
    n, deviation, z, explained = plain_whitening([v for _, v in given])
    got = {(r["vec_id"], r["component"]): r for r in out.collect()}
    assert len(got) == 4 * len(given)
    for c in range(4):
        w = np.array([got[i, c + 1]["whitened"] for i, _ in given])
        assert min(np.abs(w - z[:, c]).max(), np.abs(w + z[:, c]).max()) < 1e-8
    assert all(got[i, 1]["deviation"] == deviation[k] and got[i, 1]["n"] == n for k, (i, _) in enumerate(given))
    assert all(abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in got.values())


def test_deviation_beyond_a_long_is_null():
    space = whiten.Space(3, [0, 0], np.eye(2), np.ones(2), np.ones(2))
    big = space.centred(np.array([[1 << 61, 0], [5, 1]]))
    assert space.deviation(big) == [None, 234]


# -- 13 sharding


def plain_jump(doc_id, n):
    key = int(hashlib.sha256(b"" if doc_id is None else str(doc_id).encode()).hexdigest()[:16], 16)
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    ids = spark.range(4000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    for n in (1, 2, 16, 1000):
        got = ids.select("id", shards.jump(shards.key_seed(F.col("id")), n).alias("to")).select("id", "to.*").collect()
        assert all(r[1] == plain_jump(r[0], n) and r[2] == plain_jump(r[0], n + 1) for r in got)
        assert all(r[2] in (r[1], n) for r in got)  # a new shard takes, and nothing else moves
    moved = sum(r[2] == 1000 for r in got)
    assert moved < 20
    with pytest.raises(ValueError):
        shards.jump(F.lit(1), 0)


@pytest.mark.parametrize("partitions", [1, 9])
def test_sharding(spark, edge, nothing, partitions):
    path = scratch_path(spark, "test-shards")
    docs = edge.withColumnsRenamed({"key": "shard", "n": "slot", "label": "at", "ids": "size", "words": "row"}).repartition(partitions)
    shards.write_shards(docs, path, 5)
    rows = shards.read_shards(spark, path)
    got = rows.collect()
    order, want = {}, []
    for r in sorted(((plain_jump(r[0], 5), r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()),
                      r[0]) for r in edge_rows())):
        want.append((r[5], r[3], r[4], r[0], order.setdefault(r[0], 0), plain_jump(r[5], 6)))
        order[r[0]] += 1
    assert sorted((tuple([r["row"]["doc_id"], *(r[c] for c in ("size", "text_crc32", "shard", "slot", "grown_shard"))]) for r in got), key=repr) == sorted(want, key=repr)
    assert rows.schema["row"].dataType.names == docs.columns and all(r["row"]["shard"] == "x" for r in got)
    assert sorted((r["row"]["text"] for r in got), key=repr) == sorted((r[1] for r in edge_rows()), key=repr)
    assert shards.moving(rows, 5).count() == sum(w[5] == 5 for w in want)
    empty = scratch_path(spark, "test-shards")
    shards.write_shards(nothing, empty, 5)
    assert shards.read_shards(spark, empty).count() == 0


def test_hot_key_is_spread_over_ranges(spark):
    path = scratch_path(spark, "test-shards")
    rows = spark.range(0, 3000, 1, 12).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("same text").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few bytes are one partition
    try:
        shards.write_shards(rows, path, 16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = shards.read_shards(spark, path).where("row.doc_id IS NULL")
    slots = sorted(r["slot"] for r in hot.select("slot").collect())
    assert len(slots) == 1000 and slots == list(range(slots[0], slots[0] + 1000))
    ranges = spark.read.parquet(f"{path}/rows").where("row.doc_id IS NULL").groupBy(F.shiftright("at", 33)).count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 1000
