"""Whitening of embeddings from exact integer cross-products.

Entries are made integers, x = floor(256 c). Each block of distinct vectors is shifted by its own
least entries, and the bits of the shifted entries are packed across rows: one plane of 64-row words
for each dimension and bit. The popcount of the AND of two planes, weighted by both bits' values,
adds up to the exact cross-product of two dimensions; the shift is taken back in integers, so
blocks need no common one and an outlier widens its own block only. Blocks' sums are added by
Spark as exact decimals. The scatter is centred as integers, n * sum(x_i x_j) - S_i S_j, before it
becomes floating point for ``eigh``.

The fit list holds each distinct vector once, so copies weigh nothing; they are removed by a partial
aggregate, so a vector that a third of all rows share is a row a task. The driver receives one
row for each pair of dimensions, never vectors.

Defined cases: vectors that are null or hold null, NaN or infinite entries are left out; vectors of
different lengths are spaces of their own, each with its own fit; empty vectors have no components;
components without variance (their eigenvalue vanishes against the largest) are left out, so
a space whose vectors are all equal has none; null ids are kept; repeated rows are whitened alike; an
empty table gives no rows; other columns are kept in the struct ``row``, whatever their names.
Entries must fit a long once multiplied by 256 (beyond, Spark's cast raises); a ``deviation`` beyond
a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import pin, read, unpin

SCALE = 256  # fixed value of the contract
COMPONENTS = 4
BLOCK, BLOCK_ENTRIES = 1 << 15, 1 << 22  # vectors of a block (512 words a plane), and its entries
LIMB = 60  # sums travel as two decimals: high * 2^60 + low
NO_VARIANCE = 1e-12  # of the largest eigenvalue


# -- bit-sliced sums --------------------------------------------------------------------------


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, dimension of each plane, bit of each plane) of nonnegative integers (rows x
    dimensions): bits packed across rows into 64-bit words, the last one padded with zeros."""
    widths = [int(m).bit_length() for m in shifted.max(axis=0)]
    dims = np.repeat(np.arange(shifted.shape[1]), widths)
    bits = np.concatenate([np.arange(w) for w in widths]) if len(dims) else np.empty(0, np.int64)
    words = -(-len(shifted) // 64)
    planes = np.zeros((len(dims), words * 8), np.uint8)
    for k, (d, b) in enumerate(zip(dims, bits, strict=True)):
        packed = np.packbits(((shifted[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8))
        planes[k, :len(packed)] = packed
    return planes.view(np.uint64), dims, bits


def scatter(x: np.ndarray) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Exact sums and cross-products (i <= j) of the columns of a block of long vectors."""
    rows, d = x.shape
    least = x.min(axis=0)
    shifted = x.astype(np.uint64) - least.astype(np.uint64)  # modulo 2^64: exact for any longs
    planes, dims, bits = bit_planes(shifted)
    starts = np.searchsorted(dims, np.arange(d + 1))
    # 64 bits hold every weighted count of a block unless its entries lie far apart
    small = not len(bits) or 2 * (int(bits.max()) + 1) + rows.bit_length() < 62
    weight = np.array([1 << int(b) for b in bits], np.int64 if small else object)

    def common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        counts = np.bitwise_count(left & right).sum(axis=-1, dtype=np.int64)
        return counts if small else counts.astype(object)

    low = [int(v) for v in least]
    own = common(planes, planes) * weight
    sums = [int(own[a:b].sum()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    out: dict[tuple[int, int], int] = {}
    for i in range(d):
        later = planes[starts[i]:]  # the planes of the dimensions from i on
        products = sum((common(later, planes[k]) * weight[k] for k in range(starts[i], starts[i + 1])), np.zeros(len(later), weight.dtype))
        products = products * weight[starts[i]:]
        for j in range(i, d):
            cross = int(products[starts[j] - starts[i]:starts[j + 1] - starts[i]].sum())
            out[i, j] = cross + low[i] * sums[j] + low[j] * sums[i] + rows * low[i] * low[j]
    return [s + rows * m for s, m in zip(sums, low, strict=True)], out


# -- Spark steps ------------------------------------------------------------------------------


def integers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(row, x): the rows with a whole vector, as longs."""
    v = embeddings[f"`{vector}`"].cast("array<double>")
    whole = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.where(F.coalesce(whole, F.lit(False)))
    others = [embeddings[f"`{c}`"] for c in embeddings.columns if c != vector]
    return rows.select(F.struct(*others).alias("row"), F.transform(v, lambda c: F.floor(c * SCALE).cast("bigint")).alias("x"))


def arrays(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, vectors) of a batch of lists, for each length it holds."""
    ends = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, flat[ends[at][:, None] + np.arange(d)].reshape(len(at), d)


def sums(fit_list: DataFrame) -> DataFrame:
    """(d, i, j, hi, lo): exact totals over vectors of length d: of products for i <= j, of entries
    for j = -1, of rows for i = j = -1; a total is hi * 2^60 + lo."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        totals: dict[int, dict[tuple[int, int], int]] = {}

        def add(d: int) -> None:
            x = np.concatenate(held.pop(d))
            first, cross = scatter(x)
            total = totals.setdefault(d, {})
            for k, v in [((-1, -1), len(x)), *(((i, -1), s) for i, s in enumerate(first)), *cross.items()]:
                total[k] = total.get(k, 0) + v

        for batch in batches:
            for _, x in arrays(batch.column("x")):
                d = x.shape[1]
                most = max(1, min(BLOCK, BLOCK_ENTRIES // max(d, 1)))
                for k in range(0, len(x), most):
                    held.setdefault(d, []).append(x[k:k + most])
                    if sum(map(len, held[d])) >= most:
                        add(d)
        for d in list(held):
            add(d)
        for d, total in totals.items():
            keys = list(total)
            hi, lo = [total[k] >> LIMB for k in keys], [total[k] & ((1 << LIMB) - 1) for k in keys]
            wide = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(keys), pa.int32()), pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array(hi, wide), pa.array(lo, wide)], ["d", "i", "j", "hi", "lo"])

    parts = fit_list.select("x").mapInArrow(run, "d int, i int, j int, hi decimal(38,0), lo decimal(38,0)")
    return parts.groupBy("d", "i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))


@dataclass(frozen=True)
class Space:
    """What was learned of the vectors of one length: rows, sums per dimension, components as rows
    (largest eigenvalue first), eigenvalues, each one's share of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs where they fit, else Python integers."""
        reach = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        if self.n * reach + max(map(abs, self.sums), default=0) < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.components.T / np.sqrt(self.values)

    def deviation(self, centred: np.ndarray) -> list[int | None]:
        most = int(np.abs(centred).max()) if centred.size else 0
        if most * most * max(1, centred.shape[1]) < 1 << 63 and centred.dtype != object:
            return (centred * centred).sum(axis=1).tolist()
        total = (centred.astype(object) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in total]


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Space]:
    """A :class:`Space` for each length of the distinct vectors given."""
    found: dict[int, dict[tuple[int, int], int]] = {}
    for r in sums(fit_list).collect():  # a row for each pair of dimensions
        found.setdefault(r["d"], {})[r["i"], r["j"]] = (int(r["hi"]) << LIMB) + int(r["lo"])
    out = {}
    for d, total in found.items():
        n, s = total[-1, -1], [total[i, -1] for i in range(d)]
        v = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                v[i, j] = v[j, i] = (n * total[i, j] - s[i] * s[j]) / (n * n)
        values, vectors = np.linalg.eigh(v) if d else (np.empty(0), np.empty((0, 0)))
        values, vectors = values[::-1], vectors.T[::-1]
        real = int((values > NO_VARIANCE * max(values.max(initial=0.0), 0.0)).sum()) if values.max(initial=0.0) > 0 else 0
        k = min(components, real)
        out[d] = Space(n, s, vectors[:k].copy(), values[:k].copy(), values[:k] / np.trace(v) if k else np.empty(0))
    return out


def transform(rows: DataFrame, spaces: dict[int, Space], *keep: str) -> DataFrame:
    """``keep`` columns of ``rows`` with deviation, whitened (one entry a component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation: list = [None] * len(batch)
            whitened: list = [[]] * len(batch)
            for at, x in arrays(batch.column("x")):
                space = spaces[x.shape[1]]
                c = space.centred(x)
                for k, v, w in zip(at.tolist(), space.deviation(c), space.whitened(c).tolist(), strict=True):
                    deviation[k], whitened[k] = v, w
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64())),
                 pa.array(np.diff(batch.column("x").offsets.to_numpy()), pa.int32())],
                [*keep, "deviation", "whitened", "d"])

    kept = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.select(*keep, "x").mapInArrow(run, f"{kept}deviation long, whitened array<double>, d int")


def identity_errors(fit_list: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, measured
    over its rows."""
    k = max((len(s.values) for s in spaces.values()), default=0)
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    if not pairs:
        return {}
    z = transform(fit_list, spaces).select("d", *[F.get("whitened", F.lit(a)).alias(f"z{a}") for a in range(k)])
    rows = z.groupBy("d").agg(*[F.covar_pop(f"z{a}", f"z{b}").alias(f"c{a}_{b}") for a, b in pairs]).collect()
    return {r["d"]: max((abs(r[f"c{a}_{b}"] - (a == b)) for a, b in pairs if r[f"c{a}_{b}"] is not None), default=0.0) for r in rows}


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, dict[int, Space], dict[int, float]]:
    """(row, deviation, whitened, d) of each row with a whole vector; the spaces and their identity
    errors by length."""
    rows = integers(embeddings, vector)
    fit_list = pin(rows.select("x").distinct(), "distinct-vectors")
    spaces = fit(fit_list, components)
    errors = identity_errors(fit_list, spaces)
    unpin(fit_list)
    return transform(rows, spaces, "row"), spaces, errors


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    out, spaces, errors = whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    facts = spark.createDataFrame(
        [(d, k + 1, s.n, float(s.explained[k]), float(errors[d])) for d, s in spaces.items() for k in range(len(s.values))],
        "d int, component int, n long, explained double, identity_error double")
    each = out.select("row.vec_id", "d", "deviation", F.posexplode("whitened").alias("at", "whitened")).withColumn(
        "component", F.col("at") + 1)
    # up to 4 rows a vector length
    return each.join(F.broadcast(facts), ["d", "component"]).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
