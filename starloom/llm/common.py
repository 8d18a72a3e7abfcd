"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import os
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import delete_at_exit, scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The rows that a classifier never learns from: crc32(doc_id as text) mod 3 is 1.
FOLDS, HELD_OUT_FOLD = 3, 1


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers. They see the driver's PYTHONPATH, its working
    folder and added files; if the package was found in none of these (a script changed sys.path),
    a zip of it is put in the shared checkpoint folder and added to the session, once."""
    root = Path(__file__).resolve().parents[2]
    seen = [Path(p or ".").resolve() for p in ("", *os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    sc = spark.sparkContext
    if root in seen or not root.is_dir() or SparkFiles.getRootDirectory() in str(root) or any(
            name.startswith("starloom") for name in sc._python_includes):
        return
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted((root / "starloom").rglob("*.py")):
            z.write(f, f.relative_to(root))
    path = scratch_path(spark, "starloom") + ".zip"
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p)
    stream.write(bytearray(out.getvalue()))
    stream.close()
    delete_at_exit(spark, path)
    sc.addPyFile(path)


_HELD: dict = {}


def held(key, make):
    """An object that a Python worker keeps between its tasks (a tokenizer, a model). A worker
    keeps one at a time: the next operator's replaces it."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def held_out(doc_id: Column) -> Column:
    """True for rows of the held-out fold; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """True for rows that a classifier may learn from; rows without an id are left out."""
    return doc_id.isNotNull() & ~held_out(doc_id)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back: later
    steps do not recompute it, and it outlives the executors that made it. It goes when the
    application ends."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def unpin(df: DataFrame) -> None:
    """Delete a pinned table that no later step reads."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_below(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a pinned table of narrow rows if it has at most ``max_rows``, else leave the
    join to Spark (a shuffle join, whose skewed partitions AQE splits)."""
    return F.broadcast(df) if df.count() <= max_rows else df
