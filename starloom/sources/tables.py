"""Typed readers and writers for the three layers (operational, staging, warehouse) and for
the driver's TPC-H-like test tables. Schemas always come from ``starloom.contracts``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import ALL, DRIVER_SCHEMAS, Contract
from starloom.session import COMPRESSION


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``) with its declared schema."""
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_driver_tables(
    spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    return {n: read_driver_table(spark, sf_dir, n) for n in (names or DRIVER_SCHEMAS)}


def conform(df: DataFrame, contract: Contract, *more: str) -> DataFrame:
    """Select the contract's columns in order, cast to its types, then ``more`` as they are.

    A column that is absent gets its declared default (or NULL). Casting runs under ANSI
    rules, so a value that does not fit its decimal type raises instead of turning NULL.
    """
    cols = []
    present = set(df.columns)
    for name, typ, _ in contract.columns:
        if name in present:
            cols.append(F.col(name).cast(typ).alias(name))
        else:
            default = contract.defaults.get(name)
            cols.append(F.lit(default).cast(typ).alias(name))
    return df.select(*cols, *more)


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """``src_read``: one table of a layer, with its contract schema (never inferred)."""
    contract = ALL[layer][name]
    df = spark.read.parquet(layer_path(root, layer, name))
    return conform(df, contract)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> str:
    """Write a table of a layer as Parquet. ``mode='append'`` is ``sink_append``."""
    path = layer_path(root, layer, name)
    writer = df.write.mode(mode).option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path
