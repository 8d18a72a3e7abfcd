"""SQL access to a built star: register its layers as catalog tables.

After ``register_layers(spark, root)`` the staging and warehouse tables are queryable with
``spark.sql`` under the same schema-qualified names the reference's scripts use
(``warehouse.fact_sales``, ``warehouse.dim_date``, ``staging.orders`` ...). The tables are
external Parquet tables over the files already written under ``root``: nothing is copied,
and the database folders live under ``root`` too. ``register_version(spark, store)`` does the same
for a version of a store (``plans.versions``), as temporary views.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from starloom.contracts import STAGING, WAREHOUSE
from starloom.plans import versions
from starloom.sources.tables import layer_path


def _quote(path: str) -> str:
    return path.replace("'", "\\'")


def register_layers(spark: SparkSession, root: str, layers: tuple[str, ...] = ("staging", "warehouse")) -> list[str]:
    """Create (or replace) one external table per written table of ``layers``; returns the
    qualified names registered."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = []
    for layer in layers:
        tables = STAGING if layer == "staging" else WAREHOUSE
        db_location = f"{root.rstrip('/')}/catalog/{layer}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{_quote(db_location)}'")
        for name in tables:
            path = layer_path(root, layer, name)
            p = jvm.org.apache.hadoop.fs.Path(path)
            if not p.getFileSystem(conf).exists(p):
                continue
            spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
            spark.sql(f"CREATE TABLE {layer}.{name} USING parquet LOCATION '{_quote(path)}'")
            names.append(f"{layer}.{name}")
    return names


def register_version(spark: SparkSession, store: str, number: int | None = None) -> list[str]:
    """Create (or replace) a temporary view named like its table for each table of a version, by
    default the last one, and for its partial sums (``state_day`` and so on)."""
    star = versions.open_version(spark, store, number)
    views = {name: getattr(star, name) for name in WAREHOUSE}
    views |= {f"state_{n}": versions.read_state(spark, store, n, number) for n in versions.state.NAMES}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
