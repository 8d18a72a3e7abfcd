"""Session defaults and the shared checkpoint folder.

The library never decides where a cluster keeps its durable scratch data: it reads
``spark.checkpoint.dir`` from the session. Only on a local master (tests, the laptop), and only
when nothing is configured, does it create a private folder of its own; on a cluster a missing
setting is an error, because executors do not share the driver's disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.decimalOperations.allowPrecisionLoss": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # pinned rank buckets / hot-key tables are deleted once no DataFrame references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: Codec of the tables that the library writes: layers, and intermediate tables that are read again.
COMPRESSION = "zstd"


def get_session(
    master: str | None = None,
    app_name: str = "starloom",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, configuring one only if none is set.

    Order: an already-active SparkContext checkpoint dir, then ``spark.checkpoint.dir``
    from the configuration (the cluster's shared folder), and only then, on a local master, a
    fresh private folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver delete an intermediate table when the application ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


@contextmanager
def laid_out_by_order(spark: SparkSession) -> Iterator[None]:
    """While this lasts, a join on an order and further columns takes sides that lie by order alone as
    they are. By default Spark shuffles both by all columns of the join, to spread a hot order; for
    tables in order buckets that moves every row, and the order's bucket is one task all the same."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
