"""A star kept as versions in one store: a load writes its rows apart and one small file publishes them.

    <store>/versions/00000002.json             what version 2 consists of
    <store>/loads/<load>/warehouse/dim_*       the dimensions as of a load
    <store>/facts/fact_sales/load_id=<load>/[month_key=<yyyymm>/]
    <store>/facts/fact_inventory_snapshot/load_id=<load>/snapshot_date=<day>/
    <store>/state/<name>/load_id=<load>/       partial sums of a load's own rows

A load never touches what an earlier one wrote: dimensions are merged into new files, new order
lines and the day's snapshot become a partition of their own. Until its version file is there
no reader sees any of it, so a load that stops at any step leaves the last version whole, and
it is simply run again. The file is put in place by a rename that fails if the name is taken: of
two loads on the same version one is refused. Earlier versions stay readable until
:func:`vacuum`.

The sales fact is one table over all loads, partitioned by load (and month) and bucketed by order:
a version is a filter on the partition column, so scans read published loads only, a date
range reads its months only (also one that comes from a filter on ``dim_date``), and per-order
steps need no exchange.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.contracts import WAREHOUSE
from starloom.operators import facts, scd, state
from starloom.operators.analytics import Star
from starloom.operators.ranking import pin
from starloom.operators.skew import row_number_within
from starloom.plans.warehouse import LoadConfig, build_dimensions, enforce, run_concurrently
from starloom.session import COMPRESSION, delete_at_exit, laid_out_by_order, scratch_path
from starloom.sources.tables import path_exists

DIMENSIONS = ("dim_date", "dim_customer", "dim_product", "dim_store", "dim_promotion")
LINE = ["order_id", "item_id"]


class ConcurrentLoad(RuntimeError):
    """Another load was published on the version that this one started from."""


@dataclass(frozen=True)
class Version:
    """What a published version consists of."""

    number: int
    load_id: str                              # the load that wrote its dimensions
    as_of: str
    loads: tuple[str, ...] = ()               # loads whose sales rows it holds
    snapshots: dict[str, str] = field(default_factory=dict)  # day -> load that wrote it
    order_buckets: int | None = None
    by_month: bool = False
    last_sales_key: int = 0
    last_snapshot_key: int = 0


# -- version files ----------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _file(store: str, number: int) -> str:
    return f"{store.rstrip('/')}/versions/{number:08d}.json"


def versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the published versions, in order."""
    fs, folder = _fs(spark, f"{store.rstrip('/')}/versions")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))


def read_version(spark: SparkSession, store: str, number: int | None = None) -> Version | None:
    """A published version, by default the last one; None if the store has none."""
    if number is None:
        found = versions(spark, store)
        if not found:
            return None
        number = found[-1]
    text = "\n".join(r[0] for r in spark.read.text(_file(store, number), wholetext=True).collect())
    fields = json.loads(text)
    return Version(**{**fields, "loads": tuple(fields["loads"])})


def publish(spark: SparkSession, store: str, version: Version) -> None:
    """Put the version file in place; raises :class:`ConcurrentLoad` if its number is taken."""
    fs, folder = _fs(spark, f"{store.rstrip('/')}/versions")
    fs.mkdirs(folder)
    _, draft = _fs(spark, f"{store.rstrip('/')}/versions/_{uuid.uuid4().hex}.json")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(asdict(version), sort_keys=True).encode()))
    out.close()
    sc = spark.sparkContext
    _, final = _fs(spark, _file(store, version.number))
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(final):
            raise ConcurrentLoad(f"version {version.number} of {store} is already published") from e
        raise


# -- tables -----------------------------------------------------------------------------------


def _fact_path(store: str, name: str, load_id: str = "") -> str:
    return f"{store.rstrip('/')}/facts/{name}" + (f"/load_id={load_id}" if load_id else "")


def _sales_schema() -> T.StructType:
    return T.StructType(list(WAREHOUSE["fact_sales"].schema.fields)).add("item_id", T.StringType())


MONTHS_A_BUCKET = 10


def store_buckets(cfg: LoadConfig, dim_date: DataFrame) -> int | None:
    """Order buckets of a new store. In month folders every bucket is split by month into as many
    files, so that buckets sized by lines alone would leave files of some hundred lines: where the
    number comes from the lines, a bucket takes up to ``MONTHS_A_BUCKET`` times more of them."""
    if not (cfg.order_buckets and cfg.lines_per_bucket and cfg.fact_partition_by_month):
        return cfg.order_buckets
    months = dim_date.select("year_number", "month_number").distinct().count()
    return max(1, -(-cfg.order_buckets // min(max(months, 1), MONTHS_A_BUCKET)))


def _write_sales(rows: DataFrame, store: str, load_id: str, buckets: int | None, by_month: bool) -> None:
    """A load's sales rows, bucketed and sorted by order; within month folders if wanted. Rows that
    lie in the buckets already are not shuffled."""
    path = _fact_path(store, "fact_sales", load_id)
    if by_month:
        rows = rows.withColumn("month_key", F.expr("date_key div 100").cast("int"))
    writer = (rows.repartition(buckets, "order_id") if buckets else rows).write.mode("overwrite").option("compression", COMPRESSION)
    if by_month:
        writer = writer.partitionBy("month_key")
    if not buckets:
        writer.parquet(path)
        return
    # the catalog entry is only the way to write buckets; readers register the whole table
    table = f"starloom_load_{uuid.uuid4().hex[:12]}"
    writer.bucketBy(buckets, "order_id").sortBy("order_id").option("path", path).saveAsTable(table)
    rows.sparkSession.sql(f"DROP TABLE {table}")


def _pin_by_order(rows: DataFrame, buckets: int | None) -> DataFrame:
    """``rows`` pinned, in order buckets if the store has them: what follows by order needs no shuffle."""
    if not buckets:
        return pin(rows)
    spark = rows.sparkSession
    path, table = scratch_path(spark, "pinned"), f"starloom_rows_{uuid.uuid4().hex[:12]}"
    delete_at_exit(spark, path)
    (rows.repartition(buckets, "order_id").write.option("compression", COMPRESSION).bucketBy(buckets, "order_id").sortBy("order_id")
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def _read_sales(spark: SparkSession, store: str, v: Version, name: str | None = None) -> DataFrame:
    schema = _sales_schema()
    parts = [T.StructField("load_id", T.StringType())] + ([T.StructField("month_key", T.IntegerType())] if v.by_month else [])
    path = _fact_path(store, "fact_sales")
    if not v.order_buckets:
        whole = spark.read.schema(T.StructType([*schema.fields, *parts])).option("basePath", path).parquet(
            *[_fact_path(store, "fact_sales", x) for x in v.loads])
        return whole.drop("load_id")
    table = f"starloom_sales_{hashlib.md5(f'{store}|{name or v.number}'.encode()).hexdigest()[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, *parts])
    quoted = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(f.name for f in parts)}) "
              f"CLUSTERED BY (order_id) SORTED BY (order_id) INTO {v.order_buckets} BUCKETS LOCATION '{quoted}'")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table).where(F.col("load_id").isin(list(v.loads))).drop("load_id")


def _read_snapshot(spark: SparkSession, store: str, v: Version) -> DataFrame:
    path = _fact_path(store, "fact_inventory_snapshot")
    schema = WAREHOUSE["fact_inventory_snapshot"].schema
    folders = [f"{_fact_path(store, 'fact_inventory_snapshot', load)}/snapshot_date={day}" for day, load in sorted(v.snapshots.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def _own_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot that a load has written, which may hold no rows."""
    schema = WAREHOUSE["fact_inventory_snapshot"].schema
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _state_path(store: str, name: str, load_id: str) -> str:
    return f"{store.rstrip('/')}/state/{name}/load_id={load_id}"


def read_state(spark: SparkSession, store: str, name: str, number: int | None = None) -> DataFrame:
    """The partial sums ``name`` (see ``operators.state``) of a version's loads; no fact row is read."""
    v = _required(spark, store, number)
    return spark.read.parquet(*[_state_path(store, name, x) for x in v.loads])


def _required(spark: SparkSession, store: str, number: int | None) -> Version:
    v = read_version(spark, store, number)
    if v is None:
        raise ValueError(f"{store} has no published version")
    return v


def _dimension_path(store: str, load_id: str, name: str) -> str:
    return f"{store.rstrip('/')}/loads/{load_id}/warehouse/{name}"


def open_version(spark: SparkSession, store: str, number: int | None = None) -> Star:
    """The star of a published version, by default the last one."""
    v = _required(spark, store, number)
    dims = {n: spark.read.parquet(_dimension_path(store, v.load_id, n)) for n in DIMENSIONS}
    return Star(fact_sales=_read_sales(spark, store, v), fact_inventory_snapshot=_read_snapshot(spark, store, v), **dims)


# -- loads ------------------------------------------------------------------------------------


def load_folder(store: str, load_id: str) -> str:
    """Where a load keeps its own tables (dimensions, and staging or reports if it writes any)."""
    return f"{store.rstrip('/')}/loads/{load_id}"


def begin(spark: SparkSession, store: str) -> tuple[Version | None, str]:
    """The version to load on (None: the store is empty) and a new load's id."""
    base = read_version(spark, store)
    return base, f"{(base.number if base else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def new_lines(stored: DataFrame | None, rows: DataFrame, buckets: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(lines of ``rows`` that ``stored`` lacks, numbered on from their order's last one; the stored
    lines of the same orders).

    The stored fact is reduced to the batch's orders first, by a semi-join on its bucket column:
    it is not shuffled. Lines are then compared by their identities alone, and only the orders that have
    new ones are taken further with all their columns. ``buckets``: the new lines lie in so many by order;
    what the comparison writes lies in them too, so that no whole row is moved (see
    ``session.laid_out_by_order``)."""
    if stored is None:
        return rows, None
    narrow = stored.select(*LINE, "order_line_num", "date_key")
    known = narrow.join(rows.select("order_id").distinct(), "order_id", "left_semi").select(*LINE)
    added = _pin_by_order(rows.select(*LINE).join(known, LINE, "left_anti"), buckets)
    orders = _pin_by_order(added.select("order_id").distinct(), buckets)
    before = _pin_by_order(narrow.join(orders, "order_id", "left_semi"), buckets)
    last = before.groupBy("order_id").agg(F.max("order_line_num").alias("__last"))
    # an order's last number comes along with the order, so that nothing is joined after the numbering
    heads = orders.join(last, "order_id", "left")
    fresh = rows.join(heads, "order_id").join(added, LINE, "left_semi")
    numbered = row_number_within(fresh, ["order_id"], ["item_id"], "__n", partitions=buckets, counted=added)
    return numbered.withColumn("order_line_num", (F.coalesce("__last", F.lit(0)) + F.col("__n")).cast("int")).select(*rows.columns), before


def load(
    spark: SparkSession,
    store: str,
    staging: dict[str, DataFrame],
    cfg: LoadConfig,
    before_publish: Callable[[Star], None] | None = None,
    at: tuple[Version | None, str] | None = None,
) -> Version:
    """One load, the first or a later one, and its publication.

    Dimensions are merged (Type 1 and 2) and the calendar extended; lines that the fact lacks, known by
    (order_id, item_id), and the load day's snapshot are written as this load's own; the partial
    sums of its lines too. ``staging`` may hold a full extract or new orders only. The joined rows
    are evaluated once: a first load writes them as they are, later ones pin them to compare them with
    the stored lines; the snapshot and the sums are of what was written. Contracts, and the validity intervals of the
    versioned dimensions, are checked on all rows before anything is published; ``before_publish`` sees
    the finished star last of all.
    Whatever raises, the last published version stays as it is."""
    base, load_id = at or begin(spark, store)
    previous = open_version(spark, store, base.number) if base else None
    by_month = base.by_month if base else cfg.fact_partition_by_month
    d = build_dimensions(spark, staging, cfg, load_folder(store, load_id), previous)
    buckets = base.order_buckets if base else store_buckets(cfg, d["dim_date"])
    # bucketed staging tables meet their headers without a shuffle
    rows = facts.fact_sales(
        staging["order_items"], staging["orders"], staging["products"], staging["promotions"],
        d["dim_customer"], d["dim_product"], d["dim_store"], d["dim_promotion"], tax_rate=cfg.tax_rate,
        lines_colocated=cfg.order_buckets is not None, binding=cfg.binding, order_buckets=buckets)
    stock = facts.fact_inventory_snapshot(
        staging["inventory"], d["dim_product"], d["dim_store"], cfg.as_of, start_after=base.last_snapshot_key if base else 0)
    stock_path = _fact_path(store, "fact_inventory_snapshot", load_id)
    # the load's own folder, which no reader sees before the version is there
    write_stock = {"snapshot": lambda: stock.write.partitionBy("snapshot_date").parquet(stock_path)}
    snapshot = None

    def check(lines: DataFrame) -> None:
        if cfg.enforce:
            run_concurrently({
                "contracts": lambda: enforce({**d, "fact_sales": lines, "fact_inventory_snapshot": snapshot}, WAREHOUSE),
                "validity": lambda: check_validity(d)})

    known = None
    with laid_out_by_order(spark) if buckets else nullcontext():
        if base:  # the extract's rows are checked, and compared with the stored ones
            rows = run_concurrently({"rows": lambda: _pin_by_order(rows, buckets), **write_stock})["rows"]
            snapshot = _own_snapshot(spark, stock_path)
            check(rows)
            rows, known = new_lines(previous.fact_sales, rows, buckets)
        key = F.col("sales_key") + F.lit(base.last_sales_key if base else 0)
        run_concurrently({
            "sales": lambda: _write_sales(rows.withColumn("sales_key", key.cast("long")), store, load_id, buckets, by_month),
            **({} if base else write_stock)})
        snapshot = _own_snapshot(spark, stock_path)
        own = Version(0, load_id, "", loads=(load_id,), order_buckets=buckets, by_month=by_month)
        fresh = _read_sales(spark, store, own, name=load_id).drop("month_key")

        def write_sums() -> None:
            sums = state.of_load(fresh, d["dim_date"], known)
            run_concurrently({n: lambda n=n: sums[n].write.parquet(_state_path(store, n, load_id)) for n in sums})

        done = run_concurrently({
            **({} if base else {"check": lambda: check(fresh)}),  # all rows are new: the written ones are checked
            "sums": write_sums,
            "last": lambda: fresh.agg(F.max("sales_key")).first()[0],
            "last_stock": lambda: snapshot.agg(F.max("inventory_snapshot_key")).first()[0]})
    last, last_stock = done["last"], done["last_stock"]
    days = {cfg.as_of.isoformat(): load_id} if last_stock is not None else {}
    first = Version(1, load_id, "", order_buckets=buckets, by_month=by_month)
    version = replace(
        base or first, number=base.number + 1 if base else 1, load_id=load_id, as_of=cfg.as_of.isoformat(),
        loads=(*(base.loads if base else ()), load_id),
        snapshots={**({k: v for k, v in base.snapshots.items() if k != cfg.as_of.isoformat()} if base else {}), **days},
        last_sales_key=max(last or 0, base.last_sales_key if base else 0),
        last_snapshot_key=max(last_stock or 0, base.last_snapshot_key if base else 0))
    if before_publish:
        dims = {n: d[n] for n in DIMENSIONS}
        before_publish(Star(fact_sales=_read_sales(spark, store, replace(version, number=-version.number)),
                            fact_inventory_snapshot=_read_snapshot(spark, store, version), **dims))
    publish(spark, store, version)
    return version


def check_validity(d: dict[str, DataFrame]) -> None:
    """Raise if a versioned dimension has overlapping intervals or several current versions of a key.
    A second change on one day closes a version before it began; that is kept, and reported by
    ``scd.overlapping_versions``."""
    for name, key in (("dim_customer", "customer_id"), ("dim_product", "product_id")):
        broken = scd.overlapping_versions(d[name], [key]).where("problem <> 'expiry before effective date'")
        kinds = broken.groupBy("problem").count().collect()  # two at most
        if kinds:
            raise ValueError(f"{name}: " + ", ".join(f"{r['problem']} ({r['count']})" for r in kinds))


def vacuum(spark: SparkSession, store: str, keep: int = 1) -> list[str]:
    """Delete what none of the last ``keep`` versions needs: their older version files, and loads
    that were replaced or never published. Loads that may still be running (numbered beyond the
    last version) stay. Returns the loads that went."""
    found = versions(spark, store)
    kept = [read_version(spark, store, n) for n in found[-keep:]] if keep > 0 else []
    if not kept:
        return []
    dims = {v.load_id for v in kept}
    sales = {x for v in kept for x in v.loads}
    stock = {x for v in kept for x in v.snapshots.values()}
    last = kept[-1].number
    gone = set()
    for folder, needed in (("loads", dims), ("facts/fact_sales", sales), ("facts/fact_inventory_snapshot", stock),
                           *((f"state/{n}", sales) for n in state.NAMES)):
        fs, path = _fs(spark, f"{store.rstrip('/')}/{folder}")
        for s in fs.listStatus(path) if fs.exists(path) else []:
            load_id = s.getPath().getName().removeprefix("load_id=")
            if s.isDirectory() and load_id not in needed and int(load_id.split("-")[0]) <= last:
                fs.delete(s.getPath(), True)
                gone.add(load_id)
    for n in found[:-keep]:
        fs, path = _fs(spark, _file(store, n))
        fs.delete(path, False)
    return sorted(gone)


def is_store(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/versions")
