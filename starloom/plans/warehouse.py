"""End-to-end jobs: stage the sources, build or refresh the star, read it back.

Order of a load (the five dimensions are mutually independent; the facts need all of them):

    sources --stage_mirror--> staging --dims--> dim_* --facts--> fact_sales, fact_inventory_snapshot

Each table is written to ``<root>/<layer>/<table>`` and read back before the next step uses
it, so a step never recomputes its inputs and a lost executor only repeats the current step.
A refresh writes the new star under a new root and never overwrites the root it reads. Loads that
follow each other in one store, published as versions, are in ``plans.versions``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import SOURCE_TABLES, STAGING, WAREHOUSE
from starloom.operators import calendar, dims, facts, quality
from starloom.operators.analytics import Star
from starloom.operators.ranking import pin
from starloom.operators.scd import SINGLE_PASS
from starloom.operators.skew import row_number_within
from starloom.session import COMPRESSION
from starloom.sources.tables import conform, layer_path, path_exists, read_table, write_table

T = TypeVar("T")


@dataclass(frozen=True)
class LoadConfig:
    """Parameters of one warehouse load."""

    as_of: date                              # load date (replaces CURRENT_DATE)
    calendar_start: date | None = None       # None: Jan 1 of the first order (or load) year
    calendar_end: date | None = None         # None: Dec 31 of the last order (or load) year
    gold: int = dims.GOLD_THRESHOLD
    silver: int = dims.SILVER_THRESHOLD
    tax_rate: str = facts.TAX_RATE
    scd2_mode: str = SINGLE_PASS
    fact_partition_by_month: bool = False    # Hive-style month folders for the sales fact
    order_buckets: int | None = None         # bucket staging orders, order lines and the
                                             # sales fact by order_id (co-located joins)
    lines_per_bucket: int | None = None      # sets order_buckets from the number of lines
    binding: str = facts.CURRENT             # or facts.AS_OF: versions valid on the order date
    enforce: bool = True                     # a load that breaks a table contract raises


# Profile for the driver's test tables: orders 1995-2001, lifetime spend per customer
# between ~30 thousand and ~7 million, so the segment thresholds sit near the 30 % / 70 %
# points of that distribution.
TESTDATA_CONFIG = LoadConfig(
    as_of=date(2002, 1, 1), gold=2_900_000, silver=2_000_000, lines_per_bucket=50_000
)


def with_buckets(cfg: LoadConfig, lines: DataFrame) -> LoadConfig:
    """``cfg`` with its bucket count set from the number of order lines: one bucket for every
    ``lines_per_bucket``, so tasks grow in number with the data and not in size."""
    if cfg.lines_per_bucket is None:
        return cfg
    return replace(cfg, order_buckets=max(1, -(-lines.count() // cfg.lines_per_bucket)))


def run_concurrently(jobs: dict[str, Callable[[], T]], max_workers: int = 8) -> dict[str, T]:
    """Submit independent Spark jobs from driver threads so that they share the cluster
    (small tables finish while large ones run); results by name, first error re-raised."""
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


# Staging tables that the sales-fact build joins on ``order_id``.
ORDER_KEYED = ("orders", "order_items")


def _bucketed_table(df: DataFrame, root: str, name: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) by ``order_id`` at its layer path and
    read it back through the catalog, so later joins and windows on ``order_id`` need no
    shuffle of this side. ``repartition`` on the same key and count first makes every task
    write a single bucket file."""
    path = layer_path(root, "staging", name)
    table = f"starloom_stg_{name}_{hashlib.md5(root.encode()).hexdigest()[:12]}"
    (df.repartition(buckets, "order_id").write.mode("overwrite").option("compression", COMPRESSION)
     .bucketBy(buckets, "order_id").sortBy("order_id")
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def enforce(tables: dict[str, DataFrame], contracts: dict, parents: dict[str, DataFrame] | None = None) -> None:
    """Raise if any rule of the tables' contracts is broken: NOT NULL, lengths, keys and foreign
    keys are counted in one job, and only the broken rules' names and counts reach the driver."""
    broken = quality.violation_counts(tables, contracts, parents).where("violations > 0").collect()
    if broken:
        raise ValueError("load breaks its contract: " + ", ".join(
            f"{r['check_name']} ({r['violations']})" for r in broken))


def stage_mirror(
    sources: dict[str, DataFrame], root: str, order_buckets: int | None = None, check: bool = True
) -> dict[str, DataFrame]:
    """Copy every source table to ``<root>/staging`` (contract-typed), read it back and check it
    against its contract.

    With ``order_buckets`` the two order-keyed tables are written as bucketed tables, which
    removes the line-side shuffle from the sales-fact join and its line-number window.
    """
    def copy(name: str) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            df = conform(sources[name], STAGING[name])
            if order_buckets and name in ORDER_KEYED:
                return conform(_bucketed_table(df, root, name, order_buckets), STAGING[name])
            write_table(df, root, "staging", name)
            return read_table(df.sparkSession, root, "staging", name)
        return run

    staged = run_concurrently({name: copy(name) for name in SOURCE_TABLES})
    if check:
        enforce(staged, STAGING)
    return staged


def read_staging(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {n: read_table(spark, root, "staging", n) for n in SOURCE_TABLES}


def _fact_table_name(root: str) -> str:
    return f"starloom_fact_sales_{hashlib.md5(root.encode()).hexdigest()[:12]}"


def _bucketed_fact(df: DataFrame, root: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    """Write the sales fact bucketed and sorted by ``order_id``. Rows that already arrive
    hash-partitioned by ``order_id`` into ``buckets`` partitions are not shuffled; any others (a build
    whose product lookup is too large for a broadcast, or with hot orders) are, so that each task
    always writes one bucket file: their number is that of the buckets, not tasks times buckets.
    Reading it back through the catalog lets every per-order step of the queries
    (``COUNT(DISTINCT order_id)`` groups on ``(group, order_id)``) run without a shuffle of the fact."""
    path = layer_path(root, "warehouse", "fact_sales")
    table = _fact_table_name(root)
    (df.repartition(buckets, "order_id").write.mode(mode).option("compression", COMPRESSION)
     .bucketBy(buckets, "order_id").sortBy("order_id")
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def _write_read(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> DataFrame:
    write_table(df, root, "warehouse", name, partition_by=partition_by)
    return df.sparkSession.read.parquet(layer_path(root, "warehouse", name))


def calendar_range(orders: DataFrame, cfg: LoadConfig, date_col: str = "order_date") -> tuple[date, date]:
    """Whole years spanning every order date and the load date (the snapshot fact is keyed
    on the load date, so it must be in the calendar too)."""
    if cfg.calendar_start and cfg.calendar_end:
        return cfg.calendar_start, cfg.calendar_end
    lo, hi = calendar.year_range_of(orders, date_col)
    lo = min(lo, date(cfg.as_of.year, 1, 1))
    hi = max(hi, date(cfg.as_of.year, 12, 31))
    return cfg.calendar_start or lo, cfg.calendar_end or hi


def build_dimensions(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    cfg: LoadConfig,
    root: str,
    previous: Star | None = None,
) -> dict[str, DataFrame]:
    """Load the five dimensions into ``root`` (first load when ``previous`` is None)."""
    prev = previous
    jobs: dict[str, Callable[[], DataFrame]] = {
        "dim_store": lambda: _write_read(
            dims.dim_store(prev.dim_store if prev else None, staging["stores"]), root, "dim_store"),
        "dim_customer": lambda: _write_read(
            dims.dim_customer(prev.dim_customer if prev else None, staging["customers"],
                              staging["orders"], cfg.as_of, cfg.scd2_mode, cfg.gold, cfg.silver),
            root, "dim_customer"),
        "dim_product": lambda: _write_read(
            dims.dim_product(prev.dim_product if prev else None, staging["products"],
                             staging["suppliers"], cfg.as_of, cfg.scd2_mode),
            root, "dim_product"),
        "dim_promotion": lambda: _write_read(
            dims.dim_promotion(prev.dim_promotion if prev else None, staging["promotions"]),
            root, "dim_promotion"),
    }
    def calendar_job() -> DataFrame:
        # a later load keeps the days that are there and adds those its own dates need
        start, end = calendar_range(staging["orders"], cfg)
        days = calendar.dim_date(spark, start, end)
        if prev:
            days = prev.dim_date.unionByName(days.join(prev.dim_date.select("date_key"), "date_key", "left_anti"))
        return _write_read(days, root, "dim_date")

    jobs["dim_date"] = calendar_job
    # The five dimensions are mutually independent.
    return run_concurrently(jobs)


def build_facts(
    staging: dict[str, DataFrame],
    dim: dict[str, DataFrame],
    cfg: LoadConfig,
    root: str,
) -> dict[str, DataFrame]:
    sales = facts.fact_sales(
        staging["order_items"], staging["orders"], staging["products"], staging["promotions"],
        dim["dim_customer"], dim["dim_product"], dim["dim_store"], dim["dim_promotion"],
        tax_rate=cfg.tax_rate,
        lines_colocated=cfg.order_buckets is not None,
        binding=cfg.binding,
        order_buckets=None if cfg.fact_partition_by_month else cfg.order_buckets,
    )
    part = None
    if cfg.fact_partition_by_month:
        sales = sales.withColumn("month_key", F.expr("date_key div 100")).sortWithinPartitions("month_key")
        part = ["month_key"]
    snap = facts.fact_inventory_snapshot(
        staging["inventory"], dim["dim_product"], dim["dim_store"], cfg.as_of
    )
    if cfg.order_buckets and not part:
        def write_sales() -> DataFrame:
            return _bucketed_fact(sales, root, cfg.order_buckets)
    else:
        def write_sales() -> DataFrame:
            return _write_read(sales, root, "fact_sales", part)
    return run_concurrently({
        "fact_sales": write_sales,
        "fact_inventory_snapshot": lambda: write_snapshot(snap, root),
    })


def build_star(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    cfg: LoadConfig,
    root: str,
    previous: Star | None = None,
) -> Star:
    """Dimensions then facts, each written under ``root``, read back and checked against their
    contracts (a broken rule raises)."""
    d = build_dimensions(spark, staging, cfg, root, previous)
    f = build_facts(staging, d, cfg, root)
    if cfg.enforce:
        enforce({**d, **f}, WAREHOUSE)
    return Star(
        fact_sales=f["fact_sales"],
        dim_date=d["dim_date"],
        dim_customer=d["dim_customer"],
        dim_product=d["dim_product"],
        dim_store=d["dim_store"],
        dim_promotion=d["dim_promotion"],
        fact_inventory_snapshot=f["fact_inventory_snapshot"],
    )


def register_bucketed_fact(spark: SparkSession, root: str, buckets: int) -> DataFrame:
    """Expose a sales fact written by a bucketed build (in any earlier application) as a
    bucketed table again, so its scans keep skipping the per-order shuffle."""
    table = _fact_table_name(root)
    path = layer_path(root, "warehouse", "fact_sales").replace("'", "\\'")
    schema = spark.read.parquet(layer_path(root, "warehouse", "fact_sales")).schema
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet CLUSTERED BY (order_id) "
              f"SORTED BY (order_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def read_star(spark: SparkSession, root: str, order_buckets: int | None = None) -> Star:
    def r(n: str) -> DataFrame:
        return spark.read.parquet(layer_path(root, "warehouse", n))

    fact = register_bucketed_fact(spark, root, order_buckets) if order_buckets else r("fact_sales")
    return Star(
        fact_sales=fact, dim_date=r("dim_date"), dim_customer=r("dim_customer"),
        dim_product=r("dim_product"), dim_store=r("dim_store"), dim_promotion=r("dim_promotion"),
        fact_inventory_snapshot=r("fact_inventory_snapshot"),
    )


def refresh_dimensions(
    spark: SparkSession,
    previous: Star,
    staging: dict[str, DataFrame],
    cfg: LoadConfig,
    root: str,
) -> dict[str, DataFrame]:
    """A later batch: SCD1/SCD2 merges of the new staging data into the previous star's
    dimensions, written under a new ``root``."""
    return build_dimensions(spark, staging, cfg, root, previous)


def append_sales(
    existing: DataFrame,
    new_rows: DataFrame,
    root: str,
    name: str = "fact_sales",
    order_buckets: int | None = None,
) -> DataFrame:
    """``sink_append`` for the sales fact that is safe to re-run. A line is known by its
    identity (order_id, item_id), not by its position: lines already in the table are skipped,
    lines it lacks are added whether or not the batch holds the rest of their order. Stored rows
    keep their numbers; an order's new lines are numbered on from its last one, in item order.
    Identity keys start after the largest key written so far.

    ``new_rows`` is a fact built with ``start_after=0``; it is evaluated and written once. Lines are
    compared and numbered by their identities alone, and whole rows meet only the numbers of the
    new lines, by the batch's own identity key. A fact with month folders is appended to by month; with
    ``order_buckets`` the rows go through the catalog table with the same bucket spec.
    """
    line = ["order_id", "item_id"]
    rows = pin(new_rows)
    added = pin(rows.select(*line, "sales_key").join(existing.select(*line), line, "left_anti"))
    last = existing.join(added.select("order_id").distinct(), "order_id", "left_semi").groupBy("order_id").agg(
        F.max("order_line_num").alias("__last"))
    start = existing.agg(F.coalesce(F.max("sales_key"), F.lit(0)).alias("m")).scalar()
    numbered = row_number_within(added, ["order_id"], ["item_id"], "__n").join(last, "order_id", "left")
    numbers = pin(numbered.select("sales_key", (F.coalesce("__last", F.lit(0)) + F.col("__n")).cast("int").alias("order_line_num")))
    fresh = rows.drop("order_line_num").join(numbers, "sales_key").withColumn(
        "sales_key", (F.col("sales_key") + start).cast("long"))
    part = None
    if "month_key" in existing.columns:
        fresh, part = fresh.withColumn("month_key", F.expr("date_key div 100")), ["month_key"]
    # materialised first: the table appended to is also what the batch is compared with
    fresh = pin(fresh.select(*existing.columns))
    if order_buckets and not part:
        return _bucketed_fact(fresh, root, order_buckets, mode="append")
    write_table(fresh, root, "warehouse", name, mode="append", partition_by=part)
    return fresh.sparkSession.read.parquet(layer_path(root, "warehouse", name))


def write_snapshot(snapshot: DataFrame, root: str) -> DataFrame:
    """Write the inventory snapshot replacing only the partitions of its own snapshot dates:
    loading the same day twice keeps one copy (the grain stays unique). Identity keys start
    after the largest key of the other days."""
    path = layer_path(root, "warehouse", "fact_inventory_snapshot")
    spark = snapshot.sparkSession
    if path_exists(spark, path):
        days = [r[0] for r in snapshot.select("snapshot_date").distinct().collect()]  # the loaded days: one
        stored = spark.read.parquet(path).where(~F.col("snapshot_date").isin(days)) if days else spark.read.parquet(path)
        last = stored.agg(F.max("inventory_snapshot_key")).first()[0] or 0
        snapshot = snapshot.withColumn("inventory_snapshot_key", F.col("inventory_snapshot_key") + F.lit(last).cast("long"))
    (snapshot.write.mode("overwrite").option("compression", COMPRESSION).option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_date").parquet(path))
    return spark.read.parquet(path)
