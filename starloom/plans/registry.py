"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` (or the star Spark derives from them):
the first call per (application, sf_dir) runs adapter -> staging -> dimensions -> facts and
writes the layers under the session's checkpoint folder; later calls read that star.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import DRIVER_SCHEMAS, SOURCE, STAGING, WAREHOUSE
from starloom.functions.hashing import hash_hex
from starloom.operators import analytics as A
from starloom.operators import dims, facts, quality, quarantine, scd, state
from starloom.operators.calendar import dim_date
from starloom.operators.ranking import pin
from starloom.operators.scd import DEFERRED, SINGLE_PASS
from starloom.plans import versions
from starloom.plans.warehouse import (
    TESTDATA_CONFIG,
    LoadConfig,
    append_sales,
    build_star,
    calendar_range,
    read_staging,
    read_star,
    stage_mirror,
    with_buckets,
    write_snapshot,
)
from starloom.session import delete_at_exit, ensure_checkpoint_dir, scratch_path
from starloom.sources import batches
from starloom.sources.adapter import adapt
from starloom.sources.tables import layer_path, read_driver_tables, write_table

CONFIG = TESTDATA_CONFIG
# The second (refresh) batch is loaded one month after the first.
AS_OF_2 = CONFIG.as_of + timedelta(days=31)
AS_OF_3 = AS_OF_2 + timedelta(days=31)


@dataclass
class Warehouse:
    root: str
    staging: dict[str, DataFrame]
    star: A.Star


_LOCK = threading.Lock()
_BUILT: dict[tuple, Warehouse] = {}


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _build_key(spark: SparkSession, sf_dir: str, cfg: LoadConfig) -> str:
    """Identity of a star: input files (path, size, mtime), load config, library source."""
    h = hashlib.sha1(repr(cfg).encode())
    for name in sorted(DRIVER_SCHEMAS):
        fs, path = _hadoop_fs(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        for st in fs.listStatus(path) if fs.exists(path) else []:
            h.update(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()}".encode())
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for dirpath, _, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:20]


def _record_path(spark: SparkSession, key: str) -> str:
    """Durable record of finished builds, in the configured (shared) checkpoint folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/starloom-stars/{key}"


def _load_recorded(spark: SparkSession, record: str, cfg: LoadConfig) -> Warehouse | None:
    fs, path = _hadoop_fs(spark, record + "/_SUCCESS")
    if not fs.exists(path):
        return None
    found = spark.read.json(record).first()
    root, buckets = found["root"], found["order_buckets"]
    fs_root, root_path = _hadoop_fs(spark, root)
    if not fs_root.exists(root_path):
        return None
    return Warehouse(root, read_staging(spark, root), read_star(spark, root, buckets))


def warehouse_for(spark: SparkSession, sf_dir: str, cfg: LoadConfig = CONFIG) -> Warehouse:
    """The star for ``sf_dir``: built once, then reused within the application and, through a
    record in the shared checkpoint folder, by later applications (a fresh session or process
    reads the finished star instead of rebuilding it). A build that fails leaves no record."""
    app_key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), cfg)
    with _LOCK:
        if app_key in _BUILT:
            return _BUILT[app_key]
        ensure_checkpoint_dir(spark)
        record = _record_path(spark, _build_key(spark, sf_dir, cfg))
        try:
            wh = _load_recorded(spark, record, cfg)
        except AnalysisException:  # a record or table that is gone or has no files: build afresh
            wh = None
        if wh is None:
            root = scratch_path(spark, "star")
            tables = read_driver_tables(spark, sf_dir)
            sized = with_buckets(cfg, tables["lineitem"])
            staging = stage_mirror(adapt(tables, order_buckets=sized.order_buckets), root, sized.order_buckets)
            star = build_star(spark, staging, sized, root)
            wh = Warehouse(root, staging, star)
            spark.createDataFrame([(root, sized.order_buckets)], "root string, order_buckets int").coalesce(
                1).write.mode("overwrite").json(record)
        _BUILT[app_key] = wh
        return wh


def _star(spark: SparkSession, sf_dir: str) -> A.Star:
    return warehouse_for(spark, sf_dir).star


def _hex_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("row_hash", hash_hex("row_hash"))


# ---------------------------------------------------------------------------
# analytical queries
# ---------------------------------------------------------------------------

def _q(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_star(spark, sf_dir))


ANALYTICS = {
    "q01_monthly_trend": _q(A.q01_monthly_trend),
    "q02_category_rank_by_region": _q(A.q02_category_rank_by_region),
    "q03_cohort": _q(A.q03_cohort),
    "q04_top_customers": _q(A.q04_top_customers),
    "q05_store_vs_avg": _q(A.q05_store_vs_avg),
    "q06_product_margin": _q(A.q06_product_margin),
    "q07_weekly_moving_avg": _q(A.q07_weekly_moving_avg),
    "q08_segment_share": _q(A.q08_segment_share),
    "q09_promo_effect": _q(A.q09_promo_effect),
    "q10_quarterly_growth": _q(A.q10_quarterly_growth),
    "q11_rfm": lambda spark, sf_dir: A.q11_rfm(_star(spark, sf_dir), CONFIG.as_of),
}


# ---------------------------------------------------------------------------
# loads (dimensions, facts) and the staging mirror
# ---------------------------------------------------------------------------

def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_driver_tables(spark, sf_dir, ["orders"])["orders"]
    lo, hi = calendar_range(orders.select(F.col("o_orderdate").cast("date").alias("d")), CONFIG, "d")
    return dim_date(spark, lo, hi)


def q_dim_customer(spark, sf_dir):
    return _hex_hash(_star(spark, sf_dir).dim_customer)


def q_dim_product(spark, sf_dir):
    return _hex_hash(_star(spark, sf_dir).dim_product)


def q_dim_store(spark, sf_dir):
    return _star(spark, sf_dir).dim_store


def q_dim_promotion(spark, sf_dir):
    return _star(spark, sf_dir).dim_promotion


def q_fact_sales(spark, sf_dir):
    return _star(spark, sf_dir).fact_sales.drop("sales_key", "month_key", "item_id")


def q_fact_inventory_snapshot(spark, sf_dir):
    return _star(spark, sf_dir).fact_inventory_snapshot.drop("inventory_snapshot_key")


def _staged(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: warehouse_for(spark, sf_dir).staging[name]


# ---------------------------------------------------------------------------
# refresh runs (second batch)
# ---------------------------------------------------------------------------

def _customer_refresh(mode: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = warehouse_for(spark, sf_dir)
        st = wh.staging
        batch2 = batches.customers_with_contact_update(st["customers"], st["orders"])
        dim2 = dims.dim_customer(
            wh.star.dim_customer, batch2, st["orders"], AS_OF_2, mode, CONFIG.gold, CONFIG.silver
        )
        return _hex_hash(dim2)
    return run


def q_dim_store_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    return dims.dim_store(wh.star.dim_store, batches.stores_with_managers(wh.staging["stores"], AS_OF_2))


def q_customer_mixed_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    st = wh.staging
    batch = batches.customers_second_extract(st["customers"], st["orders"], st["suppliers"])
    return _hex_hash(dims.dim_customer(wh.star.dim_customer, batch, st["orders"], AS_OF_2, SINGLE_PASS, CONFIG.gold, CONFIG.silver))


def q_customer_deferred_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same extract loaded twice in the deferred mode: the second run opens the versions that
    the first one only expired."""
    wh = warehouse_for(spark, sf_dir)
    st = wh.staging
    batch = pin(batches.customers_second_extract(st["customers"], st["orders"], st["suppliers"]))  # both runs read it
    dim = wh.star.dim_customer
    for day in (AS_OF_2, AS_OF_3):
        dim = pin(dims.dim_customer(dim, batch, st["orders"], day, DEFERRED, CONFIG.gold, CONFIG.silver))
    return _hex_hash(dim)


def q_product_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    st = wh.staging
    return _hex_hash(dims.dim_product(
        wh.star.dim_product, batches.products_second_extract(st["products"]), st["suppliers"], AS_OF_2))


def q_promotion_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    return dims.dim_promotion(wh.star.dim_promotion, batches.promotions_second_extract(wh.staging["promotions"]))


def q_store_mixed_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    return dims.dim_store(wh.star.dim_store, batches.stores_second_extract(wh.staging["stores"], AS_OF_2))


# ---------------------------------------------------------------------------
# later loads of the facts
# ---------------------------------------------------------------------------

def _folder(spark: SparkSession, name: str) -> str:
    """A folder for what a query writes, deleted when the application ends."""
    path = scratch_path(spark, name)
    delete_at_exit(spark, path)
    return path


BULK = 45  # lines of this quantity or more come late
FACT_COLUMNS = ["order_id", "item_id", "order_line_num", "date_key", "customer_key", "product_key", "store_key",
                "promotion_key", "quantity", "unit_price", "unit_cost", "discount_amount", "net_revenue", "gross_profit",
                "tax_amount"]


def _append_bulk(whole: bool) -> Callable[[SparkSession, str], DataFrame]:
    """The fact of the lines below ``BULK``, then an append of the others, alone or in a whole extract."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = warehouse_for(spark, sf_dir)
        st, s = wh.staging, wh.star

        def rows(items: DataFrame) -> DataFrame:
            return facts.fact_sales(items, st["orders"], st["products"], st["promotions"], s.dim_customer, s.dim_product,
                                    s.dim_store, s.dim_promotion)

        root = _folder(spark, "append")
        items = st["order_items"]
        write_table(rows(items.where(F.col("quantity") < BULK)), root, "warehouse", "fact_sales")
        stored = spark.read.parquet(layer_path(root, "warehouse", "fact_sales"))
        return append_sales(stored, rows(items if whole else items.where(F.col("quantity") >= BULK)), root)
    return run


def q_snapshot_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days' snapshots, and whether each row's identity key is its own and, on the second day,
    above those of the first."""
    wh = warehouse_for(spark, sf_dir)
    root = _folder(spark, "snapshots")
    for day in (CONFIG.as_of, AS_OF_2):
        out = write_snapshot(facts.fact_inventory_snapshot(
            wh.staging["inventory"], wh.star.dim_product, wh.star.dim_store, day), root)
    key = F.col("inventory_snapshot_key")
    first = out.where(F.col("snapshot_date") == F.lit(CONFIG.as_of)).agg(F.max(key).alias("m")).scalar()
    twice = out.groupBy("inventory_snapshot_key").count().withColumnRenamed("count", "__n")
    return out.join(twice, "inventory_snapshot_key").select(
        "product_key", "store_key", "date_key", "qty_on_hand", "snapshot_date", (F.col("__n") == 1).alias("own_key"),
        ((F.col("snapshot_date") == F.lit(CONFIG.as_of)) | (key > first)).alias("later_key"))


SECOND_LOAD = date(2001, 1, 1)  # orders from this day on come with the second load
_SECOND: dict[tuple, str] = {}


def second_load_store(spark: SparkSession, sf_dir: str) -> str:
    """A store of two loads, in order buckets and month folders: orders before ``SECOND_LOAD``; then a
    whole extract with mailed customers and dearer products."""
    app_key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if app_key not in _SECOND:
        wh = warehouse_for(spark, sf_dir)
        st = dict(wh.staging)
        early = {**st, "orders": st["orders"].where(F.col("order_date") < F.lit(SECOND_LOAD))}
        early["order_items"] = st["order_items"].join(early["orders"].select("order_id"), "order_id", "left_semi").select(
            *st["order_items"].columns)
        cfg = replace(with_buckets(CONFIG, st["order_items"]), as_of=SECOND_LOAD, fact_partition_by_month=True)
        store = _folder(spark, "two-loads")
        versions.load(spark, store, early, cfg)
        versions.load(spark, store, _second_extract(st), replace(cfg, as_of=CONFIG.as_of))
        _SECOND[app_key] = store
    return _SECOND[app_key]


def _second_extract(st: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {**st, "customers": batches.customers_with_contact_update(st["customers"], st["orders"]),
            "products": batches.products_second_extract(st["products"])}


def second_load_for(spark: SparkSession, sf_dir: str) -> A.Star:
    return versions.open_version(spark, second_load_store(spark, sf_dir), 2)


def q_load_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two more loads on the second version: one breaks a contract (lines without a discount), one
    is stopped when all is written but nothing published. The fact that readers then see."""
    store = second_load_store(spark, sf_dir)
    st = _second_extract(warehouse_for(spark, sf_dir).staging)
    cfg = replace(with_buckets(CONFIG, st["order_items"]), as_of=AS_OF_2)
    lines = st["order_items"]
    late = lines.withColumn("item_id", F.concat("item_id", F.lit("-again")))
    torn = lines.withColumn("discount", F.when(F.col("quantity") < BULK, F.col("discount")))

    def stop(_: A.Star) -> None:
        raise ValueError("stopped before the version was published")

    for items, gate in ((torn, None), (late, stop)):
        try:
            versions.load(spark, store, {**st, "order_items": items}, cfg, before_publish=gate)
        except ValueError:
            continue
        raise AssertionError("the load should have failed")
    return versions.open_version(spark, store).fact_sales.select(*FACT_COLUMNS)


def _from_state(fn: Callable, name: str, *with_star: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = second_load_store(spark, sf_dir)
        sums = versions.read_state(spark, store, name, 2)
        return fn(sums, versions.open_version(spark, store, 2)) if with_star else fn(sums)
    return run


CHANGE_DAYS = (date(1998, 1, 1), date(2000, 1, 1))  # versions that sales are bound to by their dates


def q_fact_sales_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact bound to the versions valid on the order date, after two batches of customers
    and products."""
    wh = warehouse_for(spark, sf_dir)
    st, s = wh.staging, wh.star
    second = _second_extract(st)
    customers, products = None, None
    for day, x in zip(CHANGE_DAYS, (st, second), strict=True):
        customers = pin(dims.dim_customer(customers, x["customers"], st["orders"], day, SINGLE_PASS, CONFIG.gold, CONFIG.silver))
        products = pin(dims.dim_product(products, x["products"], st["suppliers"], day))
    return facts.fact_sales(st["order_items"], st["orders"], st["products"], st["promotions"], customers, products,
                            s.dim_store, s.dim_promotion, lines_colocated=True, binding=facts.AS_OF).select(*FACT_COLUMNS)


MAILED_SINCE = date(2000, 1, 1)  # orders from this day on have an e-mail in the late batch


def q_scd2_late_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after three batches of which the second comes last: the intervals, and whether a
    version's key is its own and the key's intervals do not overlap."""
    wh = warehouse_for(spark, sf_dir)
    st, key = wh.staging, ["customer_id"]
    of = lambda c: dims.scd2_source_customer(c, st["orders"], CONFIG.gold, CONFIG.silver)
    late = of(batches.customers_with_contact_update(st["customers"], st["orders"], MAILED_SINCE))
    dim, log = wh.star.dim_customer, scd.observations(of(st["customers"]), key, CONFIG.as_of)
    for day, source in ((AS_OF_3, of(batches.customers_second_extract(st["customers"], st["orders"], st["suppliers"]))), (AS_OF_2, late)):
        dim, log = (pin(x) for x in scd.scd2_splice(dim, log, source, key, "customer_key", day))
    keys = dim.groupBy("customer_key").count().withColumnRenamed("count", "__n")
    overlaps = scd.overlapping_versions(dim, key).select("customer_id").distinct().withColumn("__bad", F.lit(True))
    return dim.join(keys, "customer_key").join(overlaps, "customer_id", "left").select(
        "customer_id", "customer_name", "email", "city", "effective_date", "expiry_date", "is_current",
        hash_hex("row_hash").alias("row_hash"), (F.col("__n") == 1).alias("own_key"), F.col("__bad").isNull().alias("no_overlap"))


_MARKED: dict[tuple, dict[str, DataFrame]] = {}


def _quarantined(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    app_key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if app_key not in _MARKED:
        _MARKED[app_key] = quarantine.quarantine(batches.dirty_extract(warehouse_for(spark, sf_dir).staging), STAGING)
    return _MARKED[app_key]


def q_quarantine_q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly trend of a star loaded from the rows of a dirty extract that passed."""
    clean = {n: quarantine.accepted(df) for n, df in _quarantined(spark, sf_dir).items()}
    store = _folder(spark, "clean-rows")
    versions.load(spark, store, clean, CONFIG)
    return A.q01_monthly_trend(versions.open_version(spark, store))


_NUMBERED: dict[tuple, A.Star] = {}


def numbered_star(spark: SparkSession, sf_dir: str) -> A.Star:
    """The star with a sales fact that lies in no buckets and carries dense order numbers."""
    app_key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if app_key not in _NUMBERED:
        wh = warehouse_for(spark, sf_dir)
        buckets = with_buckets(CONFIG, wh.staging["order_items"]).order_buckets  # those of the star's fact
        fact, _ = facts.number_orders(wh.star.fact_sales, wh.staging["orders"], order_buckets=buckets)
        _NUMBERED[app_key] = replace(wh.star, fact_sales=pin(fact))
    return _NUMBERED[app_key]


RANGE = (date(2000, 11, 15), date(2001, 2, 10))  # spans both loads
PERIOD = (2001, 2)                               # fiscal year and quarter


def _keys_of(s: A.Star) -> DataFrame:
    """Rows and identity keys of the facts, keys below 1, and lines without a day in the calendar."""
    lost = s.fact_sales.join(s.dim_date, "date_key", "left_anti").agg(F.count("*").alias("lines_without_day"))
    sales = s.fact_sales.agg(F.count("*").alias("sales_rows"), F.count_distinct("sales_key").alias("sales_keys"),
                             F.count_if(F.col("sales_key") < 1).alias("keys_below_1"))
    snapshot = s.fact_inventory_snapshot.agg(
        F.count("*").alias("snapshot_rows"), F.count_distinct("inventory_snapshot_key").alias("snapshot_keys"))
    return sales.join(F.broadcast(snapshot)).join(F.broadcast(lost))  # single rows


# ---------------------------------------------------------------------------
# data-quality reports
# ---------------------------------------------------------------------------

def q_dq_unique_lines(spark, sf_dir):
    """Line numbers that an order has more than once in the driver's lines."""
    return quality.dq_unique(read_driver_tables(spark, sf_dir, ["lineitem"])["lineitem"], ["l_orderkey", "l_linenumber"])


def q_dq_not_null_stores(spark, sf_dir):
    rows = quality.dq_not_null(warehouse_for(spark, sf_dir).staging["stores"], ["store_id", "state", "region", "manager"])
    return rows.select("store_id", F.array_join("null_columns", ",").alias("null_columns"))


def q_dq_fk_idle_customers(spark, sf_dir):
    """Customers that no order of the last year names."""
    st = warehouse_for(spark, sf_dir).staging
    recent = st["orders"].where(F.col("order_date") >= F.lit(SECOND_LOAD))
    return quality.dq_fk(st["customers"], recent, ["customer_id"]).select("customer_id", "name")


def q_dq_domain_names(spark, sf_dir):
    """Product names and brands beyond tighter lengths than the contract's."""
    tight = replace(STAGING["products"], lengths={"name": 24, "brand": 7, "product_id": 20})
    return quality.dq_domain(warehouse_for(spark, sf_dir).staging["products"], tight)


def q_dq_default(spark, sf_dir):
    """Order lines of an extract without a discount column, with the declared default."""
    lines = warehouse_for(spark, sf_dir).staging["order_items"].drop("discount")
    return quality.dq_default(lines, STAGING["order_items"])


def q_dq_loadcount(spark, sf_dir):
    """Rows of the sales fact against the lines of the source, and of the lines with a discount."""
    lines = read_driver_tables(spark, sf_dir, ["lineitem"])["lineitem"].count()
    fact = _star(spark, sf_dir).fact_sales
    return quality.dq_loadcount(fact, lines).unionByName(quality.dq_loadcount(fact.where("discount_amount > 0"), lines))


def q_dq_rowcounts_all(spark, sf_dir):
    """The ten-branch report: the eight sources and two of their staging copies."""
    st = warehouse_for(spark, sf_dir).staging
    sources = adapt(read_driver_tables(spark, sf_dir))
    return quality.dq_rowcounts({**{f"public.{n}": df for n, df in sources.items()},
                                 **{f"staging.{n}": st[n] for n in ("customers", "orders")}})


def q_dq_sales_sanity(spark, sf_dir):
    return quality.dq_sales_sanity(_star(spark, sf_dir).fact_sales)


def q_dq_inventory_listing(spark, sf_dir):
    s = _star(spark, sf_dir)
    return quality.dq_inventory_listing(s.fact_inventory_snapshot, s.dim_product, s.dim_store)


def q_dq_rowcounts(spark, sf_dir):
    st = warehouse_for(spark, sf_dir).staging
    return quality.dq_rowcounts({f"staging.{n}": df for n, df in st.items()})


def q_dq_violations(spark, sf_dir):
    """Number of violations of every declared rule over the staging layer and the star."""
    wh = warehouse_for(spark, sf_dir)
    s = wh.star
    star_tables = {
        "dim_date": s.dim_date, "dim_customer": s.dim_customer, "dim_product": s.dim_product,
        "dim_store": s.dim_store, "dim_promotion": s.dim_promotion,
        "fact_sales": s.fact_sales, "fact_inventory_snapshot": s.fact_inventory_snapshot,
    }
    return quality.violation_counts(wh.staging, STAGING).unionByName(
        quality.violation_counts(star_tables, WAREHOUSE))


def _decimals_as_double(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Driver-facing output: exact decimal results are handed over as DOUBLE (the SQL oracle
    does the same), so any value comparison, Arrow- or pandas-based, sees one type. Every
    computation stays in exact decimals; only the finished column is converted."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        cols = [
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema.fields
        ]
        return df.select(*cols)
    return run


_QUERIES_EXACT: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **ANALYTICS,
    "dim_date": q_dim_date,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "dim_store": q_dim_store,
    "dim_promotion": q_dim_promotion,
    "fact_sales": q_fact_sales,
    "fact_inventory_snapshot": q_fact_inventory_snapshot,
    "stage_orders": _staged("orders"),
    "stage_order_items": _staged("order_items"),
    "stage_products": _staged("products"),
    "stage_customers": _staged("customers"),
    "stage_suppliers": _staged("suppliers"),
    "stage_stores": _staged("stores"),
    "stage_promotions": _staged("promotions"),
    "stage_inventory": _staged("inventory"),
    "scd2_customer_refresh": _customer_refresh(SINGLE_PASS),
    "scd2_customer_refresh_deferred": _customer_refresh(DEFERRED),
    "scd1_store_refresh": q_dim_store_refresh,
    "scd2_customer_mixed_refresh": q_customer_mixed_refresh,
    "scd2_customer_deferred_twice": q_customer_deferred_twice,
    "scd2_product_refresh": q_product_refresh,
    "scd1_promotion_refresh": q_promotion_refresh,
    "scd1_store_mixed_refresh": q_store_mixed_refresh,
    "append_sales_late_line": lambda spark, sf_dir: _append_bulk(True)(spark, sf_dir).select(*FACT_COLUMNS),
    "append_sales_partial_batch": lambda spark, sf_dir: _append_bulk(False)(spark, sf_dir).select(*FACT_COLUMNS),
    "snapshot_two_days": q_snapshot_two_days,
    "second_load_fact_sales": lambda spark, sf_dir: second_load_for(spark, sf_dir).fact_sales.select(*FACT_COLUMNS),
    "second_load_q01": _from_state(state.q01_from_state, "day", True),
    "second_load_q07": _from_state(state.q07_from_state, "week"),
    "second_load_q10": _from_state(state.q10_from_state, "day_product", True),
    "q05_bitmap": lambda spark, sf_dir: A.q05_store_vs_avg(numbered_star(spark, sf_dir)),
    "q07_bitmap": lambda spark, sf_dir: A.q07_weekly_moving_avg(numbered_star(spark, sf_dir)),
    "q09_bitmap": lambda spark, sf_dir: A.q09_promo_effect(numbered_star(spark, sf_dir)),
    "load_rollback": q_load_rollback,
    "fact_sales_as_of": q_fact_sales_as_of,
    "scd2_late_batch": q_scd2_late_batch,
    "quarantine_rejected": lambda spark, sf_dir: quarantine.report(_quarantined(spark, sf_dir), STAGING),
    "quarantine_counts": lambda spark, sf_dir: quarantine.counts(_quarantined(spark, sf_dir)),
    "quarantine_q01": q_quarantine_q01,
    "dq_violations_dirty": lambda spark, sf_dir: quality.violation_counts(
        batches.dirty_extract(warehouse_for(spark, sf_dir).staging), SOURCE),
    "sales_in_range": lambda spark, sf_dir: A.sales_by_day(second_load_for(spark, sf_dir), *RANGE),
    "sales_in_period": lambda spark, sf_dir: A.sales_by_day(
        second_load_for(spark, sf_dir), fiscal_year=PERIOD[0], fiscal_quarter=PERIOD[1]),
    "second_load_keys": lambda spark, sf_dir: _keys_of(second_load_for(spark, sf_dir)),
    "fact_keys": lambda spark, sf_dir: _keys_of(_star(spark, sf_dir)),
    "dq_unique_lines": q_dq_unique_lines,
    "dq_not_null_stores": q_dq_not_null_stores,
    "dq_fk_idle_customers": q_dq_fk_idle_customers,
    "dq_domain_names": q_dq_domain_names,
    "dq_default": q_dq_default,
    "dq_loadcount": q_dq_loadcount,
    "dq_rowcounts_all": q_dq_rowcounts_all,
    "dq_sales_sanity": q_dq_sales_sanity,
    "dq_inventory_listing": q_dq_inventory_listing,
    "dq_rowcounts": q_dq_rowcounts,
    "dq_violations": q_dq_violations,
}

def _decimals_as_text(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The same with exact decimals as their digits: no cent is lost at any size."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.select(*[F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
                           for f in df.schema.fields])
    return run


#: Queries that are also handed over with every digit of their decimals, as <name>_exact.
EXACT = ("q01_monthly_trend", "q04_top_customers", "q06_product_margin", "q08_segment_share", "q10_quarterly_growth",
         "dq_sales_sanity", "second_load_fact_sales")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _decimals_as_double(fn) for name, fn in _QUERIES_EXACT.items()},
    **{f"{name}_exact": _decimals_as_text(_QUERIES_EXACT[name]) for name in EXACT},
}

FLAGSHIP = "q02_category_rank_by_region"

__all__ = ["QUERIES", "FLAGSHIP", "warehouse_for", "CONFIG", "AS_OF_2"]
