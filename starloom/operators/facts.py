"""Fact construction: the order-line sales fact and the daily inventory snapshot.

Join plan of ``fact_sales`` (written in the order that keeps the big side small and the
number of line shuffles at two):

1. order headers get their customer key (current version) and store key first: that join
   has order cardinality, four times smaller than lines;
2. the two product-level inputs (current product version and staging cost) are joined to
   each other once, so lines meet products in a single join; Spark broadcasts that lookup
   if it is small, otherwise lines shuffle once on ``product_id``, while they are still narrow;
3. lines then join the enriched headers on ``order_id``, and the line-number window on
   ``order_id`` reuses that partitioning (no further exchange): no shuffle carries header columns.

No dimension join is forced to a broadcast: Spark's byte limit and AQE choose (a join becomes a
broadcast at run time when one side is small, and skewed keys are split otherwise).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.contracts import WAREHOUSE
from starloom.functions import dates as D
from starloom.functions.money import decimal_lit
from starloom.operators.ranking import assign_surrogate_keys
from starloom.operators.scd import scd_current
from starloom.operators.skew import number_hot, split_hot
from starloom.sources.tables import conform

TAX_RATE = "0.08"

# Which version of a customer or product a sale is bound to.
CURRENT, AS_OF = "current", "as_of"


# ---------------------------------------------------------------------------
# Line measures (exact decimals; every rounding is half away from zero)
# ---------------------------------------------------------------------------

def _gross(price: Column, qty: Column) -> Column:
    return price * qty


def _discount_exact(price: Column, qty: Column, pct: Column) -> Column:
    return price * qty * pct / decimal_lit("100", 3, 0)


def measure_discount(price: Column, qty: Column, pct: Column) -> Column:
    """ROUND(price * qty * pct / 100, 2); ``pct`` is a percentage 0..100."""
    return F.round(_discount_exact(price, qty, pct), 2).cast("decimal(10,2)")


def _net_exact(price: Column, qty: Column, pct: Column) -> Column:
    return _gross(price, qty) - _discount_exact(price, qty, pct)


def measure_net_revenue(price: Column, qty: Column, pct: Column) -> Column:
    """ROUND(gross - unrounded discount, 2) (not gross minus the rounded discount)."""
    return F.round(_net_exact(price, qty, pct), 2).cast("decimal(12,2)")


def measure_gross_profit(price: Column, qty: Column, pct: Column, cost: Column) -> Column:
    """ROUND(unrounded net - cost * qty, 2)."""
    return F.round(_net_exact(price, qty, pct) - cost * qty, 2).cast("decimal(12,2)")


def measure_tax(price: Column, qty: Column, pct: Column, rate: str = TAX_RATE) -> Column:
    """ROUND(unrounded net * rate, 2) with the rate as an exact decimal literal."""
    return F.round(_net_exact(price, qty, pct) * decimal_lit(rate, 5, 4), 2).cast("decimal(10,2)")


# ---------------------------------------------------------------------------
# Keys
# ---------------------------------------------------------------------------

def promo_resolve(discount: Column, promotions: DataFrame, dim_promotion: DataFrame) -> Column:
    """Promotion key of a line: a discounted line (discount > 0) gets one promotion, chosen
    deterministically as the smallest ``promo_id`` of the staging promotions and looked up in
    ``dim_promotion``; any other line gets NULL. Dates and percentages are not checked.

    Both lookups are uncorrelated scalar subqueries (one value each), not joins.
    """
    chosen = promotions.agg(F.min("promo_id").alias("promo_id"))
    key = dim_promotion.join(chosen, "promo_id").agg(F.max("promotion_key")).scalar()
    return F.when(discount > 0, key)


def line_number(order_col: str = "order_id", item_col: str = "item_id") -> Column:
    """ROW_NUMBER() OVER (PARTITION BY order ORDER BY item), as INT."""
    return F.row_number().over(Window.partitionBy(order_col).orderBy(item_col)).cast("int")


def _identity(start_after: int | Column) -> Column:
    """Unique BIGINT identity for one load: ``start_after`` + 1 + a per-row id that is
    unique across partitions. Values have gaps (like a sequence after rollbacks) but never
    repeat across loads when ``start_after`` is the largest key already written. The id is
    taken right after a sort on a unique key, so a retried task reproduces it."""
    start = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return (start + F.lit(1) + F.monotonically_increasing_id()).cast("long")


def number_orders(fact: DataFrame, orders: DataFrame, numbered: DataFrame | None = None,
                  order_buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(``fact`` with ``order_no``, the orders' numbers): orders are numbered densely from 1 in the
    order of their ids, new ones after those that ``numbered`` (order_id, order_no) of the earlier
    loads holds. For distinct counts by bitmap; the numbers are made at the size of the headers.

    ``order_buckets``: numbers run through one bucket of ``order_id`` after the other, so that a task
    on a fact in so many buckets meets neighbouring numbers, which share the words of a bitmap."""
    ids = orders.select("order_id").distinct()
    start = 0
    if numbered is not None:
        ids = ids.join(numbered, "order_id", "left_anti")
        start = numbered.agg(F.coalesce(F.max("order_no"), F.lit(0)).alias("m")).scalar()
    by = ["order_id"]
    if order_buckets:  # Spark's own rule for the bucket of a row
        ids, by = ids.withColumn("__bucket_no", F.pmod(F.hash("order_id"), F.lit(order_buckets))), ["__bucket_no", *by]
    fresh = assign_surrogate_keys(ids, by, "order_no", start_after=start, key_type="bigint").select("order_id", "order_no")
    every = fresh if numbered is None else numbered.unionByName(fresh)
    return fact.join(every, "order_id").select(*[fact[c] for c in fact.columns], "order_no"), every


def bind_as_of(rows: DataFrame, dim: DataFrame, natural: str, day: str, surrogate: str) -> DataFrame:
    """``rows`` with the surrogate key of the version that was valid on ``day``.

    Versions and rows of a natural key meet in one sorted window, where each row takes the last
    version that had begun: no row is multiplied by versions. Rows before the first version take
    that one (a first load's versions begin on the load date, after all its sales); rows without
    any version are dropped. Versions closed before they began (a second change on one day)
    were never valid. Natural keys with very many rows meet a broadcast of their versions instead.
    """
    valid = dim.where(F.col("expiry_date") >= F.col("effective_date")).select(
        natural, F.col("effective_date").alias("__from"), F.col(surrogate).alias("__version"))
    ordinary, hot_rows, hot = split_hot(rows, [natural])
    line = F.struct(*[F.col(c) for c in rows.columns]).alias("__line")
    none = F.lit(None)
    both = ordinary.select(natural, F.col(day).alias("__at"), F.lit(1).alias("__is_line"), none.cast("int").alias("__version"), line).unionByName(
        valid.select(natural, F.col("__from").alias("__at"), F.lit(0).alias("__is_line"), F.col("__version").cast("int"),
                     none.cast(ordinary.select(line).schema["__line"].dataType).alias("__line")))
    order = Window.partitionBy(natural).orderBy("__at", "__is_line")
    begun = F.last("__version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first("__version", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    # the natural key is the window's own, so that a later join on it needs no shuffle
    out = both.withColumn("__version", F.coalesce(begun, first)).where("__is_line = 1 AND __version IS NOT NULL").select(
        *[F.col(c) if c == natural else F.col(f"__line.{c}") for c in rows.columns], F.col("__version").alias(surrogate))
    if hot_rows is None:
        return out
    # a key's versions in one row: bounded by the few hot keys
    few = valid.join(F.broadcast(hot), natural, "left_semi").groupBy(natural).agg(
        F.array_sort(F.collect_list(F.struct("__from", "__version"))).alias("__all"))
    begun = F.filter("__all", lambda v: v["__from"] <= F.col(day))
    chosen = F.coalesce(F.try_element_at(begun, F.lit(-1)), F.get("__all", F.lit(0)))["__version"]
    return out.unionByName(hot_rows.join(F.broadcast(few), natural).select(
        *rows.columns, chosen.cast("int").alias(surrogate)))


# ---------------------------------------------------------------------------
# fact_sales
# ---------------------------------------------------------------------------

def fact_sales(
    order_items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    promotions: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    dim_promotion: DataFrame,
    tax_rate: str = TAX_RATE,
    start_after: int | Column = 0,
    lines_colocated: bool = False,
    binding: str = CURRENT,
    order_buckets: int | None = None,
) -> DataFrame:
    """One row per order line with surrogate keys and measures, and as a last column the
    ``item_id`` that identifies the line in later loads.

    ``lines_colocated``: order lines are already partitioned by ``order_id`` (a bucketed
    staging table). With a broadcast product lookup that partitioning survives into the join with the
    headers and the line-number window, so the lines are not shuffled at all; the plan is the same
    either way. Numbering always comes after both inner joins: a dropped line leaves no gap.

    ``order_buckets``: the rows go into that many buckets of orders. If the lines must be shuffled
    for their headers, it is into these, and a bucketed write needs no shuffle of its own.

    Inner joins: orders, current customer, current product, store, staging product (the
    cost comes from staging, not from the dimension version). Left: promotion. Lines whose
    keys do not resolve are dropped; no filter on order status.

    ``binding="as_of"`` binds customers and products to the versions valid on the order date
    (:func:`bind_as_of`) instead of the current ones.
    """
    if binding not in (CURRENT, AS_OF):
        raise ValueError(f"unknown binding {binding!r}")
    store = dim_store.select("store_id", "store_key")
    headers = orders.select("order_id", "customer_id", "order_date", "store_id")
    costs = products.select("product_id", F.col("cost").alias("unit_cost"))
    if binding == CURRENT:
        headers = headers.join(scd_current(dim_customer).select("customer_id", "customer_key"), "customer_id")
        product_lookup = scd_current(dim_product).select("product_id", "product_key").join(costs, "product_id")
    else:
        headers = bind_as_of(headers, dim_customer, "customer_id", "order_date", "customer_key")
    headers = headers.join(store, "store_id").select("order_id", "order_date", "customer_key", "store_key")
    items = order_items.select("item_id", "order_id", "product_id", "quantity", "unit_price", "discount")
    # Orders with a huge number of lines are split off: they meet a broadcast of their own
    # headers and are numbered by the distributed path instead of one task per order.
    items, hot_items, hot = split_hot(items, ["order_id"])

    day = D.date_key("order_date").alias("date_key")

    def bound(items: DataFrame, headers: DataFrame, buckets: int | None = None) -> DataFrame:
        if binding == CURRENT:
            lines = items.join(product_lookup, "product_id")
            if buckets:
                # both sides, left out where they lie so already: headers that lie in other buckets would take
                # the lines into theirs, and whole rows would move again for the write
                lines, headers = (x.repartition(buckets, "order_id") for x in (lines, headers))
            # the day's key is made above the headers' exchange: of two bare exchanges with fewer partitions than
            # spark.sql.shuffle.partitions Spark would make two with that many
            return lines.join(headers.select("order_id", day, "customer_key", "store_key"), "order_id")
        # a line needs its date first; version and cost then come in one shuffle by product
        lines = bind_as_of(items.join(headers, "order_id"), dim_product, "product_id", "order_date", "product_key")
        lines = lines.join(costs, "product_id").withColumn("date_key", day).drop("order_date")
        return lines.repartition(buckets, "order_id") if buckets else lines

    lines = bound(items, headers, order_buckets).withColumn("order_line_num", line_number())
    if hot_items is not None:
        # one header per hot order; hot orders are few (see skew.HOT_GROUP_ROWS)
        hot_headers = F.broadcast(headers.join(hot, "order_id", "left_semi"))
        hot_lines = number_hot(
            bound(hot_items, hot_headers), ["order_id"], ["item_id"], "order_line_num",
        )
        lines = lines.unionByName(hot_lines.select(*lines.columns))
    price, qty, pct, cost = F.col("unit_price"), F.col("quantity"), F.col("discount"), F.col("unit_cost")
    out = lines.select(
        "date_key", "customer_key", "product_key", "store_key",
        promo_resolve(pct, promotions, dim_promotion).alias("promotion_key"),
        "order_id",
        "order_line_num",
        "item_id",
        "quantity", "unit_price", "unit_cost",
        measure_discount(price, qty, pct).alias("discount_amount"),
        measure_net_revenue(price, qty, pct).alias("net_revenue"),
        measure_gross_profit(price, qty, pct, cost).alias("gross_profit"),
        measure_tax(price, qty, pct, tax_rate).alias("tax_amount"),
    )
    out = out.withColumn("sales_key", _identity(start_after))
    return conform(out, WAREHOUSE["fact_sales"], "item_id")


# ---------------------------------------------------------------------------
# fact_inventory_snapshot
# ---------------------------------------------------------------------------

def fact_inventory_snapshot(
    inventory: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    as_of: date | str,
    start_after: int | Column = 0,
) -> DataFrame:
    """Stock per product x store at the load date (inner joins: current product, store)."""
    snap = F.lit(as_of).cast("date")
    prod = scd_current(dim_product).select("product_id", "product_key")
    store = dim_store.select("store_id", "store_key")
    out = (
        inventory.join(prod, "product_id")
        .join(store, "store_id")
        .select(
            "product_key", "store_key",
            D.date_key(snap).alias("date_key"),
            F.col("quantity_on_hand").alias("qty_on_hand"),
            "reorder_point", "last_restock_date",
            snap.alias("snapshot_date"),
        )
    )
    out = out.withColumn("inventory_snapshot_key", _identity(start_after))
    return conform(out, WAREHOUSE["fact_inventory_snapshot"])
