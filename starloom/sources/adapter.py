"""Map the driver's TPC-H-like tables onto the eight operational source tables.

Every source table is a pure DataFrame derivation of the driver tables, so its cost grows
with them and everything stays distributed:

===========  ==================================================================================
suppliers    supplier + nation: country = nation name
products     part: category = p_type, brand = p_brand, list price = p_retailprice (exact
             decimal), cost = 60 % of list price rounded to cents, supplier = the lowest
             supplier key that ever shipped the part (lineitem aggregate)
customers    customer + nation: city = nation name; no e-mail/phone/address/state/zip (NULL)
stores       one store per nation: region = region name, type from the nation key
promotions   one promotion per distinct discount percentage > 0 found on order lines
orders       orders + customer: store = the store of the customer's nation
order_items  lineitem: item id = order key + 10-digit position of the line inside the order
             (ordered by every column, lines are not unique on l_linenumber), unit price =
             extended price / quantity rounded to cents, discount = percentage 0..100
inventory    per (store of the supplier's nation, part): on-hand = shipped quantity,
             reorder point = on-hand div 5, last restock = last ship date
===========  ==================================================================================

``lineitem`` is aggregated by part for the primary supplier, and by (store, part) for the inventory
after its suppliers gave the store, so that neither moves (part, supplier) pairs, which are nearly
as many as the lines. No join is forced to a broadcast: Spark's planner and AQE choose by size.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.contracts import SOURCE
from starloom.operators.skew import row_number_within
from starloom.sources.tables import conform

# Store types by nation key mod 5 (same five types as the reference sample).
STORE_TYPES = ["Flagship", "Mall", "Downtown", "Suburban", "Online"]
# Cost of a product as a share of its list price.
COST_RATIO = "0.60"
# Creation date given to every adapted customer (the driver tables have none).
DEFAULT_CUSTOMER_SINCE = date(1992, 1, 1)


LINE_DIGITS = 10  # of an item id: ids sort like numbers, and no order has more lines


def padded(number: F.Column, digits: int) -> F.Column:
    """A number with leading zeros; a longer number keeps all its digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def fixed_width(number: F.Column, digits: int) -> F.Column:
    """A number in exactly so many digits; a longer one is an error, not cut."""
    return F.when(F.length(number.cast("string")) > digits, F.raise_error(F.lit(f"more than {digits} digits")).cast(
        "string")).otherwise(F.lpad(number.cast("string"), digits, "0"))


def store_id(nation_key_col) -> F.Column:
    return F.concat(F.lit("STR"), padded(nation_key_col, 3))


def adapt(
    t: dict[str, DataFrame], customer_since: date = DEFAULT_CUSTOMER_SINCE, order_buckets: int | None = None
) -> dict[str, DataFrame]:
    """Driver tables (by name) -> the eight source tables (by name), contract-typed.

    ``order_buckets``: order lines are shuffled for their numbers into that many buckets of
    ``order_id``, so that a staging copy in these buckets needs no further shuffle."""
    nation = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = t["region"].select("r_regionkey", "r_name")
    li = t["lineitem"]

    suppliers = t["supplier"].join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("s_suppkey").cast("string").alias("supplier_id"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("contact"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("int").alias("lead_time_days"),
    )

    primary_supplier = li.groupBy("l_partkey").agg(F.min("l_suppkey").alias("primary_suppkey"))
    list_price = F.col("p_retailprice").cast("decimal(10,2)")
    products = t["part"].join(
        primary_supplier, F.col("p_partkey") == F.col("l_partkey"), "left"
    ).select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.round(list_price * F.lit(COST_RATIO).cast("decimal(3,2)"), 2)
        .cast("decimal(10,2)").alias("cost"),
        list_price.alias("list_price"),
        F.col("primary_suppkey").cast("string").alias("supplier_id"),
    )

    customers = t["customer"].join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("address"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("zip"),
        F.lit(customer_since).alias("created_date"),
    )

    store_types = F.array(*[F.lit(s) for s in STORE_TYPES])
    stores = t["nation"].join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    ).select(
        store_id(F.col("n_nationkey")).alias("store_id"),
        F.concat(F.col("n_name"), F.lit(" Store")).alias("name"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.col("r_name").alias("region"),
        F.element_at(store_types, (F.pmod(F.col("n_nationkey"), F.lit(len(STORE_TYPES))) + 1)
                     .cast("int")).alias("type"),
        F.lit(None).cast("string").alias("manager"),
        F.lit(None).cast("date").alias("open_date"),
    )

    pct = (F.col("l_discount").cast("decimal(4,2)") * 100).cast("decimal(5,2)")
    promotions = li.select(pct.alias("discount_pct")).where(F.col("discount_pct") > 0).distinct()
    promotions = promotions.select(
        F.concat(F.lit("PRM"), fixed_width(F.col("discount_pct").cast("int"), 3))
        .alias("promo_id"),
        F.concat(F.col("discount_pct").cast("int").cast("string"), F.lit("% Off")).alias("name"),
        F.lit("Percentage").alias("type"),
        F.col("discount_pct"),
        F.lit(None).cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit("All").alias("channel"),
    )

    cust_nation = t["customer"].select("c_custkey", "c_nationkey")
    orders = t["orders"].join(
        cust_nation, F.col("o_custkey") == F.col("c_custkey"), "left"
    ).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        store_id(F.col("c_nationkey")).alias("store_id"),
    )

    # Position of a line inside its order, ordered by every column (lines are not unique on
    # l_linenumber). Orders with a huge number of lines are numbered without a per-order task.
    line_cols = [
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    order_id = F.col("l_orderkey").cast("string").alias("order_id")
    numbered = row_number_within(
        li.select(order_id, *line_cols), ["order_id"], line_cols, "line_seq", partitions=order_buckets
    )
    qty = F.col("l_quantity").cast("int")
    order_items = numbered.select(
        F.concat(
            F.col("order_id"), F.lit("-"),
            fixed_width(F.col("line_seq"), LINE_DIGITS),
        ).alias("item_id"),
        "order_id",
        F.col("l_partkey").cast("string").alias("product_id"),
        qty.alias("quantity"),
        F.round(F.col("l_extendedprice").cast("decimal(12,2)") / F.nullif(qty, F.lit(0)), 2)
        .cast("decimal(10,2)").alias("unit_price"),
        pct.alias("discount"),
    )

    supp_nation = t["supplier"].select("s_suppkey", "s_nationkey")
    inventory = (
        li.select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
        .join(supp_nation, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "l_partkey")
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("on_hand"),
             F.max(F.col("l_shipdate").cast("date")).alias("last_restock_date"))
        .select(
            store_id(F.col("s_nationkey")).alias("store_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("on_hand").cast("int").alias("quantity_on_hand"),
            F.expr("on_hand div 5").cast("int").alias("reorder_point"),
            F.col("last_restock_date"),
        )
    )

    out = {
        "suppliers": suppliers,
        "products": products,
        "customers": customers,
        "stores": stores,
        "promotions": promotions,
        "orders": orders,
        "order_items": order_items,
        "inventory": inventory,
    }
    return {name: conform(df, SOURCE[name]) for name, df in out.items()}
