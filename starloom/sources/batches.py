"""Later source batches derived from the first one, for SCD refresh runs.

A refresh needs a second extract of the operational tables. The driver's tables are a
single snapshot, so the second extract is derived from them by a business rule:

* customers: the CRM export now carries an e-mail address for every customer who ordered
  on or after ``active_since`` (``lower(name)`` with '#' as '.', at example.com). E-mail is a
  tracked column, so exactly those customers get a new version;
* stores: every store now has a manager on record ("Manager of <store name>") and the
  export carries an opening date, which a Type 1 load must not apply (first value wins).

The ``*_second_extract`` functions go further: besides changed keys they hold new keys, leave
known keys out, and change columns that are not tracked.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ACTIVE_SINCE = date(2001, 1, 1)
EMAIL_DOMAIN = "example.com"


def customers_with_contact_update(
    customers: DataFrame, orders: DataFrame, active_since: date = DEFAULT_ACTIVE_SINCE
) -> DataFrame:
    active = (
        orders.where(F.col("order_date") >= F.lit(active_since))
        .select("customer_id").distinct()
        .withColumn("__active", F.lit(True))
    )
    email = F.concat(
        F.lower(F.regexp_replace(F.col("name"), "#", ".")), F.lit("@" + EMAIL_DOMAIN)
    )
    return customers.join(active, "customer_id", "left").select(
        *[
            (F.when(F.col("__active"), email).otherwise(F.col("email")).alias("email")
             if c == "email" else F.col(c))
            for c in customers.columns
        ]
    )


ABSENT_BELOW = 1_000_000   # lifetime spend of customers that the second extract leaves out
REPRICED_FROM = 910        # list price of products whose cost rises
VARIANT_FROM = 917         # list price of products that get a second variant
COST_RISE = "1.10"
DROPPED_FROM = 8           # discount percentage of promotions that the second extract leaves out


def _set(df: DataFrame, **values) -> DataFrame:
    return df.select(*[values[c].cast(df.schema[c].dataType).alias(c) if c in values else F.col(c) for c in df.columns])


def customers_second_extract(customers: DataFrame, orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Active customers have an e-mail (tracked), the others a phone number (not tracked), small
    ones are missing, and every supplier is a customer too."""
    mailed = customers_with_contact_update(customers, orders)
    spend = orders.groupBy("customer_id").agg(F.sum("total_amount").alias("__spend"))
    kept = mailed.join(spend, "customer_id", "left").where(F.coalesce("__spend", F.lit(0)) >= ABSENT_BELOW).select(*customers.columns)
    kept = _set(kept, phone=F.when(F.col("email").isNull(), F.concat(F.lit("000-"), "customer_id")).otherwise(F.col("phone")))
    columns = {"customer_id": F.concat(F.lit("S"), "supplier_id"), "name": F.col("name"), "city": F.col("country"),
               "created_date": F.lit(DEFAULT_ACTIVE_SINCE)}
    new = suppliers.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in customers.schema])
    return kept.unionByName(new)


def products_second_extract(products: DataFrame) -> DataFrame:
    """Dear products cost more, the dearest have a second variant, unsupplied ones are missing."""
    kept = products.where(F.col("supplier_id").isNotNull())
    risen = F.round(F.col("cost") * F.lit(COST_RISE).cast("decimal(3,2)"), 2)
    kept = _set(kept, cost=F.when(F.col("list_price") >= REPRICED_FROM, risen).otherwise(F.col("cost")))
    variant = _set(products.where(F.col("list_price") >= VARIANT_FROM), product_id=F.concat(F.lit("N"), "product_id"),
                   name=F.concat("name", F.lit(" II")))
    return kept.unionByName(variant)


def promotions_second_extract(promotions: DataFrame) -> DataFrame:
    """Names are in capitals, large discounts are missing, and every other one has a web version."""
    kept = promotions.where(F.col("discount_pct") < DROPPED_FROM)
    web = _set(promotions, promo_id=F.concat(F.lit("WEB"), "promo_id"), channel=F.lit("Web"))
    return _set(kept, name=F.upper("name")).unionByName(web)


def stores_second_extract(stores: DataFrame, open_date: date) -> DataFrame:
    """All stores have managers; online stores are missing, and each of them is a new pick-up point."""
    managed = stores_with_managers(stores, open_date)
    point = _set(managed.where(F.col("type") == "Online"), store_id=F.concat(F.lit("PUP"), "store_id"), type=F.lit("Pick-up"))
    return managed.where(F.col("type") != "Online").unionByName(point)


def stores_with_managers(stores: DataFrame, open_date: date) -> DataFrame:
    return stores.select(
        *[
            F.concat(F.lit("Manager of "), F.col("name")).alias("manager") if c == "manager"
            else F.lit(open_date).cast("date").alias("open_date") if c == "open_date"
            else F.col(c)
            for c in stores.columns
        ]
    )


LONG_NAME = 8  # times a product's brand is repeated in the dirty extract


def dirty_extract(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """An extract that breaks rules: customers of nations with A have no name, brands that end with 1
    are too long, headers of the 13th of a month come twice, and lines of 50 pieces name products
    that do not exist."""
    orders = tables["orders"]
    return {
        **tables,
        "customers": _set(tables["customers"], name=F.when(~F.col("city").startswith("A"), F.col("name"))),
        "products": _set(tables["products"], brand=F.when(
            F.col("brand").endswith("1"), F.repeat("brand", F.lit(LONG_NAME))).otherwise(F.col("brand"))),
        "orders": orders.unionByName(orders.where(F.dayofmonth("order_date") == 13)),
        "order_items": _set(tables["order_items"], product_id=F.when(
            F.col("quantity") == 50, F.concat(F.lit("X"), "product_id")).otherwise(F.col("product_id"))),
    }
