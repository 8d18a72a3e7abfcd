"""The five warehouse dimensions, each as (current table, staging tables) -> new table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.contracts import WAREHOUSE
from starloom.functions.hashing import row_hash
from starloom.operators.scd import SINGLE_PASS, scd1_upsert, scd2_apply
from starloom.sources.tables import conform

# Reference thresholds on lifetime spend (sum of order header totals).
GOLD_THRESHOLD = 10_000
SILVER_THRESHOLD = 5_000

# Columns whose change opens a new version (the others are overwritten never: frozen
# until a tracked column changes).
CUSTOMER_TRACKED = ("customer_name", "email", "address", "city", "state")
PRODUCT_TRACKED = (
    "product_name", "category", "subcategory", "brand", "cost_price", "list_price",
    "supplier_name", "supplier_country",
)
STORE_UPDATE = ("store_name", "city", "state", "region", "store_type", "manager_name")
PROMOTION_UPDATE = ("promo_name", "promo_type", "discount_pct", "start_date", "end_date", "channel")


def _empty_like(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], WAREHOUSE[name].schema)


def customer_segment(
    spend: Column, gold: float | int = GOLD_THRESHOLD, silver: float | int = SILVER_THRESHOLD
) -> Column:
    """>= gold: Gold, >= silver: Silver, else (including no orders / NULL) Bronze."""
    def amount(v) -> Column:  # exact decimal literal: never compare money as a double
        return F.lit(str(v)).cast("decimal(22,2)")

    return (
        F.when(spend >= amount(gold), F.lit("Gold"))
        .when(spend >= amount(silver), F.lit("Silver"))
        .otherwise(F.lit("Bronze"))
    )


def scd2_source_customer(
    customers: DataFrame,
    orders: DataFrame,
    gold: float | int = GOLD_THRESHOLD,
    silver: float | int = SILVER_THRESHOLD,
    tracked: Sequence[str] = CUSTOMER_TRACKED,
) -> DataFrame:
    """Staging customers + lifetime spend -> dimension attributes + row hash."""
    spend = orders.groupBy("customer_id").agg(F.sum("total_amount").alias("total_spend"))
    c = customers.join(spend, "customer_id", "left")
    out = c.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "email", "phone", "address", "city", "state",
        F.col("zip").alias("zip_code"),
        customer_segment(F.col("total_spend"), gold, silver).alias("customer_segment"),
    )
    return out.withColumn("row_hash", row_hash(list(tracked)))


def scd2_source_product(
    products: DataFrame, suppliers: DataFrame, tracked: Sequence[str] = PRODUCT_TRACKED
) -> DataFrame:
    """Staging products + their supplier (denormalised) -> attributes + row hash."""
    s = suppliers.select(
        "supplier_id", F.col("name").alias("supplier_name"), F.col("country").alias("supplier_country")
    )
    out = products.join(s, "supplier_id", "left").select(
        "product_id",
        F.col("name").alias("product_name"),
        "category", "subcategory", "brand",
        F.col("cost").alias("cost_price"),
        "list_price", "supplier_name", "supplier_country",
    )
    return out.withColumn("row_hash", row_hash(list(tracked)))


def dim_customer(
    current: DataFrame | None,
    customers: DataFrame,
    orders: DataFrame,
    as_of: date | str,
    mode: str = SINGLE_PASS,
    gold: float | int = GOLD_THRESHOLD,
    silver: float | int = SILVER_THRESHOLD,
) -> DataFrame:
    src = scd2_source_customer(customers, orders, gold, silver)
    dim = current if current is not None else _empty_like(customers, "dim_customer")
    out = scd2_apply(dim, src, ["customer_id"], "customer_key", as_of, mode,
                     source_rows=customers.select("customer_id"))
    return conform(out, WAREHOUSE["dim_customer"])


def dim_product(
    current: DataFrame | None,
    products: DataFrame,
    suppliers: DataFrame,
    as_of: date | str,
    mode: str = SINGLE_PASS,
) -> DataFrame:
    src = scd2_source_product(products, suppliers)
    dim = current if current is not None else _empty_like(products, "dim_product")
    out = scd2_apply(dim, src, ["product_id"], "product_key", as_of, mode,
                     source_rows=products.select("product_id"))
    return conform(out, WAREHOUSE["dim_product"])


def dim_store(current: DataFrame | None, stores: DataFrame) -> DataFrame:
    """Type 1; ``opening_date`` is not in the update list, so its first value stays."""
    src = stores.select(
        "store_id",
        F.col("name").alias("store_name"),
        "city", "state", "region",
        F.col("type").alias("store_type"),
        F.col("manager").alias("manager_name"),
        F.col("open_date").alias("opening_date"),
    )
    dim = current if current is not None else _empty_like(stores, "dim_store")
    out = scd1_upsert(dim, src, ["store_id"], "store_key", STORE_UPDATE)
    return conform(out, WAREHOUSE["dim_store"])


def dim_promotion(current: DataFrame | None, promotions: DataFrame) -> DataFrame:
    """Type 1 with all six attributes overwritten."""
    src = promotions.select(
        "promo_id",
        F.col("name").alias("promo_name"),
        F.col("type").alias("promo_type"),
        "discount_pct", "start_date", "end_date", "channel",
    )
    dim = current if current is not None else _empty_like(promotions, "dim_promotion")
    out = scd1_upsert(dim, src, ["promo_id"], "promotion_key", PROMOTION_UPDATE)
    return conform(out, WAREHOUSE["dim_promotion"])
