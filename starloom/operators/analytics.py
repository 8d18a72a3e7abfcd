"""The eleven analytical queries on the star, as DataFrame operators.

Every query takes the star's tables (``Star`` or keyword DataFrames) and returns a lazy
DataFrame with the reference's output columns. Conventions:

* money totals are ``decimal(22,2)``, percentages ``decimal(22,2)``, counts and ranks BIGINT;
* means are ``sum / count`` on exact decimals, rounded once;
* NULL ordering follows the reference engine (ASC -> NULLS LAST, DESC -> NULLS FIRST);
* windows over inputs bounded by nature (months, weeks, quarters x categories, stores,
  segments, promotions) use plain Spark windows; ranks and tiles over customers and products
  go through ``operators.ranking``, all of a query's in one range exchange, so no single task
  sorts the whole input;
* no dimension join is forced to a broadcast (Spark's byte limit and AQE choose); the fact table
  is read with just the columns each query needs (Parquet column pruning).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import bitmaps as B
from starloom.functions import dates as D
from starloom.functions.money import (
    MONEY_TOTAL,
    growth_pct,
    money,
    pct,
    round2,
    rounded_mean,
    rounded_money,
)
from starloom.operators import ranking as R
from starloom.operators.scd import scd_current


@dataclass
class Star:
    """The warehouse tables an analytical query may read."""

    fact_sales: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_store: DataFrame
    dim_promotion: DataFrame
    fact_inventory_snapshot: DataFrame | None = None


def _dates(star: Star, *cols: str) -> DataFrame:
    # The calendar is bounded by its date range (~366 rows per year).
    return star.dim_date.select("date_key", *cols)


def _stores(star: Star, *cols: str) -> DataFrame:
    return star.dim_store.select("store_key", *cols)


def _with_orders(df: DataFrame, groups: list[str], orders: str, sums: dict[str, str], least: dict[str, str] | None = None) -> DataFrame:
    """Per group: distinct orders, and for each ``sums`` name the sum and the count (name + "_n") of
    its column; ``least``: minima. A fact that carries dense order numbers (``order_no``) is counted
    by bitmaps, one row per group and 32,768 orders in the shuffle; any other by the order id."""
    least = least or {}
    if "order_no" not in df.columns:
        return df.groupBy(*groups).agg(
            F.count_distinct("order_id").alias(orders), *[F.sum(c).alias(n) for n, c in sums.items()],
            *[F.count(c).alias(f"{n}_n") for n, c in sums.items()], *[F.min(c).alias(n) for n, c in least.items()])
    parts = B.bitmaps(df, groups, "order_no", *[F.sum(c).alias(n) for n, c in sums.items()],
                      *[F.count(c).alias(f"{n}_n") for n, c in sums.items()], *[F.min(c).alias(n) for n, c in least.items()])
    return parts.groupBy(*groups).agg(
        B.n_set().cast("long").alias(orders), *[F.sum(n).alias(n) for n in sums], *[F.sum(f"{n}_n").alias(f"{n}_n") for n in sums],
        *[F.min(n).alias(n) for n in least])


def _order(fact: DataFrame) -> str:
    return "order_no" if "order_no" in fact.columns else "order_id"


def _bigint(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# ---------------------------------------------------------------------------
# Q01 monthly trend: revenue, year-to-date, previous month, growth %
# ---------------------------------------------------------------------------

def q01_monthly_trend(star: Star) -> DataFrame:
    f = star.fact_sales.select("date_key", "net_revenue")
    m = (
        f.join(_dates(star, "year_number", "month_number", "month_name"), "date_key")
        .groupBy("year_number", "month_number", "month_name")
        .agg(money(F.sum("net_revenue")).alias("monthly_revenue"))
    )
    ytd = Window.partitionBy("year_number").orderBy("month_number")
    timeline = Window.orderBy("year_number", "month_number")  # one row per month: bounded
    prev = F.lag("monthly_revenue").over(timeline)
    return (
        m.select(
            "year_number", "month_number", "month_name", "monthly_revenue",
            money(F.sum("monthly_revenue").over(ytd)).alias("ytd_revenue"),
            prev.alias("prev_month_revenue"),
            growth_pct(F.col("monthly_revenue"), prev).alias("mom_growth_pct"),
        )
        .orderBy("year_number", "month_number")
        .drop("month_number")
    )


# ---------------------------------------------------------------------------
# Sales of a date range or of a fiscal period
# ---------------------------------------------------------------------------

def sales_by_day(star: Star, start: date | None = None, end: date | None = None,
                 fiscal_year: int | None = None, fiscal_quarter: int | None = None) -> DataFrame:
    """Lines, orders, quantity, revenue and profit of each day with sales from ``start`` to ``end`` and
    within a fiscal year and quarter (each limit only if given).

    On a fact in month folders the dates' months are filtered as literals, and the join with the
    calendar names the month, so that a filter on the calendar prunes folders at run time."""
    days = star.dim_date
    for column, value in (("fiscal_year", fiscal_year), ("fiscal_quarter", fiscal_quarter)):
        if value is not None:
            days = days.where(F.col(column) == value)
    f, on = star.fact_sales, ["date_key"]
    if "month_key" in f.columns:
        days, on = days.withColumn("month_key", F.expr("date_key div 100").cast("int")), ["month_key", "date_key"]
    for limit, below in ((start, False), (end, True)):
        if limit is not None:
            key = limit.year * 10_000 + limit.month * 100 + limit.day
            keep = lambda c, v: F.col(c) <= v if below else F.col(c) >= v
            days, f = days.where(keep("date_key", key)), f.where(keep("date_key", key))
            if len(on) > 1:
                f = f.where(keep("month_key", key // 100))
    f = f.select(*on, "order_id", "quantity", "net_revenue", "gross_profit")
    return (
        f.join(days.select(*on, "full_date"), on)
        .groupBy("full_date")
        .agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("order_id").alias("orders"),
             _bigint(F.sum("quantity")).alias("units_sold"),
             rounded_money(F.sum("net_revenue")).alias("revenue"), rounded_money(F.sum("gross_profit")).alias("profit"))
        .orderBy("full_date")
    )


# ---------------------------------------------------------------------------
# Q02 category ranking by region (top 5 per region, ties kept)
# ---------------------------------------------------------------------------

def q02_category_rank_by_region(star: Star, top: int = 5) -> DataFrame:
    f = star.fact_sales.select("product_key", "store_key", "net_revenue")
    p = scd_current(star.dim_product).select("product_key", "category")
    # Join first: grouping by (product, region) before the product join would hash on both
    # keys and force a second exchange for the join; the (region, category) aggregate after
    # it is tiny and fully combined map-side.
    cr = (
        f.join(p, "product_key")
        .join(_stores(star, "region"), "store_key")
        .groupBy("region", "category")
        .agg(money(F.sum("net_revenue")).alias("total_revenue"))
    )
    w = Window.partitionBy("region").orderBy(F.col("total_revenue").desc_nulls_first())
    return (
        cr.withColumn("category_rank", _bigint(F.rank().over(w)))
        .where(F.col("category_rank") <= top)
        .orderBy(F.col("region").asc_nulls_last(), "category_rank")
    )


# ---------------------------------------------------------------------------
# Q03 cohorts: month of first purchase x months since
# ---------------------------------------------------------------------------

def q03_cohort(star: Star) -> DataFrame:
    f = star.fact_sales.select("customer_key", "date_key", "net_revenue")
    # Reduce lines to (customer, activity month) first: the partial aggregate removes a hot
    # customer's volume before the shuffle, and the cohort window then sees at most one row
    # per month per customer.
    cm = (
        f.join(_dates(star, "full_date"), "date_key")
        .groupBy("customer_key", D.month_start("full_date").alias("activity_month"))
        .agg(F.sum("net_revenue").alias("revenue"))
    )
    first = Window.partitionBy("customer_key")
    cm = cm.withColumn("cohort_month", F.min("activity_month").over(first))
    cohorts = (
        cm.groupBy(
            "cohort_month",
            D.months_between_starts("activity_month", "cohort_month").alias("months_since_first"),
        )
        # one row per (customer, month) here, so a row count is COUNT(DISTINCT customer)
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            money(F.sum("revenue")).alias("cohort_revenue"),
        )
    )
    return cohorts.orderBy("cohort_month", "months_since_first")


# ---------------------------------------------------------------------------
# Q04 top customers
# ---------------------------------------------------------------------------

def q04_top_customers(star: Star, buckets: int | None = None) -> DataFrame:
    c = scd_current(star.dim_customer).select(
        "customer_key", "customer_name", "customer_segment", "city", "state"
    )
    # Eager aggregation to one row per customer version: an order belongs to one customer,
    # so distinct orders per group are the sum of distinct orders per customer key.
    per_customer = star.fact_sales.groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("quantity").alias("items"),
        F.sum("net_revenue").alias("revenue"),
        F.count("net_revenue").alias("lines"),
    )
    g = (
        per_customer.join(c, "customer_key")
        .groupBy("customer_name", "customer_segment", "city", "state")
        .agg(
            _bigint(F.sum("orders")).alias("total_orders"),
            _bigint(F.sum("items")).alias("total_items"),
            F.sum("revenue").alias("__revenue"),
            F.sum("lines").alias("__lines"),
        )
        .select(
            "customer_name", "customer_segment", "city", "state", "total_orders", "total_items",
            rounded_money("__revenue").alias("total_revenue"),
            rounded_mean("__revenue", "__lines").alias("avg_order_value"),
            money("__revenue").alias("__revenue"),
        )
    )
    # the rank reads its input twice (keys, join back)
    ranked = R.rank(R.pin(g), [R.desc("__revenue")], out="revenue_rank", buckets=buckets)
    return ranked.drop("__revenue").orderBy(
        "revenue_rank", "customer_name", "customer_segment", "city", "state")


# ---------------------------------------------------------------------------
# Q05 store performance vs company average
# ---------------------------------------------------------------------------

def q05_store_vs_avg(star: Star) -> DataFrame:
    f = star.fact_sales.select("store_key", _order(star.fact_sales), "net_revenue")
    sr = _with_orders(
        f.join(_stores(star, "store_name", "region", "store_type"), "store_key"),
        ["store_name", "region", "store_type"], "total_orders", {"rev": "net_revenue"},
    ).select(
        "store_name", "region", "store_type", rounded_money("rev").alias("total_revenue"), "total_orders",
        rounded_mean("rev", "rev_n").alias("avg_order_value"),
    )
    every, best = Window.partitionBy(), Window.orderBy(F.col("total_revenue").desc_nulls_first())  # stores: bounded
    avg = F.sum("total_revenue").over(every) / F.count("total_revenue").over(every)
    return sr.select(
        "store_name", "region", "store_type", "total_revenue", "total_orders",
        "avg_order_value",
        round2(avg).cast(MONEY_TOTAL).alias("avg_store_revenue"),
        round2(F.col("total_revenue") - avg).cast(MONEY_TOTAL).alias("deviation_from_avg"),
        _bigint(F.rank().over(best)).alias("store_rank"),
    ).orderBy("store_rank", "store_name")


# ---------------------------------------------------------------------------
# Q06 product profit margin with two ranks
# ---------------------------------------------------------------------------

def q06_product_margin(star: Star, buckets: int | None = None) -> DataFrame:
    p = scd_current(star.dim_product).select("product_key", "product_name", "category", "brand")
    per_product = star.fact_sales.groupBy("product_key").agg(  # eager aggregation
        F.sum("quantity").alias("units"),
        F.sum("net_revenue").alias("rev"),
        F.sum("gross_profit").alias("profit"),
        F.sum("discount_amount").alias("disc"),
    )
    pm = (
        per_product.join(p, "product_key")
        .groupBy("product_name", "category", "brand")
        .agg(
            _bigint(F.sum("units")).alias("units_sold"),
            F.sum("rev").alias("__rev"),
            F.sum("profit").alias("__profit"),
            F.sum("disc").alias("__disc"),
        )
        .select(
            "product_name", "category", "brand", "units_sold",
            rounded_money("__rev").alias("total_revenue"),
            rounded_money("__profit").alias("total_profit"),
            rounded_money("__disc").alias("total_discount"),
            pct(money("__profit"), money("__rev"), guard_zero=True).alias("profit_margin_pct"),
        )
    )
    pm = R.scores(pm, ["product_name", "category", "brand"], [
        R.Score("margin_rank", R.desc("profit_margin_pct")), R.Score("revenue_rank", R.desc("total_revenue"))], buckets)
    return pm.orderBy("revenue_rank", "margin_rank", "product_name", "category", "brand")


# ---------------------------------------------------------------------------
# Q07 weekly revenue with 4-week moving average
# ---------------------------------------------------------------------------

def q07_weekly_moving_avg(star: Star) -> DataFrame:
    f = star.fact_sales.select("date_key", _order(star.fact_sales), "net_revenue")
    ws = _with_orders(
        f.join(_dates(star, "year_number", "week_of_year", "full_date"), "date_key"),
        ["year_number", "week_of_year"], "weekly_orders", {"rev": "net_revenue"}, {"week_start": "full_date"},
    ).select("year_number", "week_of_year", "week_start", rounded_money("rev").alias("weekly_revenue"), "weekly_orders")
    return moving_average(ws)


def moving_average(weeks: DataFrame) -> DataFrame:
    """The mean over four weeks and the year's running total, of one row a week."""
    last4 = Window.orderBy("year_number", "week_of_year").rowsBetween(-3, 0)  # bounded: weeks
    ytd = Window.partitionBy("year_number").orderBy("week_of_year")
    return (
        weeks.select(
            "week_start", "weekly_revenue", "weekly_orders",
            rounded_mean(F.sum("weekly_revenue").over(last4), F.count("weekly_revenue").over(last4))
            .alias("moving_avg_4week"),
            rounded_money(F.sum("weekly_revenue").over(ytd)).alias("ytd_revenue"),
        )
        .orderBy("week_start")
    )


# ---------------------------------------------------------------------------
# Q08 segment revenue contribution
# ---------------------------------------------------------------------------

def q08_segment_share(star: Star) -> DataFrame:
    c = scd_current(star.dim_customer).select("customer_key", "customer_segment")
    # Eager aggregation per customer version: COUNT(DISTINCT customer_key) becomes a row
    # count and COUNT(DISTINCT order_id) a sum (an order has one customer), so the segment
    # step needs no distinct aggregation and the customer join is customer-sized.
    per_customer = star.fact_sales.groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("net_revenue").alias("revenue"),
        F.count("net_revenue").alias("lines"),
        F.sum("gross_profit").alias("profit"),
    )
    sm = (
        per_customer.join(c, "customer_key")
        .groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            _bigint(F.sum("orders")).alias("total_orders"),
            rounded_money(F.sum("revenue")).alias("total_revenue"),
            rounded_mean(F.sum("revenue"), F.sum("lines")).alias("avg_order_value"),
            rounded_money(F.sum("profit")).alias("total_profit"),
        )
    )
    every = Window.partitionBy()  # one row per segment: bounded
    return (
        sm.select(
            "*",
            pct("total_revenue", F.sum("total_revenue").over(every), guard_zero=False)
            .alias("revenue_contribution_pct"),
            pct("total_profit", F.sum("total_profit").over(every), guard_zero=False)
            .alias("profit_contribution_pct"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "customer_segment")
    )


# ---------------------------------------------------------------------------
# Q09 promotion effectiveness
# ---------------------------------------------------------------------------

def q09_promo_effect(star: Star) -> DataFrame:
    f = star.fact_sales.select(
        "promotion_key", _order(star.fact_sales), "quantity", "discount_amount", "net_revenue", "gross_profit"
    )
    pr = star.dim_promotion.select("promotion_key", "promo_name", "promo_type")
    pm = _with_orders(
        f.join(pr, "promotion_key", "left"), ["promo_name", "promo_type"], "total_orders",
        {"units": "quantity", "disc": "discount_amount", "rev": "net_revenue", "profit": "gross_profit"},
    ).select(
        "promo_name", "promo_type", "total_orders", _bigint("units").alias("units_sold"),
        rounded_money("disc").alias("total_discount_given"), rounded_money("rev").alias("total_revenue"),
        rounded_money("profit").alias("total_profit"), rounded_mean("disc", "disc_n").alias("avg_discount_per_order"),
    )
    every = Window.partitionBy()  # one row per promotion: bounded
    return (
        pm.select(
            F.coalesce("promo_name", F.lit("No Promotion")).alias("promotion"),
            F.coalesce("promo_type", F.lit("N/A")).alias("promo_type"),
            "total_orders", "units_sold", "total_discount_given", "total_revenue",
            "total_profit", "avg_discount_per_order",
            pct("total_revenue", F.sum("total_revenue").over(every), guard_zero=False)
            .alias("revenue_share_pct"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "promotion")
    )


# ---------------------------------------------------------------------------
# Q10 category quarterly growth
# ---------------------------------------------------------------------------

def q10_quarterly_growth(star: Star) -> DataFrame:
    f = star.fact_sales.select("date_key", "product_key", "net_revenue", "quantity")
    p = scd_current(star.dim_product).select("product_key", "category")
    qc = (
        f.join(_dates(star, "year_number", "quarter_number", "quarter_name"), "date_key")
        .join(p, "product_key")
        .groupBy("year_number", "quarter_number", "quarter_name", "category")
        .agg(
            rounded_money(F.sum("net_revenue")).alias("quarterly_revenue"),
            _bigint(F.sum("quantity")).alias("units_sold"),
        )
    )
    w = Window.partitionBy("category").orderBy("year_number", "quarter_number")
    prev = F.lag("quarterly_revenue").over(w)
    out = qc.select(
        "year_number", "quarter_number", "quarter_name", "category", "quarterly_revenue",
        "units_sold", prev.alias("prev_quarter_revenue"),
        growth_pct(F.col("quarterly_revenue"), prev).alias("qoq_growth_pct"),
    )
    return out.orderBy("year_number", "quarter_number", F.col("category").asc_nulls_last()).drop("quarter_number")


# ---------------------------------------------------------------------------
# Q11 RFM scoring
# ---------------------------------------------------------------------------

def q11_rfm(star: Star, as_of: date | str, buckets: int | None = None) -> DataFrame:
    """Recency / frequency / monetary terciles (1 = best). ``as_of`` replaces CURRENT_DATE.
    Ties inside each score are broken by (customer_name, customer_segment), the group key,
    so the tiles are deterministic."""
    c = scd_current(star.dim_customer).select("customer_key", "customer_name", "customer_segment")
    per_customer = star.fact_sales.groupBy("customer_key").agg(  # eager aggregation
        F.count_distinct("order_id").alias("orders"),
        F.sum("net_revenue").alias("revenue"),
        F.max("date_key").alias("last_date_key"),
    )
    grouped = (
        per_customer.join(c, "customer_key")
        .groupBy("customer_name", "customer_segment")
        .agg(
            _bigint(F.sum("orders")).alias("frequency"),
            rounded_money(F.sum("revenue")).alias("monetary"),
            F.max("last_date_key").alias("date_key"),
        )
    )
    base = (
        grouped.join(_dates(star, "full_date"), "date_key")
        .select(
            "customer_name", "customer_segment", "frequency", "monetary",
            F.col("full_date").alias("last_purchase_date"),
            D.days_between(F.lit(as_of).cast("date"), F.col("full_date"))
            .alias("days_since_last_purchase"),
        )
    )
    out = R.scores(base, ["customer_name", "customer_segment"], [
        R.Score("recency_score", R.asc("days_since_last_purchase"), 3), R.Score("frequency_score", R.desc("frequency"), 3),
        R.Score("monetary_score", R.desc("monetary"), 3)], buckets)
    return out.orderBy(F.col("monetary").desc_nulls_first(), "customer_name", "customer_segment")


QUERIES = {
    "q01_monthly_trend": q01_monthly_trend,
    "q02_category_rank_by_region": q02_category_rank_by_region,
    "q03_cohort": q03_cohort,
    "q04_top_customers": q04_top_customers,
    "q05_store_vs_avg": q05_store_vs_avg,
    "q06_product_margin": q06_product_margin,
    "q07_weekly_moving_avg": q07_weekly_moving_avg,
    "q08_segment_share": q08_segment_share,
    "q09_promo_effect": q09_promo_effect,
    "q10_quarterly_growth": q10_quarterly_growth,
    "q11_rfm": q11_rfm,
}
