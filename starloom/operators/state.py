"""Partial sums of the sales fact that later loads add to: a load aggregates its own new lines, and
the queries add up the loads' sums instead of the fact's rows.

* ``day``: (date_key, net_revenue) for the monthly trend;
* ``week``: (year_number, week_of_year, week_start, net_revenue, orders) for the weekly average;
* ``day_product``: (date_key, product_key, net_revenue, quantity) for quarterly growth.

Sums of exact decimals, and minima, merge by adding and comparing. Distinct orders do not, so a load
counts an order for a week only if the fact has no line of it in that week yet; then the loads'
counts add up to the distinct count, also where an order got late lines or another date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.analytics import Star, moving_average, q01_monthly_trend, q10_quarterly_growth
from starloom.operators.ranking import pin

NAMES = ("day", "week", "day_product")


def of_load(fresh: DataFrame, dim_date: DataFrame, known: DataFrame | None) -> dict[str, DataFrame]:
    """The partial sums of a load's new lines. ``known``: the stored lines of their orders. The weeks'
    revenue is added up from the days', which are few: the lines are read for their orders only."""
    revenue = F.sum("net_revenue").alias("net_revenue")
    weeks = dim_date.select("date_key", "year_number", "week_of_year", "full_date")
    week = ["year_number", "week_of_year"]
    day = pin(fresh.groupBy("date_key").agg(revenue))
    by_week = day.join(weeks, "date_key").groupBy(*week).agg(
        F.min("full_date").alias("week_start"), F.sum("net_revenue").cast(day.schema["net_revenue"].dataType).alias("net_revenue"))
    orders = fresh.select("order_id", "date_key").join(weeks, "date_key").select(*week, "order_id").distinct()
    if known is not None:
        counted = known.select("order_id", "date_key").join(weeks, "date_key").select(*week, "order_id").distinct()
        orders = orders.join(counted, [*week, "order_id"], "left_anti")
    new = orders.groupBy(*week).agg(F.count(F.lit(1)).alias("orders"))
    return {
        "day": day,
        "week": by_week.join(new, week, "left").select(
            *week, "week_start", "net_revenue", F.coalesce("orders", F.lit(0)).cast("long").alias("orders")),
        "day_product": fresh.groupBy("date_key", "product_key").agg(revenue, F.sum("quantity").alias("quantity")),
    }


def q01_from_state(day: DataFrame, star: Star) -> DataFrame:
    """The monthly trend from the sums of all loads."""
    return q01_monthly_trend(_with_sums(star, day))


def q07_from_state(week: DataFrame) -> DataFrame:
    """The weekly moving average from the sums of all loads."""
    return moving_average(week.groupBy("year_number", "week_of_year").agg(
        F.min("week_start").alias("week_start"), F.sum("net_revenue").cast("decimal(22,2)").alias("weekly_revenue"),
        F.sum("orders").alias("weekly_orders")))


def q10_from_state(day_product: DataFrame, star: Star) -> DataFrame:
    """Quarterly growth by category (of current product versions) from the sums of all loads."""
    return q10_quarterly_growth(_with_sums(star, day_product))


def _with_sums(star: Star, sums: DataFrame) -> Star:
    return Star(fact_sales=sums, dim_date=star.dim_date, dim_customer=star.dim_customer, dim_product=star.dim_product,
                dim_store=star.dim_store, dim_promotion=star.dim_promotion)
