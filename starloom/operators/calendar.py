"""Generated calendar: ``calendar_gen`` (a day series) and the ``dim_date`` dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import WAREHOUSE
from starloom.functions import dates as D
from starloom.sources.tables import conform

# Reference defaults: 2020-01-01 .. 2030-12-31 (4,018 days), fiscal year starting in July.
DEFAULT_START = date(2020, 1, 1)
DEFAULT_END = date(2030, 12, 31)
FISCAL_START_MONTH = 7


def calendar_gen(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (column ``full_date``).

    The series is expanded from a single generated row; a calendar is bounded by its date
    range (about 366 rows a year), so it is always a small table.
    """
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
        ).alias("full_date")
    )


def dim_date_from(days: DataFrame, pad_names: bool = True) -> DataFrame:
    d = F.col("full_date")
    q = F.quarter(d)
    out = days.select(
        D.date_key(d).alias("date_key"),
        d.alias("full_date"),
        D.iso_day_of_week(d).cast("short").alias("day_of_week"),
        D.day_name(d, pad_names).alias("day_name"),
        F.dayofmonth(d).cast("short").alias("day_of_month"),
        F.dayofyear(d).cast("short").alias("day_of_year"),
        D.iso_week(d).cast("short").alias("week_of_year"),
        F.month(d).cast("short").alias("month_number"),
        D.month_name(d, pad_names).alias("month_name"),
        q.cast("short").alias("quarter_number"),
        F.concat(F.lit("Q"), q.cast("string")).alias("quarter_name"),
        F.year(d).cast("short").alias("year_number"),
        D.fiscal_year(d, FISCAL_START_MONTH).cast("short").alias("fiscal_year"),
        D.fiscal_quarter(d, FISCAL_START_MONTH).cast("short").alias("fiscal_quarter"),
        D.iso_day_of_week(d).isin(6, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
    )
    return conform(out, WAREHOUSE["dim_date"])


def dim_date(
    spark: SparkSession,
    start: date | str = DEFAULT_START,
    end: date | str = DEFAULT_END,
    pad_names: bool = True,
) -> DataFrame:
    """The 17-column calendar dimension between two dates (inclusive)."""
    return dim_date_from(calendar_gen(spark, start, end), pad_names)


def year_range_of(df: DataFrame, date_col: str) -> tuple[date, date]:
    """Whole calendar years spanning a date column: (Jan 1 of min year, Dec 31 of max year).

    One aggregate row comes back to the driver.
    """
    row = df.agg(F.min(F.year(date_col)).alias("lo"), F.max(F.year(date_col)).alias("hi")).first()
    if row is None or row["lo"] is None:
        return DEFAULT_START, DEFAULT_END
    return date(int(row["lo"]), 1, 1), date(int(row["hi"]), 12, 31)
