"""Calendar, money and measure rules (FIXTURES F6, F7, SURVEY 1.4)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from starloom.functions import money
from starloom.operators import calendar, facts


def test_dim_date_edge_days(spark):
    d = calendar.dim_date(spark, date(2022, 12, 25), date(2025, 1, 5))
    rows = {r.full_date: r for r in d.collect()}
    assert rows[date(2023, 1, 1)].week_of_year == 52
    assert rows[date(2024, 12, 30)].week_of_year == 1
    leap = rows[date(2024, 2, 29)]
    assert (leap.date_key, leap.day_of_year, leap.quarter_name) == (20240229, 60, "Q1")
    jun, jul = rows[date(2024, 6, 30)], rows[date(2024, 7, 1)]
    assert (jun.fiscal_year, jun.fiscal_quarter) == (2024, 4)
    assert (jul.fiscal_year, jul.fiscal_quarter) == (2025, 1)
    assert rows[date(2024, 10, 1)].fiscal_quarter == 2
    assert rows[date(2024, 1, 15)].fiscal_quarter == 3
    sun = rows[date(2023, 1, 1)]
    assert (sun.day_of_week, sun.is_weekend, sun.day_name) == (7, True, "Sunday   ")
    assert rows[date(2024, 9, 4)].month_name == "September"
    assert rows[date(2024, 9, 4)].day_name == "Wednesday"
    assert len(rows) == (date(2025, 1, 5) - date(2022, 12, 25)).days + 1


def test_reference_calendar_size(spark):
    assert calendar.dim_date(spark).count() == 4018


def test_mean_is_sum_over_count_not_avg(spark):
    # 1,999,999 rows summing to 9999.99: exact mean 0.004999995 -> 0.00
    n = 1_999_999
    df = spark.range(n).select(
        F.when(F.col("id") == 0, F.lit("9999.99")).otherwise(F.lit("0")).cast("decimal(12,2)").alias("v"))
    r = df.agg(money.rounded_mean(F.sum("v"), F.count("v")).alias("m"),
               F.round(F.avg("v"), 2).alias("avg_then_round")).first()
    assert r.m == D("0.00")
    assert r.avg_then_round == D("0.01")  # why avg() is not used


def test_half_away_from_zero(spark):
    df = spark.createDataFrame([(D("2.345"),), (D("-2.345"),)], "x decimal(10,3)")
    assert [r[0] for r in df.select(money.round2("x")).collect()] == [D("2.35"), D("-2.35")]


def test_line_measures(spark):
    df = spark.createDataFrame([(D("199.99"), 1, D("15.00"), D("85.00"))],
                               "p decimal(10,2), q int, pct decimal(5,2), c decimal(10,2)")
    p, q, pct, c = F.col("p"), F.col("q"), F.col("pct"), F.col("c")
    r = df.select(
        facts.measure_discount(p, q, pct).alias("d"),
        facts.measure_net_revenue(p, q, pct).alias("n"),
        facts.measure_gross_profit(p, q, pct, c).alias("g"),
        facts.measure_tax(p, q, pct).alias("t"),
    ).first()
    assert (r.d, r.n, r.g, r.t) == (D("30.00"), D("169.99"), D("84.99"), D("13.60"))


def test_pct_zero_denominator(spark):
    df = spark.createDataFrame([(D("1.00"), D("0.00"))], "a decimal(22,2), b decimal(22,2)")
    assert df.select(money.pct("a", "b")).first()[0] is None
    import pytest
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(money.pct("a", "b", guard_zero=False)).collect()
