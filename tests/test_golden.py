"""Golden values on the reference sample rows (FIXTURES.md section 2)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest

from starloom.operators import analytics as A
from starloom.operators import quality
from starloom.plans.warehouse import LoadConfig, build_star, stage_mirror
from starloom.session import scratch_path
from starloom.sources.seed import seed_tables

AS_OF = date(2024, 4, 1)


@pytest.fixture(scope="module")
def star(spark):
    root = scratch_path(spark, "golden")
    staging = stage_mirror(seed_tables(spark), root)
    cfg = LoadConfig(as_of=AS_OF, calendar_start=date(2020, 1, 1), calendar_end=date(2030, 12, 31))
    return build_star(spark, staging, cfg, root)


def test_load_counts(star):
    assert star.dim_date.count() == 4018
    assert star.dim_store.count() == 5
    assert star.dim_customer.count() == 10
    assert star.dim_product.count() == 10
    assert star.dim_promotion.count() == 5
    assert star.fact_sales.count() == 25
    assert star.fact_inventory_snapshot.count() == 11


def test_sales_sanity(star):
    r = quality.dq_sales_sanity(star.fact_sales).first()
    assert (r.total_rows, r.distinct_orders, r.distinct_customers, r.distinct_products,
            r.distinct_stores) == (25, 15, 10, 10, 5)
    assert r.total_revenue == D("2167.24")
    assert r.total_profit == D("1160.24")
    f = star.fact_sales.agg({"tax_amount": "sum", "discount_amount": "sum"}).first()
    assert f["sum(tax_amount)"] == D("173.40")
    assert f["sum(discount_amount)"] == D("187.50")


def test_discounted_lines(star):
    from pyspark.sql import functions as F
    rows = (star.fact_sales.where(F.col("discount_amount") > 0)
            .select("order_id", "order_line_num", "discount_amount", "net_revenue",
                    "gross_profit", "tax_amount").collect())
    got = sorted((r.order_id, r.order_line_num, r.discount_amount, r.net_revenue,
                  r.gross_profit, r.tax_amount) for r in rows)
    assert got == [
        ("ORD004", 2, D("30.00"), D("169.99"), D("84.99"), D("13.60")),
        ("ORD009", 3, D("50.00"), D("149.99"), D("64.99"), D("12.00")),
        ("ORD011", 1, D("25.00"), D("74.99"), D("29.99"), D("6.00")),
        ("ORD011", 2, D("32.50"), D("97.49"), D("42.49"), D("7.80")),
        ("ORD011", 3, D("50.00"), D("149.99"), D("64.99"), D("12.00")),
    ]


def test_segments_all_bronze(star):
    segs = {r.customer_segment for r in star.dim_customer.select("customer_segment").collect()}
    assert segs == {"Bronze"}


def test_q01(star):
    rows = A.q01_monthly_trend(star).collect()
    assert len(rows) == 15
    assert rows[0].month_name == "January  "
    assert (rows[0].monthly_revenue, rows[0].prev_month_revenue, rows[0].mom_growth_pct) == (
        D("149.98"), None, None)
    assert (rows[1].ytd_revenue, rows[1].mom_growth_pct) == (D("229.97"), D("-46.67"))
    assert rows[3].mom_growth_pct == D("233.39")
    assert rows[11].ytd_revenue == D("1917.29")
    assert (rows[12].year_number, rows[12].ytd_revenue, rows[12].mom_growth_pct) == (
        2024, D("79.99"), D("-42.86"))
    assert rows[14].mom_growth_pct == D("-45.46")


def test_q02(star):
    rows = A.q02_category_rank_by_region(star).collect()
    got = [(r.region, r.category, r.total_revenue, r.category_rank) for r in rows]
    assert got[:3] == [("Midwest", "Footwear", D("79.99"), 1), ("Midwest", "Appliances", D("59.99"), 2),
                       ("Midwest", "Sports", D("29.99"), 3)]
    south = [g for g in got if g[0] == "South"]
    assert [g[1] for g in south] == ["Electronics", "Clothing", "Appliances", "Footwear", "Accessories"]
    assert south[0][2] == D("419.97")
    west = [g for g in got if g[0] == "West"]
    assert [(g[1], g[2]) for g in west] == [
        ("Electronics", D("249.98")), ("Footwear", D("159.98")), ("Sports", D("89.97")),
        ("Accessories", D("59.99")), ("Home", D("34.99"))]


def test_q03(star):
    rows = A.q03_cohort(star).collect()
    assert all(r.active_customers == 1 for r in rows)
    m = {(r.cohort_month, r.months_since_first): r.cohort_revenue for r in rows}
    assert m[(date(2023, 1, 1), 0)] == D("149.98")
    assert m[(date(2023, 1, 1), 10)] == D("322.47")
    assert m[(date(2023, 5, 1), 10)] == D("59.98")


def test_q04(star):
    rows = A.q04_top_customers(star).collect()
    got = [(r.revenue_rank, r.customer_name, r.total_orders, r.total_items, r.total_revenue,
            r.avg_order_value) for r in rows]
    assert got[0] == (1, "Alice Johnson", 2, 5, D("472.45"), D("94.49"))
    assert got[2] == (3, "Iris Taylor", 1, 3, D("379.97"), D("126.66"))
    # 89.97 / 2 = 44.985 rounds half away from zero
    assert got[7] == (8, "Emma Davis", 2, 3, D("89.97"), D("44.99"))


def test_q05(star):
    rows = A.q05_store_vs_avg(star).collect()
    assert rows[0].avg_store_revenue == D("433.45")
    got = [(r.store_rank, r.total_revenue, r.total_orders, r.avg_order_value, r.deviation_from_avg)
           for r in rows]
    assert got == [
        (1, D("929.91"), 4, D("103.32"), D("496.46")),
        (2, D("472.45"), 2, D("94.49"), D("39.00")),
        (3, D("304.95"), 4, D("60.99"), D("-128.50")),
        (4, D("289.96"), 3, D("96.65"), D("-143.49")),
        (5, D("169.97"), 2, D("56.66"), D("-263.48")),
    ]


def test_q06(star):
    rows = A.q06_product_margin(star).collect()
    got = {r.product_name: (r.revenue_rank, r.margin_rank, r.units_sold, r.total_revenue,
                            r.total_profit, r.total_discount, r.profit_margin_pct) for r in rows}
    assert got["Smart Watch"] == (1, 10, 4, D("669.96"), D("329.96"), D("130.00"), D("49.25"))
    assert got["Backpack"][:2] == (5, 3)
    assert got["Coffee Maker"][:2] == (5, 8)
    assert got["Yoga Mat"][:2] == (7, 2)
    assert got["Laptop Stand"] == (8, 1, 2, D("99.98"), D("63.98"), D("0.00"), D("63.99"))


def test_q07(star):
    rows = A.q07_weekly_moving_avg(star).collect()
    got = [(r.week_start, r.weekly_revenue, r.moving_avg_4week, r.ytd_revenue) for r in rows]
    assert got[0] == (date(2023, 1, 15), D("149.98"), D("149.98"), D("149.98"))
    assert got[2] == (date(2023, 3, 10), D("89.98"), D("106.65"), D("319.95"))
    assert got[10] == (date(2023, 11, 24), D("322.47"), D("196.86"), D("1777.31"))
    assert got[14] == (date(2024, 3, 20), D("59.98"), D("97.48"), D("249.95"))


def test_q08(star):
    (r,) = A.q08_segment_share(star).collect()
    assert (r.customer_segment, r.customer_count, r.total_orders, r.total_revenue,
            r.avg_order_value, r.total_profit, r.revenue_contribution_pct,
            r.profit_contribution_pct) == (
        "Bronze", 10, 15, D("2167.24"), D("86.69"), D("1160.24"), D("100.00"), D("100.00"))


def test_q09(star):
    rows = A.q09_promo_effect(star).collect()
    got = [(r.promotion, r.total_orders, r.units_sold, r.total_discount_given, r.total_revenue,
            r.total_profit, r.avg_discount_per_order, r.revenue_share_pct) for r in rows]
    assert got == [
        ("No Promotion", 14, 21, D("0.00"), D("1524.79"), D("872.79"), D("0.00"), D("70.36")),
        ("Summer Sale", 3, 5, D("187.50"), D("642.45"), D("287.45"), D("37.50"), D("29.64")),
    ]


def test_q10(star):
    rows = A.q10_quarterly_growth(star).collect()
    e = [(r.year_number, r.quarter_name, r.quarterly_revenue, r.units_sold, r.qoq_growth_pct)
         for r in rows if r.category == "Electronics"]
    assert e == [
        (2023, "Q1", D("149.98"), 2, None),
        (2023, "Q2", D("369.98"), 2, D("146.69")),
        (2023, "Q3", D("299.97"), 3, D("-18.92")),
        (2023, "Q4", D("224.98"), 2, D("-25.00")),
    ]
    a = [(r.year_number, r.quarter_name, r.qoq_growth_pct) for r in rows if r.category == "Appliances"]
    assert a == [(2023, "Q1", None), (2024, "Q1", D("83.33"))]


def test_q11(star):
    rows = A.q11_rfm(star, AS_OF).collect()
    got = {r.customer_name: (r.frequency, r.monetary, r.last_purchase_date,
                             r.days_since_last_purchase, r.recency_score, r.frequency_score,
                             r.monetary_score) for r in rows}
    assert got["Alice Johnson"] == (2, D("472.45"), date(2023, 11, 24), 129, 2, 1, 1)
    assert got["David Brown"] == (2, D("409.96"), date(2024, 2, 14), 47, 1, 1, 1)
    assert got["Iris Taylor"] == (1, D("379.97"), date(2023, 9, 25), 189, 2, 3, 1)
    assert got["Frank Miller"][4:] == (3, 2, 2)
    assert got["Emma Davis"][3:] == (12, 1, 2, 3)
    assert got["Jack Anderson"][3:] == (153, 2, 3, 3)


def test_inventory_listing(star):
    rows = quality.dq_inventory_listing(
        star.fact_inventory_snapshot, star.dim_product, star.dim_store).collect()
    assert len(rows) == 11
    assert rows[0].store_name == "Chicago Downtown"
    assert all(r.snapshot_date == AS_OF for r in rows)


def test_ranks_do_not_depend_on_the_number_of_range_buckets(star):
    """q04, q06 and q11 over one, three and seven range buckets."""
    for f in (A.q04_top_customers, A.q06_product_margin, lambda s, buckets: A.q11_rfm(s, AS_OF, buckets)):
        one, *more = (sorted(map(tuple, f(star, buckets=n).collect()), key=repr) for n in (1, 3, 7))
        assert all(m == one for m in more)


def test_expired_versions_leave_current_filtered_queries(spark, star):
    """SURVEY D7: after a refresh that re-versions a customer, facts bound to the old version
    drop out of Q04/Q08/Q11 (current filter) but stay in Q01."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from starloom.operators import dims

    t = seed_tables(spark)
    moved = t["customers"].withColumn(
        "city", F.when(F.col("customer_id") == "CUS001", F.lit("Boston")).otherwise(F.col("city")))
    dc2 = dims.dim_customer(star.dim_customer, moved, t["orders"], date(2024, 5, 1)).checkpoint()
    star2 = replace(star, dim_customer=dc2)
    assert dc2.count() == 11 and dc2.where("is_current").count() == 10
    q04 = {r.customer_name: r for r in A.q04_top_customers(star2).collect()}
    assert "Alice Johnson" not in q04            # her facts point at the expired version
    assert len(q04) == 9
    (q08,) = A.q08_segment_share(star2).collect()
    assert q08.total_revenue == D("2167.24") - D("472.45")
    assert sum(r.monthly_revenue for r in A.q01_monthly_trend(star2).collect()) == D("2167.24")


def test_null_ordering_follows_reference_engine(spark):
    """SURVEY 1.4.6: a NULL region sorts last in Q02 (ASC NULLS LAST), and a product with zero
    revenue has a NULL margin that ranks first in Q06 (DESC NULLS FIRST)."""
    from pyspark.sql import functions as F

    t = seed_tables(spark)
    t["stores"] = t["stores"].withColumn(
        "region", F.when(F.col("store_id") == "STR003", F.lit(None)).otherwise(F.col("region")))
    t["order_items"] = t["order_items"].withColumn(
        "unit_price", F.when(F.col("item_id") == "ITM016", F.lit(0).cast("decimal(10,2)"))
        .otherwise(F.col("unit_price")))
    root = scratch_path(spark, "nulls")
    cfg = LoadConfig(as_of=AS_OF)
    s = build_star(spark, stage_mirror(t, root), cfg, root)
    q02 = A.q02_category_rank_by_region(s).collect()
    assert q02[-1].region is None and q02[0].region is not None
    q06 = {r.product_name: r for r in A.q06_product_margin(s).collect()}
    lamp = q06["Desk Lamp"]  # its only line now has zero revenue
    assert lamp.profit_margin_pct is None and lamp.margin_rank == 1
