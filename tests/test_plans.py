"""Physical-plan properties that must survive refactoring: column pruning on the fact scan,
and no global sort of customer/product-sized data on the distributed path."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from given import SF_SMALL
from starloom.operators import analytics as A
from starloom.operators import ranking as R
from starloom.plans.registry import CONFIG, warehouse_for

FACT_COLUMNS = {
    "q01_monthly_trend": {"date_key", "net_revenue"},
    "q02_category_rank_by_region": {"product_key", "store_key", "net_revenue"},
    "q03_cohort": {"customer_key", "date_key", "net_revenue"},
    "q04_top_customers": {"customer_key", "order_id", "quantity", "net_revenue"},
    "q05_store_vs_avg": {"store_key", "order_id", "net_revenue"},
    "q06_product_margin": {"product_key", "quantity", "net_revenue", "gross_profit", "discount_amount"},
    "q07_weekly_moving_avg": {"date_key", "order_id", "net_revenue"},
    "q08_segment_share": {"customer_key", "order_id", "net_revenue", "gross_profit"},
    "q09_promo_effect": {"promotion_key", "order_id", "quantity", "discount_amount", "net_revenue",
                         "gross_profit"},
    "q10_quarterly_growth": {"date_key", "product_key", "net_revenue", "quantity"},
    "q11_rfm": {"customer_key", "date_key", "order_id", "net_revenue"},
}


def _run(star, name, **kw):
    fn = A.QUERIES[name]
    return fn(star, CONFIG.as_of, **kw) if name == "q11_rfm" else fn(star, **kw)


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def star(spark):
    return warehouse_for(spark, SF_SMALL).star


@pytest.mark.parametrize("name", sorted(FACT_COLUMNS))
def test_fact_scan_reads_only_needed_columns(star, name, monkeypatch):
    monkeypatch.setattr(R, "pin", lambda df: df)  # the plan up to the fact, not from a pinned table on
    plan = _formatted(_run(star, name))
    blocks = [b for b in plan.split("\n\n") if "fact_sales]" in b and "ReadSchema" in b]
    assert blocks, plan
    read = set()
    for b in blocks:  # without the pin, an input that is read twice shows as two scans
        schema = re.search(r"ReadSchema: struct<(.*)>", b).group(1)
        read |= {c.split(":")[0] for c in re.split(r",(?![^()]*\))", schema)}
    assert read == FACT_COLUMNS[name], (name, read)


@pytest.mark.parametrize("name", ["q04_top_customers", "q06_product_margin", "q11_rfm"])
def test_ranks_have_no_global_sort_of_groups(star, name):
    from test_ranking import _global_windows

    df = _run(star, name, buckets=4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    orders = _global_windows(plan)
    assert all("__bucket" in o for o in orders), orders


def test_cohort_aggregate_keeps_its_own_stage(star):
    """The final sort does not pull the cohort aggregate into one task."""
    plan = A.q03_cohort(star)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "rangepartitioning" in plan


def test_sales_sanity_does_not_expand_the_fact(star):
    from starloom.operators.quality import dq_sales_sanity

    assert "Expand" not in dq_sales_sanity(star.fact_sales)._jdf.queryExecution().executedPlan().toString()


def test_fact_scan_tasks_grow_with_the_lines(spark):
    """The bucket count follows the number of order lines."""
    from starloom.plans.warehouse import with_buckets

    lines = spark.range(120_000)
    assert with_buckets(CONFIG, lines).order_buckets == 3
    assert with_buckets(CONFIG, lines.union(lines)).order_buckets == 5
    assert with_buckets(CONFIG, lines.limit(0)).order_buckets == 1
