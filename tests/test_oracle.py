"""Every registered query equals its DuckDB oracle on the smallest driver tables, and the
driver contract (entry / queries / oracle_sql) holds."""

from __future__ import annotations

import pytest

from given import SF_SMALL


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["region", "category", "total_revenue", "category_rank"]
    from starloom.plans.registry import QUERIES

    qs, sql = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(sql) <= set(qs)


@pytest.mark.parametrize("name", sorted(__import__("starloom.plans.oracle", fromlist=["SQL"]).SQL))
def test_matches_duckdb(spark, name):
    from oracle_compare import compare

    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res["status"] == "match", res


def test_violation_report_is_clean(spark):
    import __spark_entry__ as E

    rows = E.queries()["dq_violations"](spark, SF_SMALL).collect()
    assert rows and all(r.violations == 0 for r in rows), [r for r in rows if r.violations]


def test_recorded_star_is_reused_by_a_new_application(spark):
    """A later application (simulated by forgetting the in-process memo) reads the recorded
    star instead of rebuilding it, and its queries still match the oracle."""
    from oracle_compare import compare

    from starloom.plans import registry

    first = registry.warehouse_for(spark, SF_SMALL)
    registry._BUILT.clear()
    again = registry.warehouse_for(spark, SF_SMALL)
    assert again.root == first.root and again is not first
    plan = again.star.fact_sales.groupBy("order_id").count()._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()  # the re-registered fact is still bucketed
    for name in ["q04_top_customers", "stage_order_items", "scd2_customer_refresh"]:
        assert compare(spark, SF_SMALL, [name], verbose=False)[name]["status"] == "match"
