"""Distinct counts by bitmap over dense order numbers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from given import SF_SMALL
from starloom.functions import bitmaps as B
from starloom.operators import analytics as A
from starloom.operators import facts
from starloom.plans.registry import numbered_star, warehouse_for

QUERIES = [A.q05_store_vs_avg, A.q07_weekly_moving_avg, A.q09_promo_effect]


def test_bitmaps_count_and_merge(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 70_001 + 1).alias("n")).union(
        spark.createDataFrame([(0, None), (9, None)], "g long, n long"))
    parts = B.bitmaps(df, ["g"], "n", F.count("*").alias("rows"))
    got = {r.g: (r.d, r.rows) for r in parts.groupBy("g").agg(B.n_set().alias("d"), F.sum("rows").alias("rows")).collect()}
    assert got == {r.g: (r.d, r.rows) for r in df.groupBy("g").agg(F.count_distinct("n").alias("d"), F.count("*").alias("rows")).collect()}
    assert got[9] == (0, 1)
    # two loads that share numbers, stored apart and merged
    loads = [B.bitmaps(df.where(c), ["g"], "n") for c in ("n < 50000", "n > 20000")]
    whole = B.merged(loads[0].union(loads[1]), ["g"]).groupBy("g").agg(B.n_set().alias("d"))
    assert {r.g: r.d for r in whole.collect()} == {k: v[0] for k, v in got.items() if k != 9}


@pytest.mark.parametrize("query", QUERIES, ids=lambda q: q.__name__)
def test_same_results_without_an_exchange_on_orders(spark, query):
    star, plain = numbered_star(spark, SF_SMALL), warehouse_for(spark, SF_SMALL).star
    got = query(star)
    assert list(map(tuple, got.collect())) == list(map(tuple, query(plain).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" not in plan and "order_id" not in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("order_no" in line for line in shuffles)


def test_order_numbers_go_on_over_loads(spark):
    orders = spark.createDataFrame([("b",), ("a",), ("c",)], "order_id string")
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "order_id string, v int")
    out, numbers = facts.number_orders(fact, orders)
    assert sorted(map(tuple, numbers.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted(map(tuple, out.collect())) == [("a", 1, 1), ("a", 2, 1), ("c", 3, 3)]
    later = spark.createDataFrame([("aa",), ("c",)], "order_id string")
    _, more = facts.number_orders(fact, later, numbers)
    assert sorted(map(tuple, more.collect())) == [("a", 1), ("aa", 4), ("b", 2), ("c", 3)]
