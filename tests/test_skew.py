"""Hot groups: per-order numbering and the fact build stay exact when one order holds a
third of all lines (the hot path is forced with a tiny threshold)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import skew


def _lines(spark):
    rows = [(f"O{i % 40}", f"I{i:05d}", i % 7) for i in range(900)]
    rows += [("HOT", f"I{i:05d}", i % 5) for i in range(450)]  # a third of all rows
    return spark.createDataFrame(rows, "order_id string, item_id string, v int")


def test_row_number_within_matches_window(spark, monkeypatch):
    df = _lines(spark)
    monkeypatch.setattr(skew, "HOT_GROUP_ROWS", 100)
    assert [r.order_id for r in skew.hot_keys(df, ["order_id"]).collect()] == ["HOT"]
    ours = skew.row_number_within(df, ["order_id"], ["v", "item_id"], "rn")
    native = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("order_id").orderBy("v", "item_id")).cast("int"))
    assert set(ours.collect()) == set(native.collect())


def test_no_hot_groups_keeps_single_branch(spark):
    df = _lines(spark)
    normal, hot_rows, hot = skew.split_hot(df, ["order_id"], threshold=10_000)
    assert hot_rows is None and hot is None and normal is df


def test_fact_sales_with_hot_order(spark, monkeypatch):
    from datetime import date

    from starloom.operators import dims, facts
    from starloom.sources.seed import seed_tables

    t = seed_tables(spark)
    as_of = date(2024, 4, 1)
    dc = dims.dim_customer(None, t["customers"], t["orders"], as_of).checkpoint()
    dp = dims.dim_product(None, t["products"], t["suppliers"], as_of).checkpoint()
    ds = dims.dim_store(None, t["stores"]).checkpoint()
    dpr = dims.dim_promotion(None, t["promotions"]).checkpoint()
    args = (t["order_items"], t["orders"], t["products"], t["promotions"], dc, dp, ds, dpr)
    base = facts.fact_sales(*args).drop("sales_key")
    monkeypatch.setattr(skew, "HOT_GROUP_ROWS", 2)  # orders with 3 lines become hot
    split = facts.fact_sales(*args).drop("sales_key")
    assert split.count() == 25
    assert set(base.collect()) == set(split.collect())


def test_line_ids_keep_every_digit(spark):
    """An order of 12,000 lines: as many ids, in line order, and one line number each."""
    from starloom.operators.facts import line_number
    from starloom.sources.adapter import adapt, fixed_width, store_id
    from starloom.sources.tables import read_driver_tables

    t = read_driver_tables(spark, "/root/testdata/sf0.001")
    big = t["lineitem"].crossJoin(spark.range(2)).limit(12_000).drop("id").withColumn("l_orderkey", F.lit(1).cast("long"))
    items = adapt({**t, "lineitem": big})["order_items"]
    got = items.withColumn("n", line_number()).agg(
        F.count("*"), F.count_distinct("item_id"), F.max("n"), F.max(F.length("item_id"))).first()
    assert tuple(got) == (12_000, 12_000, 12_000, 12)
    last = items.orderBy(F.desc("item_id")).first()["item_id"]
    assert last == "1-0000012000"
    ids = spark.createDataFrame([(7,), (1000,)], "n long").select(store_id(F.col("n")).alias("s")).collect()
    assert [r.s for r in ids] == ["STR007", "STR1000"]
    import pytest

    with pytest.raises(Exception, match="more than 3 digits"):
        spark.range(1000, 1001).select(fixed_width(F.col("id"), 3)).collect()


def test_hot_keys_are_counted_in_large_hash_groups_only(spark, monkeypatch):
    """No key is counted by itself where no hash group is large enough; keys that share a group
    with a hot one are told apart."""
    df = _lines(spark)
    for groups in (1, 3, 65_536):
        monkeypatch.setattr(skew, "HASH_GROUPS", groups)
        assert [r.order_id for r in skew.hot_keys(df, ["order_id"], 100).collect()] == ["HOT"]
    seen = []
    monkeypatch.setattr(skew.R, "pin", lambda d: seen.append(d) or d)
    assert skew.hot_keys(df, ["order_id"], 10_000).isEmpty()
    assert "Scan ExistingRDD" not in seen[0]._jdf.queryExecution().executedPlan().toString()
