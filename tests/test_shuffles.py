"""What the steps of a load shuffle: keys and counts where whole rows are not needed, rows once."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from given import SF_SMALL
from starloom.contracts import STAGING, WAREHOUSE, Contract
from starloom.functions import bitmaps as B
from starloom.operators import dims, facts, quality, quarantine, state
from starloom.operators.calendar import dim_date
from starloom.operators.ranking import pin
from starloom.plans import versions
from starloom.plans.warehouse import append_sales, stage_mirror
from starloom.session import laid_out_by_order, scratch_path
from starloom.sources.adapter import adapt
from starloom.sources.seed import seed_tables
from starloom.sources.tables import conform, layer_path, read_driver_tables, write_table


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def shuffled(df) -> list[set[str]]:
    """The columns that each hash exchange of the plan moves."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning", text)
    return [{c.split("#")[0] for c in x.split(", ")} for x in found]


def seed_star(spark):
    t, day = seed_tables(spark), date(2024, 4, 1)
    d = (dims.dim_customer(None, t["customers"], t["orders"], day), dims.dim_product(None, t["products"], t["suppliers"], day),
         dims.dim_store(None, t["stores"]), dims.dim_promotion(None, t["promotions"]))
    return t, d


def test_foreign_keys_are_counted_by_key(spark, no_broadcast):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None), (None, "d")], "k int, wide string").repartition(2)
    parent = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    c = Contract("c", "x", (("k", WAREHOUSE["dim_store"].schema["store_key"].dataType, True),
                            ("wide", WAREHOUSE["dim_store"].schema["store_id"].dataType, False)),
                 foreign_keys=((("k",), "p", ("k",)),))
    p = Contract("p", "x", ())
    got = quality.violation_counts({"c": child}, {"c": c, "p": p}, {"p": parent})
    assert {r[0]: r[1] for r in got.collect()} == {"c.not_null": 1, "c.length": 0, "c.fk_p": 1}
    assert all("wide" not in x for x in shuffled(got))


def test_inventory_moves_the_lines_once(spark):
    plan = adapt(read_driver_tables(spark, SF_SMALL))["inventory"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_lines_meet_products_before_they_carry_headers(spark, no_broadcast):
    t, d = seed_star(spark)
    rows = facts.fact_sales(t["order_items"], t["orders"], t["products"], t["promotions"], *d, lines_colocated=True, order_buckets=3)
    lines = [x for x in shuffled(rows) if "item_id" in x]
    assert len(lines) == 2 and not any({"customer_key", "order_date"} & x for x in lines), lines
    assert rows.count() == 25


def test_rows_without_twins_are_not_shuffled_for_their_key(spark):
    t = seed_tables(spark)
    c = Contract(**{**WAREHOUSE["dim_store"].__dict__, "name": "stores", "columns": tuple(
        (f.name, f.dataType, True) for f in t["stores"].schema.fields), "key": ("store_id",), "unique": (), "lengths": {}})
    rows = t["stores"].unionByName(t["stores"].limit(1))
    for df, bad in ((t["stores"], 0), (rows, 2)):
        out = quarantine.marked(df.repartition(2), c)
        assert not shuffled(out)
        assert quarantine.rejected(out).count() == bad and out.count() == df.count()


def test_append_evaluates_its_batch_once(spark):
    t, d = seed_star(spark)
    rows = facts.fact_sales(t["order_items"], t["orders"], t["products"], t["promotions"], *d)
    root, seen = scratch_path(spark, "once"), spark.sparkContext.accumulator(0)
    first = F.col("quantity") < 2
    write_table(rows.where(first), root, "warehouse", "fact_sales")
    stored = spark.read.parquet(layer_path(root, "warehouse", "fact_sales"))

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    batch = rows.withColumn("item_id", counted.asNondeterministic()("item_id"))
    out = append_sales(stored, batch, root)
    assert seen.value == 25
    assert out.count() == 25 == out.select("order_id", "item_id").distinct().count() == out.select("sales_key").distinct().count()
    numbers = out.groupBy("order_id").agg(F.max("order_line_num").alias("m"), F.count("*").alias("n"), F.count_distinct("order_line_num").alias("d"))
    assert numbers.where("m <> n OR n <> d").isEmpty()


def test_a_bitmap_is_no_larger_than_its_numbers(spark):
    sparse = spark.range(100).select((F.col("id") * 40_000 + 1).alias("n"))
    dense = spark.range(6_400).select((F.col("id") + 1).alias("n"))
    for df, words in ((sparse, 100), (dense, 100)):
        parts = B.bitmaps(df, [], "n")
        assert parts.schema[B.BITS].dataType.simpleString() == "bigint" and parts.count() == words
        assert parts.agg(B.n_set()).first()[0] == df.count()
    assert "SortAggregate" not in B.bitmaps(dense, [], "n")._jdf.queryExecution().executedPlan().toString()


def test_orders_of_a_bucket_have_neighbouring_numbers(spark):
    orders = spark.range(1_000).select(F.col("id").cast("string").alias("order_id"))
    _, numbers = facts.number_orders(orders, orders, order_buckets=7)
    by = numbers.groupBy(F.pmod(F.hash("order_id"), F.lit(7))).agg(
        (F.max("order_no") - F.min("order_no") + 1 == F.count("*")).alias("dense"))
    assert by.where("dense").count() == 7 and numbers.agg(F.max("order_no")).first()[0] == 1_000


def test_as_of_binding_comes_before_the_numbers(spark, no_broadcast):
    t, d = seed_star(spark)
    rows = facts.fact_sales(t["order_items"], t["orders"], t["products"], t["promotions"], *d, binding=facts.AS_OF, order_buckets=3)
    # the lines go to their orders with the product's version: nothing is shuffled after the numbering
    lines = [x for x in shuffled(rows) if "item_id" in x]
    assert any({"product_key", "unit_cost"} <= x for x in lines), lines
    assert rows.count() == 25


def test_a_batch_meets_stored_lines_without_moving_them(spark, no_broadcast):
    rows = spark.createDataFrame(
        [(f"O{i % 7}", f"I{i:03d}", 1, 20240101, "x" * 9) for i in range(60)],
        "order_id string, item_id string, order_line_num int, date_key int, wide string")
    stored = versions._pin_by_order(rows.where("item_id < 'I020'").withColumn(
        "order_line_num", F.expr("cast(substr(item_id, 2) as int) div 7 + 1")), 3)
    batch = versions._pin_by_order(rows, 3)
    with laid_out_by_order(spark):
        fresh, known = versions.new_lines(stored, batch, 3)
        assert not shuffled(fresh.repartition(3, "order_id")), shuffled(fresh)
        got = {r.item_id: (r.order_line_num, r.wide) for r in fresh.collect()}
    assert got == {f"I{i:03d}": (i // 7 + 1, "x" * 9) for i in range(20, 60)} and known.count() == 20
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_a_load_without_stock(spark):
    from starloom.plans.warehouse import LoadConfig

    t, store = seed_tables(spark), scratch_path(spark, "no-stock")
    v = versions.load(spark, store, {**t, "inventory": t["inventory"].limit(0)}, LoadConfig(as_of=date(2024, 4, 1)))
    assert (v.snapshots, v.last_snapshot_key) == ({}, 0)
    assert versions.open_version(spark, store).fact_inventory_snapshot.count() == 0


def test_lines_go_into_a_stores_buckets_once(spark, no_broadcast):
    """Also where the headers are staged in other buckets, and the store's are fewer than the shuffle partitions."""
    t, d = seed_star(spark)
    st = stage_mirror(t, scratch_path(spark, "six-buckets"), 6, check=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for customers_fit in (False, True):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000" if customers_fit else before)
        dim = tuple(pin(x) for x in d)
        rows = facts.fact_sales(st["order_items"], st["orders"], st["products"], st["promotions"], *dim, lines_colocated=True, order_buckets=2)
        lines = [x for x in shuffled(rows.repartition(2, "order_id")) if "item_id" in x]
        assert len(lines) == 2 and not any("net_revenue" in x for x in lines), lines
        assert rows.count() == 25


def test_weeks_add_up_days(spark):
    """The revenue of a load's lines is read once for its days and weeks."""
    t, d = seed_star(spark)
    rows = pin(facts.fact_sales(t["order_items"], t["orders"], t["products"], t["promotions"], *d))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("decimal(12,2)")
    def counted(x):
        seen.add(1)
        return x

    days = pin(dim_date(spark, date(2023, 1, 1), date(2024, 12, 31)))
    sums = state.of_load(rows.withColumn("net_revenue", counted.asNondeterministic()("net_revenue")), days, None)
    week = sums["week"].collect()
    day = sums["day"].collect()
    assert seen.value == 25
    total = rows.agg(F.sum("net_revenue")).first()[0]
    assert sum(r.net_revenue for r in week) == sum(r.net_revenue for r in day) == total
    assert sums["week"].schema["net_revenue"].dataType == sums["day"].schema["net_revenue"].dataType


def test_rows_are_counted_without_lists_of_what_they_break(spark):
    t = seed_tables(spark)
    got = quality.violation_counts({"stores": t["stores"]}, STAGING)
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.violations == 0 for r in got.collect())
    # null, too long, both, and neither; NULL is not too long
    rows = spark.createDataFrame([("a", None, None), ("b", "n", "s" * 3), ("c", None, "s" * 3), ("d", "n", "NY")],
                                 "store_id string, name string, state string")
    wide = conform(rows, STAGING["stores"])
    counts = {r.check_name: r.violations for r in quality.violation_counts({"stores": wide}, STAGING).collect()}
    assert (counts["stores.not_null"], counts["stores.length"]) == (2, 2)
    marked = {r.store_id: r.broken_rules for r in quarantine.marked(wide, STAGING["stores"]).collect()}
    assert marked == {"a": ["not_null:name"], "b": ["length:state"], "c": ["not_null:name", "length:state"], "d": []}
