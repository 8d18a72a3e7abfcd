"""Re-runnable loads: the sales append skips lines already loaded; the snapshot
replaces its own day."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts, quality
from starloom.plans.warehouse import LoadConfig, append_sales, build_star, stage_mirror, write_snapshot
from starloom.session import scratch_path
from starloom.sources.seed import seed_tables


def test_rerun_is_idempotent(spark):
    root = scratch_path(spark, "loads")
    staging = stage_mirror(seed_tables(spark), root)
    cfg = LoadConfig(as_of=date(2024, 4, 1))
    star = build_star(spark, staging, cfg, root)
    before = star.fact_sales.count()
    rows = facts.fact_sales(
        staging["order_items"], staging["orders"], staging["products"], staging["promotions"],
        star.dim_customer, star.dim_product, star.dim_store, star.dim_promotion)
    after = append_sales(star.fact_sales, rows, root)
    assert after.count() == before == 25
    # a batch with one new line: only that line is appended, with a fresh key
    extra = staging["order_items"].limit(1).selectExpr(
        "'ITM999' AS item_id", "'ORD015' AS order_id", "'PRD010' AS product_id", "quantity",
        "unit_price", "discount")
    rows2 = facts.fact_sales(
        staging["order_items"].unionByName(extra), staging["orders"], staging["products"],
        staging["promotions"], star.dim_customer, star.dim_product, star.dim_store,
        star.dim_promotion)
    after2 = append_sales(after, rows2, root)
    assert after2.count() == 26
    assert after2.select("sales_key").distinct().count() == 26
    # snapshot for the same day twice: one copy
    snap = facts.fact_inventory_snapshot(staging["inventory"], star.dim_product, star.dim_store, cfg.as_of)
    again = write_snapshot(snap, root)
    assert again.count() == 11
    assert quality.dq_unique(again, ["product_key", "store_key", "date_key"]).count() == 0


def test_bucketed_staging_gives_same_fact(spark):
    """Order-keyed staging written as bucketed tables: same fact rows, and the fact plan
    has no exchange on the line side."""
    from dataclasses import replace

    spark.conf.set("spark.sql.shuffle.partitions", "5")  # differs from the bucket count
    try:
        cfg = LoadConfig(as_of=date(2024, 4, 1))
        root_a, root_b = scratch_path(spark, "plain"), scratch_path(spark, "bucketed")
        plain = build_star(spark, stage_mirror(seed_tables(spark), root_a), cfg, root_a)
        st_b = stage_mirror(seed_tables(spark), root_b, order_buckets=3)
        bucketed = build_star(spark, st_b, replace(cfg, order_buckets=3), root_b)
        cols = [c for c in plain.fact_sales.columns if c != "sales_key"]
        assert set(plain.fact_sales.select(*cols).collect()) == \
            set(bucketed.fact_sales.select(*cols).collect())
        rows = facts.fact_sales(
            st_b["order_items"], st_b["orders"], st_b["products"], st_b["promotions"],
            bucketed.dim_customer, bucketed.dim_product, bucketed.dim_store,
            bucketed.dim_promotion, lines_colocated=True)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_unresolved_product_leaves_no_gap(spark):
    """A line whose product is unknown is dropped and the later lines of its order close up
    (both join orders)."""
    from decimal import Decimal as D

    from starloom.operators import dims

    t = seed_tables(spark)
    extra = spark.createDataFrame([("ITM0175", "ORD011", "PRD999", 1, D("5.00"), D("0"))],
                                  t["order_items"].schema)
    items = t["order_items"].unionByName(extra)
    as_of = date(2024, 4, 1)
    d = (dims.dim_customer(None, t["customers"], t["orders"], as_of).checkpoint(),
         dims.dim_product(None, t["products"], t["suppliers"], as_of).checkpoint(),
         dims.dim_store(None, t["stores"]).checkpoint(),
         dims.dim_promotion(None, t["promotions"]).checkpoint())
    for colocated in (False, True):
        f = facts.fact_sales(items, t["orders"], t["products"], t["promotions"], *d,
                             lines_colocated=colocated)
        assert f.count() == 25
        nums = sorted(r[0] for r in f.where(F.col("order_id") == "ORD011")
                      .select("order_line_num").collect())
        assert nums == [1, 2, 3], (colocated, nums)


def test_job_writes_reports(spark):
    from starloom.plans import job, versions

    out = job.run(spark, "/root/testdata/sf0.001", queries=["q01_monthly_trend", "q09_promo_effect"])
    assert spark.read.parquet(f"{out['reports']}/q01_monthly_trend").count() == 80
    assert spark.read.parquet(f"{out['reports']}/q09_promo_effect").count() == 2
    assert set(out["seconds"]) == {"stage", "load", "q01_monthly_trend", "q09_promo_effect"}
    # a later load of the same extract: nothing new, one more snapshot day
    again = job.run(spark, "/root/testdata/sf0.001", root=out["root"], queries=["q01_monthly_trend"], as_of=date(2002, 2, 1))
    assert (out["version"], again["version"]) == (1, 2) and again["root"] == out["root"]
    star = versions.open_version(spark, out["root"])
    assert star.fact_sales.count() == 6000
    assert star.fact_inventory_snapshot.select("snapshot_date").distinct().count() == 2
    assert spark.read.parquet(f"{again['reports']}/q01_monthly_trend").count() == 80


def test_empty_orders_build_and_query(spark):
    """No orders and no lines: the star builds, facts are empty, every query returns no rows."""
    from starloom.operators import analytics as A

    t = seed_tables(spark)
    t["orders"] = t["orders"].limit(0)
    t["order_items"] = t["order_items"].limit(0)
    root = scratch_path(spark, "empty")
    cfg = LoadConfig(as_of=date(2024, 4, 1))
    star = build_star(spark, stage_mirror(t, root), cfg, root)
    assert star.fact_sales.count() == 0
    assert star.dim_customer.count() == 10
    for name, fn in A.QUERIES.items():
        df = fn(star, cfg.as_of) if name == "q11_rfm" else fn(star)
        assert df.count() == 0, name


def test_append_to_bucketed_fact(spark):
    from dataclasses import replace

    root = scratch_path(spark, "bucket-append")
    cfg = replace(LoadConfig(as_of=date(2024, 4, 1)), order_buckets=3)
    staging = stage_mirror(seed_tables(spark), root, cfg.order_buckets)
    star = build_star(spark, staging, cfg, root)
    extra = staging["order_items"].limit(1).selectExpr(
        "'ITM999' AS item_id", "'ORD015' AS order_id", "'PRD010' AS product_id", "quantity",
        "unit_price", "discount")
    rows = facts.fact_sales(
        staging["order_items"].unionByName(extra), staging["orders"], staging["products"],
        staging["promotions"], star.dim_customer, star.dim_product, star.dim_store,
        star.dim_promotion)
    after = append_sales(star.fact_sales, rows, root, order_buckets=3)
    assert after.count() == 26
    assert after.select("sales_key").distinct().count() == 26
    plan = after.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan or "SelectedBucketsCount" in plan


def _line(staging, item, order, product="PRD010"):
    return staging["order_items"].limit(1).selectExpr(
        f"'{item}' AS item_id", f"'{order}' AS order_id", f"'{product}' AS product_id", "quantity", "unit_price", "discount")


def _rows(items, staging, star):
    return facts.fact_sales(items, staging["orders"], staging["products"], staging["promotions"],
                            star.dim_customer, star.dim_product, star.dim_store, star.dim_promotion)


@pytest.mark.parametrize("by_month", [False, True])
def test_append_knows_lines_by_identity(spark, by_month):
    """A late line that sorts first, a batch with only the new line of a known order, and the same
    batch again: every line is stored once, stored rows keep their numbers."""
    root = scratch_path(spark, "append")
    staging = stage_mirror(seed_tables(spark), root)
    cfg = LoadConfig(as_of=date(2024, 4, 1), fact_partition_by_month=by_month)
    star = build_star(spark, staging, cfg, root)
    before = {(r.order_id, r.item_id): r.order_line_num for r in star.fact_sales.collect()}
    late = staging["order_items"].unionByName(_line(staging, "AAA001", "ORD011"))  # sorts before the order's lines
    one = append_sales(star.fact_sales, _rows(late, staging, star), root)
    assert one.count() == 26
    only = _line(staging, "ZZZ001", "ORD011").unionByName(_line(staging, "ZZZ002", "ORD015"))
    two = append_sales(one, _rows(only, staging, star), root)
    again = append_sales(two, _rows(only, staging, star), root)
    rows = again.collect()
    assert len(rows) == 28 and len({r.sales_key for r in rows}) == 28
    after = {(r.order_id, r.item_id): r.order_line_num for r in rows}
    assert {k: after[k] for k in before} == before
    last = max(n for (o, _), n in before.items() if o == "ORD011")
    assert (after["ORD011", "AAA001"], after["ORD011", "ZZZ001"]) == (last + 1, last + 2)
    assert all(len({n for (o2, _), n in after.items() if o2 == o}) == sum(o2 == o for o2, _ in after) for o, _ in after)
    if by_month:
        assert again.where("month_key <> date_key div 100").count() == 0


def test_snapshot_keys_go_on_over_days(spark):
    root = scratch_path(spark, "snapshots")
    staging = stage_mirror(seed_tables(spark), root)
    star = build_star(spark, staging, LoadConfig(as_of=date(2024, 4, 1)), root)
    day = lambda d: facts.fact_inventory_snapshot(staging["inventory"], star.dim_product, star.dim_store, d)
    write_snapshot(day(date(2024, 4, 2)), root)
    both = write_snapshot(day(date(2024, 4, 2)), root)  # the same day again
    assert (both.count(), both.select("inventory_snapshot_key").distinct().count()) == (22, 22)


@pytest.mark.parametrize("broken, rule", [
    ("null name", "customers.not_null"), ("doubled header", "orders.unique_key"), ("long id", "stores.length")])
def test_staging_that_breaks_its_contract_fails_the_load(spark, broken, rule):
    t = seed_tables(spark)
    if broken == "null name":
        t["customers"] = t["customers"].withColumn("name", F.when(F.col("customer_id") != "CUS001", F.col("name")))
    elif broken == "doubled header":
        t["orders"] = t["orders"].unionByName(t["orders"].limit(1))
    else:
        t["stores"] = t["stores"].withColumn("region", F.lit("r" * 21))
    with pytest.raises(ValueError, match=rule):
        stage_mirror(t, scratch_path(spark, "broken"))


@pytest.mark.parametrize("broken, rule", [
    ("null discount", "fact_sales.not_null"), ("missing day", "fact_sales.fk_dim_date")])
def test_star_that_breaks_its_contract_fails_the_load(spark, broken, rule):
    t = seed_tables(spark)
    cfg = LoadConfig(as_of=date(2024, 4, 1))
    if broken == "null discount":
        t["order_items"] = t["order_items"].withColumn("discount", F.lit(None).cast("decimal(5,2)"))
    else:
        cfg = LoadConfig(as_of=date(2024, 4, 1), calendar_start=date(2024, 3, 1), calendar_end=date(2024, 12, 31))
    root = scratch_path(spark, "broken")
    with pytest.raises(ValueError, match=rule):
        build_star(spark, stage_mirror(t, root), cfg, root)


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from starloom import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert session.is_local("local[8]") and not session.is_local("local-cluster[3,2,1024]")


def test_each_bucket_of_the_fact_is_one_file(spark):
    """Also where the product lookup is no broadcast, so that the lines are shuffled on the way: the
    number of files does not grow with tasks times buckets."""
    import glob
    from dataclasses import replace

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        root = scratch_path(spark, "one-file-a-bucket")
        staging = stage_mirror(seed_tables(spark), root, order_buckets=3)
        star = build_star(spark, staging, replace(LoadConfig(as_of=date(2024, 4, 1)), order_buckets=3), root)
        assert star.fact_sales.count() == 25
        files = glob.glob(f"{root.removeprefix('file:')}/warehouse/fact_sales/*.parquet")
        assert 1 <= len(files) <= 3, files
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_numbered_lines_lie_in_the_buckets_they_are_staged_in(spark):
    """Lines are shuffled once for their numbers and their buckets."""
    from starloom.sources.adapter import adapt
    from starloom.sources.tables import read_driver_tables

    t = read_driver_tables(spark, "/root/testdata/sf0.001")
    plain, laid = adapt(t)["order_items"], adapt(t, order_buckets=4)["order_items"]
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, laid.collect()))
    plan = laid.repartition(4, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
