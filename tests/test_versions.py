"""A store of versions: loads are published as a whole or not at all."""

from __future__ import annotations

import contextlib
import io
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom.contracts import WAREHOUSE
from starloom.operators import analytics as A
from starloom.operators import quality, state
from starloom.plans import versions
from starloom.plans.warehouse import LoadConfig
from starloom.session import scratch_path
from starloom.sources.seed import seed_tables

FIRST = LoadConfig(as_of=date(2024, 4, 1))
LATER = LoadConfig(as_of=date(2026, 3, 1))
LAYOUTS = {"plain": {}, "both": {"order_buckets": 3, "fact_partition_by_month": True}}


def _line(t, item, order, product="PRD010"):
    return t["order_items"].limit(1).selectExpr(
        f"'{item}' AS item_id", f"'{order}' AS order_id", f"'{product}' AS product_id", "quantity", "unit_price", "discount")


def _later_extract(t):
    """A moved and a new customer, a repriced product, a new store, an order of a later year, late
    lines of an old order (one of which sorts first), and an old order with another date."""
    new = t["customers"].where("customer_id = 'CUS002'").withColumn("customer_id", F.lit("CUS900"))
    order = t["orders"].where("order_id = 'ORD015'").withColumns({
        "order_id": F.lit("ORD900"), "customer_id": F.lit("CUS900"), "order_date": F.lit(date(2026, 2, 3)), "store_id": F.lit("STR900")})
    moved = F.when(F.col("order_id") == "ORD011", F.date_add("order_date", 1)).otherwise(F.col("order_date"))
    out = dict(t)
    out["customers"] = t["customers"].withColumn(
        "city", F.when(F.col("customer_id") == "CUS001", F.lit("Boston")).otherwise(F.col("city"))).unionByName(new)
    out["products"] = t["products"].withColumn(
        "cost", F.when(F.col("product_id") == "PRD010", F.lit(D("1.00"))).otherwise(F.col("cost")).cast("decimal(10,2)"))
    out["stores"] = t["stores"].unionByName(t["stores"].limit(1).withColumn("store_id", F.lit("STR900")))
    out["orders"] = t["orders"].withColumn("order_date", moved).unionByName(order)
    out["order_items"] = t["order_items"].unionByName(_line(t, "ITM900", "ORD900")).unionByName(
        _line(t, "ITM901", "ORD015")).unionByName(_line(t, "AAA001", "ORD011"))
    return out


def _facts(star):
    return sorted(map(tuple, star.fact_sales.drop("month_key").collect()))


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_two_loads(spark, layout):
    from dataclasses import replace

    t = seed_tables(spark)
    store = scratch_path(spark, "store")
    one = versions.load(spark, store, t, replace(FIRST, **LAYOUTS[layout]))
    first = versions.open_version(spark, store)
    counts = {n: getattr(first, n).count() for n in WAREHOUSE}
    before = {(r.order_id, r.item_id): r.order_line_num for r in first.fact_sales.collect()}
    t2 = _later_extract(t)
    two = versions.load(spark, store, t2, LATER)  # the layout is the store's
    assert (one.number, two.number, versions.versions(spark, store)) == (1, 2, [1, 2])
    assert (two.order_buckets, two.by_month) == (one.order_buckets, one.by_month)
    star = versions.open_version(spark, store)
    assert star.fact_sales.count() == counts["fact_sales"] + 3
    assert star.dim_customer.count() == counts["dim_customer"] + 2 and star.dim_product.count() == counts["dim_product"] + 1
    assert star.dim_store.count() == counts["dim_store"] + 1
    after = {(r.order_id, r.item_id): r.order_line_num for r in star.fact_sales.collect()}
    assert {k: after[k] for k in before} == before
    last = max(n for (o, _), n in before.items() if o == "ORD011")
    assert after["ORD011", "AAA001"] == last + 1
    # every line is in the calendar and in the trend; identities and contracts hold
    total = star.fact_sales.agg(F.sum("net_revenue")).first()[0]
    assert sum(r.monthly_revenue for r in A.q01_monthly_trend(star).collect()) == total
    tables = {n: getattr(star, n) for n in WAREHOUSE}
    assert quality.violation_counts(tables, WAREHOUSE).where("violations > 0").collect() == []
    assert star.fact_inventory_snapshot.select("snapshot_date").distinct().count() == 2
    if one.by_month:
        assert star.fact_sales.where("month_key <> date_key div 100").count() == 0
    # a line of the old order that came late takes the product's new cost and version
    late = star.fact_sales.where("item_id = 'ITM901'").first()
    assert late.unit_cost == D("1.00") and late.product_key == star.dim_product.where(
        "product_id = 'PRD010' AND is_current").first().product_key
    # the earlier version is still there
    assert versions.open_version(spark, store, 1).fact_sales.count() == counts["fact_sales"]
    # the same load again adds nothing and replaces its own snapshot day
    versions.load(spark, store, t2, LATER)
    again = versions.open_version(spark, store)
    assert _facts(again) == _facts(star) and again.dim_customer.count() == star.dim_customer.count()
    assert again.fact_inventory_snapshot.count() == star.fact_inventory_snapshot.count()
    # the partial sums of three loads, against a scan of the whole fact
    sums = {n: versions.read_state(spark, store, n) for n in state.NAMES}
    for got, want in ((state.q01_from_state(sums["day"], again), A.q01_monthly_trend(again)),
                      (state.q07_from_state(sums["week"]), A.q07_weekly_moving_avg(again)),
                      (state.q10_from_state(sums["day_product"], again), A.q10_quarterly_growth(again))):
        assert got.dtypes == want.dtypes and list(map(tuple, got.collect())) == list(map(tuple, want.collect()))
        assert not any("fact_sales" in f for f in got.inputFiles()) and any("fact_sales" in f for f in want.inputFiles())


STEPS = ["enforce", "run_concurrently", "publish"]


def test_a_load_that_stops_anywhere_leaves_the_last_version(spark, monkeypatch):
    t = seed_tables(spark)
    store = scratch_path(spark, "store")
    versions.load(spark, store, t, FIRST)
    whole = _facts(versions.open_version(spark, store))
    stock = versions.open_version(spark, store).fact_inventory_snapshot.count()
    t2 = _later_extract(t)
    for step in STEPS:
        real = getattr(versions, step)

        def stop(*a, real=real, step=step, **k):
            if step not in ("enforce", "publish"):
                real(*a, **k)  # its work is done, and then the driver is lost
            raise RuntimeError(step)

        with monkeypatch.context() as m:
            m.setattr(versions, step, stop)
            with pytest.raises(RuntimeError, match=step):
                versions.load(spark, store, t2, LATER)
        star = versions.open_version(spark, store)
        assert versions.versions(spark, store) == [1] and _facts(star) == whole, step
        assert star.fact_inventory_snapshot.count() == stock and star.dim_customer.where("customer_id = 'CUS900'").count() == 0
    # run again, the load goes through; what the stopped ones wrote is never read, and can go
    versions.load(spark, store, t2, LATER)
    star = versions.open_version(spark, store)
    assert star.fact_sales.count() == len(whole) + 3
    after = _facts(star)
    gone = versions.vacuum(spark, store, keep=1)
    assert len(gone) == len(STEPS) + 1  # with the first load's dimensions, which were replaced
    assert versions.versions(spark, store) == [2] and _facts(versions.open_version(spark, store)) == after
    assert versions.read_state(spark, store, "day").agg(F.sum("net_revenue")).first()[0] == star.fact_sales.agg(F.sum("net_revenue")).first()[0]


def test_of_two_loads_on_one_version_the_second_is_refused(spark):
    t = seed_tables(spark)
    store = scratch_path(spark, "store")
    versions.load(spark, store, t, FIRST)
    both = [versions.begin(spark, store) for _ in range(2)]
    versions.load(spark, store, _later_extract(t), LATER, at=both[0])
    with pytest.raises(versions.ConcurrentLoad):
        versions.load(spark, store, t, LATER, at=both[1])
    assert versions.versions(spark, store) == [1, 2] and versions.open_version(spark, store).fact_sales.count() == 28
    with pytest.raises(ValueError, match="no published version"):
        versions.open_version(spark, scratch_path(spark, "nothing"))


def test_a_gate_sees_the_finished_star_before_it_is_published(spark):
    t = seed_tables(spark)
    store = scratch_path(spark, "store")
    seen = []

    def gate(star):
        seen.append((star.fact_sales.count(), star.fact_inventory_snapshot.count(), versions.versions(spark, store)))
        if len(seen) == 2:
            raise ValueError("too many lines")

    versions.load(spark, store, t, FIRST, before_publish=gate)
    with pytest.raises(ValueError, match="too many lines"):
        versions.load(spark, store, _later_extract(t), LATER, before_publish=gate)
    assert seen == [(25, 11, []), (28, 11 + seen[0][1] + (seen[1][1] - 22), [1])]
    assert versions.versions(spark, store) == [1]


def test_overlapping_validity_stops_a_load(spark):
    t = seed_tables(spark)
    store = scratch_path(spark, "store")
    versions.load(spark, store, t, LATER)
    with pytest.raises(ValueError, match="dim_customer: overlapping validity"):  # an older date than the current version's
        star = versions.open_version(spark, store)
        twice = star.dim_customer.unionByName(star.dim_customer.limit(1).withColumns(
            {"is_current": F.lit(False), "effective_date": F.lit(date(2026, 1, 1))}))
        versions.check_validity({"dim_customer": twice, "dim_product": star.dim_product})


def test_scans_read_published_loads_and_wanted_months_only(spark):
    from dataclasses import replace

    t = seed_tables(spark)
    store = scratch_path(spark, "store")
    versions.load(spark, store, t, replace(FIRST, **LAYOUTS["both"]))
    versions.load(spark, store, _later_extract(t), LATER)
    star = versions.open_version(spark, store)
    def plan(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        return out.getvalue()

    # per-order steps over both loads need no exchange of the fact
    per_order = plan(star.fact_sales.groupBy("order_id").agg(F.sum("net_revenue")))
    assert "Exchange" not in per_order and "load_id" in per_order.split("PartitionFilters")[1]
    ranged = plan(A.sales_by_day(star, date(2024, 2, 1), date(2024, 2, 29)))
    filters = ranged.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "month_key" in filters and ">= 202402" in filters and "<= 202402" in filters
    by_period = plan(A.sales_by_day(star, fiscal_year=2024, fiscal_quarter=3))
    assert "dynamicpruning" in by_period.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    days = [r.full_date for r in A.sales_by_day(star, date(2024, 2, 1), date(2024, 2, 29)).collect()]
    assert days and all(d.month == 2 for d in days)
    want = star.fact_sales.where("date_key BETWEEN 20240101 AND 20240331").agg(F.sum("net_revenue"), F.count("*")).first()
    got = A.sales_by_day(star, fiscal_year=2024, fiscal_quarter=3).agg(F.sum("revenue"), F.sum("lines")).first()
    assert tuple(got) == tuple(want)
    # without month folders the same days come from the day alone
    plain = star.fact_sales.drop("month_key")
    assert A.sales_by_day(A.Star(**{**vars(star), "fact_sales": plain}), date(2024, 2, 1), date(2024, 2, 29)).count() == len(days)


def test_sql_on_a_version(spark):
    from starloom.plans.catalog import register_version

    store = scratch_path(spark, "store")
    versions.load(spark, store, seed_tables(spark), FIRST)
    names = register_version(spark, store)
    assert {"fact_sales", "dim_customer", "state_day"} <= set(names)
    a, b = (spark.sql(f"SELECT sum(net_revenue) FROM {x}").first()[0] for x in ("fact_sales", "state_day"))
    assert a == b and a is not None
    for name in names:
        spark.catalog.dropTempView(name)


def test_month_folders_take_fewer_buckets_than_lines_alone(spark):
    """Where the number of buckets comes from the lines, files of a bucket and month are not a tenth of
    a bucket; a number that is given stays."""
    from dataclasses import replace

    from starloom.operators.calendar import dim_date

    cfg = replace(FIRST, order_buckets=72, lines_per_bucket=50_000)
    days = dim_date(spark, date(1995, 1, 1), date(2001, 12, 31))
    assert versions.store_buckets(cfg, days) == 72
    by_month = replace(cfg, fact_partition_by_month=True)
    assert versions.store_buckets(by_month, days) == 8
    assert versions.store_buckets(by_month, days.where("year_number = 1995 AND month_number < 4")) == 24
    assert versions.store_buckets(replace(by_month, lines_per_bucket=None), days) == 72
    assert versions.store_buckets(replace(by_month, order_buckets=None), days) is None
    t = seed_tables(spark)
    store = scratch_path(spark, "store")
    one = versions.load(spark, store, t, replace(by_month, order_buckets=20))
    two = versions.load(spark, store, t, replace(LATER, order_buckets=20))
    assert one.order_buckets == two.order_buckets == 2 and two.last_sales_key == one.last_sales_key
    assert versions.open_version(spark, store).fact_sales.count() == 25


def test_new_lines_are_shuffled_once_for_numbers_and_buckets(spark):
    """The numbered lines of a later load lie in the store's buckets: the write adds no exchange."""
    rows = spark.createDataFrame(
        [(f"O{i % 7}", f"I{i:03d}", 1, 20240101) for i in range(60)],
        "order_id string, item_id string, order_line_num int, date_key int")
    stored = rows.where("item_id < 'I020'").withColumn("order_line_num", F.expr("cast(substr(item_id, 2) as int) div 7 + 1"))
    fresh, known = versions.new_lines(stored, rows, 3)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(fresh.repartition(3, "order_id")).count("Exchange hashpartitioning") == plan(fresh).count("Exchange hashpartitioning")
    got = {r.item_id: r.order_line_num for r in fresh.collect()}
    assert got == {f"I{i:03d}": i // 7 + 1 for i in range(20, 60)}
    assert known.count() == 20
