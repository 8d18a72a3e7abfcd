"""SCD1 / SCD2 semantics and invariants (FIXTURES F2, F3, F4)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from starloom.contracts import SOURCE
from starloom.operators import dims, scd

D1 = date(2024, 1, 1)
D2 = date(2024, 2, 1)
D3 = date(2024, 3, 1)


def _customers(spark, rows):
    full = [(cid, name, email, phone, None, "City", "ST", None, date(2020, 1, 1))
            for cid, name, email, phone in rows]
    return spark.createDataFrame(full, SOURCE["customers"].schema)


def _orders(spark, rows):
    return spark.createDataFrame(
        [(f"O{i}", cid, date(2023, 1, 1), "Completed", D(str(amt)), "S1") for i, (cid, amt) in enumerate(rows)],
        SOURCE["orders"].schema,
    )


def _batch1(spark):
    return _customers(spark, [
        ("C1", "Ann", "a@x", "111"),
        ("C2", "Ben", None, "222"),
        ("C3", "Cid", "c@x", "333"),
        ("C4", "Dee", "d@x", "444"),
    ])


def _batch2(spark):
    return _customers(spark, [
        ("C1", "Ann Smith", "a@x", "111"),   # tracked change
        ("C2", "Ben", "", "222"),            # NULL -> '' : not a change
        ("C3", "Cid", "c@x", "999"),         # phone only: not tracked
        ("C5", "Eve", "e@x", "555"),         # new key; C4 missing from batch
    ])


def test_segments_thresholds(spark):
    cust = _customers(spark, [(f"C{i}", f"N{i}", None, None) for i in range(5)])
    orders = _orders(spark, [("C0", "10000.00"), ("C1", "9999.99"), ("C2", "5000.00"), ("C3", "4999.99")])
    src = dims.scd2_source_customer(cust, orders).select("customer_id", "customer_segment")
    got = {r.customer_id: r.customer_segment for r in src.collect()}
    assert got == {"C0": "Gold", "C1": "Silver", "C2": "Silver", "C3": "Bronze", "C4": "Bronze"}


def _load(spark, mode):
    orders = _orders(spark, [])
    d1 = dims.dim_customer(None, _batch1(spark), orders, D1, mode).checkpoint()
    d2 = dims.dim_customer(d1, _batch2(spark), orders, D2, mode).checkpoint()
    return d1, d2


def test_scd2_single_pass(spark):
    d1, d2 = _load(spark, scd.SINGLE_PASS)
    assert d1.count() == 4
    rows = d2.orderBy("customer_id", "effective_date").collect()
    by = {}
    for r in rows:
        by.setdefault(r.customer_id, []).append(r)
    assert [(r.customer_name, r.is_current, r.expiry_date) for r in by["C1"]] == [
        ("Ann", False, date(2024, 1, 31)), ("Ann Smith", True, date(9999, 12, 31))]
    assert len(by["C2"]) == 1 and by["C2"][0].email is None  # NULL <-> '' is no change
    assert len(by["C3"]) == 1 and by["C3"][0].phone == "333"  # untracked column frozen
    assert len(by["C4"]) == 1 and by["C4"][0].is_current      # absent key stays current
    assert [(r.effective_date, r.is_current) for r in by["C5"]] == [(D2, True)]
    keys = [r.customer_key for r in rows]
    assert len(set(keys)) == len(keys) and max(keys) == 6     # new keys after the old maximum
    assert scd.overlapping_versions(d2, ["customer_id"]).count() == 0


def test_scd2_rerun_is_idempotent(spark):
    _, d2 = _load(spark, scd.SINGLE_PASS)
    d3 = dims.dim_customer(d2, _batch2(spark), _orders(spark, []), D3, scd.SINGLE_PASS)
    assert d3.count() == d2.count()
    assert d3.where("is_current").count() == d2.where("is_current").count()


def test_scd2_deferred_inserts_one_run_late(spark):
    d1, d2 = _load(spark, scd.DEFERRED)
    c1 = d2.where("customer_id = 'C1'").collect()
    assert [(r.is_current, r.expiry_date) for r in c1] == [(False, date(2024, 1, 31))]
    assert d2.where("customer_id = 'C5'").count() == 1      # new keys still open at once
    d3 = dims.dim_customer(d2, _batch2(spark), _orders(spark, []), D3, scd.DEFERRED)
    c1 = d3.where("customer_id = 'C1'").orderBy("effective_date").collect()
    assert [(r.customer_name, r.is_current) for r in c1] == [("Ann", False), ("Ann Smith", True)]
    # deferred twice == single pass once, up to dates and key values
    _, single = _load(spark, scd.SINGLE_PASS)
    proj = ["customer_id", "customer_name", "email", "is_current"]
    assert sorted(map(tuple, d3.select(*proj).collect())) == sorted(map(tuple, single.select(*proj).collect()))


def _stores(spark, rows):
    return spark.createDataFrame(
        [(sid, name, "City", "ST", region, "Mall", mgr, od) for sid, name, region, mgr, od in rows],
        SOURCE["stores"].schema,
    )


def test_scd1_store(spark):
    s1 = _stores(spark, [("S1", "One", "West", "M1", date(2019, 1, 1)),
                         ("S2", "Two", "East", "M2", date(2019, 2, 1))])
    d1 = dims.dim_store(None, s1).checkpoint()
    s2 = _stores(spark, [("S1", "One Renamed", "North", None, date(2021, 1, 1)),
                         ("S3", "Three", "South", "M3", date(2022, 1, 1))])
    d2 = dims.dim_store(d1, s2)
    got = {r.store_id: r for r in d2.collect()}
    k1 = {r.store_id: r.store_key for r in d1.collect()}
    assert got["S1"].store_key == k1["S1"]
    assert (got["S1"].store_name, got["S1"].region, got["S1"].manager_name) == ("One Renamed", "North", None)
    assert got["S1"].opening_date == date(2019, 1, 1)          # first value wins
    assert got["S2"].store_name == "Two"                        # missing key kept
    assert got["S3"].store_key == 3 and got["S3"].opening_date == date(2022, 1, 1)


def test_duplicate_batch_key_rejected(spark):
    s = _stores(spark, [("S1", "One", "W", "M", None), ("S1", "Uno", "W", "M", None)])
    try:
        dims.dim_store(None, s)
    except ValueError as e:
        assert "duplicate" in str(e)
    else:
        raise AssertionError("duplicate key accepted")


def test_row_hash_null_equals_empty(spark):
    from starloom.functions.hashing import row_hash
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    h = [r[0] for r in df.select(F.hex(row_hash(["x", "y"]))).collect()]
    assert h[0] == h[1]
    import hashlib
    assert h[0].lower() == hashlib.md5(b"a|").hexdigest()


def test_standalone_steps_compose_to_apply(spark):
    """scd2_detect -> scd2_expire -> scd2_insert gives the same table as scd2_apply."""
    orders = _orders(spark, [])
    d1 = dims.dim_customer(None, _batch1(spark), orders, D1).checkpoint()
    src = dims.scd2_source_customer(_batch2(spark), orders)
    status = scd.scd2_detect(d1.where("is_current"), src, ["customer_id"])
    got = {r.customer_id: r.status for r in status.collect()}
    assert got == {"C1": scd.CHANGED, "C2": scd.UNCHANGED, "C3": scd.UNCHANGED,
                   "C4": scd.ABSENT, "C5": scd.NEW}
    closed = scd.scd2_expire(d1, status, ["customer_id"], D2)
    opened = scd.scd2_insert(src, status, ["customer_id"], "customer_key", D2, start_after=4)
    composed = closed.unionByName(opened.select(*d1.columns))
    applied = dims.dim_customer(d1, _batch2(spark), orders, D2)
    cols = [c for c in d1.columns if c != "row_hash"]
    assert sorted(map(tuple, composed.select(*cols).collect())) == \
        sorted(map(tuple, applied.select(*cols).collect()))


def test_same_day_second_change_is_reported(spark):
    orders = _orders(spark, [])
    d1 = dims.dim_customer(None, _batch1(spark), orders, D1).checkpoint()
    d2 = dims.dim_customer(d1, _batch2(spark), orders, D1).checkpoint()  # same load date
    problems = {r.problem for r in scd.overlapping_versions(d2, ["customer_id"]).collect()}
    assert "expiry before effective date" in problems
