"""Late dimension batches, sales bound as of their dates, and the quarantine of broken rows."""

from __future__ import annotations

import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.contracts import INT, SOURCE, STAGING, STR, _c, _contract
from starloom.operators import facts, quality, quarantine, scd, skew
from starloom.plans import versions
from starloom.plans.warehouse import LoadConfig
from starloom.session import scratch_path
from starloom.sources.seed import seed_tables

DAY = date(2024, 1, 1)
DIM = "sk int, id string, name string, phone string, effective_date date, expiry_date date, is_current boolean, row_hash string"
END = date(9999, 12, 31)


def _batch(spark, rows):
    return spark.createDataFrame([(i, n, p, n) for i, n, p in rows], "id string, name string, phone string, row_hash string")


def _apply(spark, batches):
    dim = spark.createDataFrame([], DIM)
    log = spark.createDataFrame([], "id string, observed_on date, observed string")
    for day, rows in batches:
        dim, log = scd.scd2_splice(dim, log, _batch(spark, rows), ["id"], "sk", day)
        dim, log = dim.checkpoint(), log.checkpoint()
        assert scd.overlapping_versions(dim, ["id"]).count() == 0
    return dim, log


def _intervals(dim):
    return sorted((r.id, r.effective_date, r.expiry_date, r.is_current, r.name) for r in dim.collect())


BATCHES = [
    (DAY, [("a", "A", "1"), ("b", "B", "1"), ("c", "C", "1"), ("n", None, "1")]),
    (DAY + timedelta(10), [("a", "A2", "2"), ("b", "B", "2"), ("d", "D", "2"), ("n", None, "2")]),
    (DAY + timedelta(20), [("a", "A", "3"), ("b", "B3", "3"), ("c", "C", "3"), ("d", "D", "3")]),
]


def test_the_order_of_batches_does_not_change_the_intervals(spark):
    want = None
    for order in itertools.permutations(BATCHES):
        dim, log = _apply(spark, order)
        got = _intervals(dim)
        want = want or got
        assert got == want, order
        keys = [r.sk for r in dim.collect()]
        assert len(set(keys)) == len(keys) and log.count() == 12
    # a change that went back is three versions; what is seen again unchanged is one
    assert [(x[1], x[4]) for x in want if x[0] == "a"] == [(DAY, "A"), (DAY + timedelta(10), "A2"), (DAY + timedelta(20), "A")]
    assert [x[2:4] for x in want if x[0] == "c"] == [(END, True)] and [x[1] for x in want if x[0] == "d"] == [DAY + timedelta(10)]


def test_a_late_batch_keeps_the_stored_keys(spark):
    first, last, late = BATCHES[0], BATCHES[2], BATCHES[1]
    dim, log = _apply(spark, [first, last])
    before = {(r.id, r.effective_date): r.sk for r in dim.collect()}
    after, log = scd.scd2_splice(dim, log, _batch(spark, late[1]), ["id"], "sk", late[0])
    now = {(r.id, r.effective_date): r.sk for r in after.collect()}
    # "d" begins earlier under the same key; the others keep day and key; new versions get new keys
    assert now["d", late[0]] == before["d", last[0]]
    assert all(now[k] == v for k, v in before.items() if k[0] != "d") and now["a", late[0]] > max(before.values())
    # "d" now begins with the late batch and takes its row; "c" is not in it and stays
    assert after.where("id = 'd'").first().phone == "2" and after.where("id = 'c'").count() == 1
    again, log2 = scd.scd2_splice(after.checkpoint(), log.checkpoint(), _batch(spark, late[1]), ["id"], "sk", late[0])
    assert _intervals(again) == _intervals(after) and log2.count() == log.count()
    with pytest.raises(ValueError, match="different rows"):
        scd.scd2_splice(after, log, _batch(spark, [("a", "other", "2")]), ["id"], "sk", late[0])
    with pytest.raises(ValueError, match="lacks the batches"):
        scd.scd2_splice(after, log.where("id <> 'a' OR observed_on <> DATE '2024-01-01'"),
                        _batch(spark, [("a", "A5", "2")]), ["id"], "sk", DAY + timedelta(5))


@pytest.mark.parametrize("hot", [10 ** 6, 30])
def test_as_of_binding_against_plain_search(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "HOT_GROUP_ROWS", hot)
    r = random.Random(4)
    dims, versions_of = [], {}
    for k in range(12):
        days = sorted(r.sample(range(5, 300), 1 + k % 4))
        for a, b in zip(days, [*days[1:], None], strict=True):
            sk = len(dims) + 1
            dims.append((sk, f"k{k}", "x", "x", DAY + timedelta(a), END if b is None else DAY + timedelta(b - 1), b is None, "h"))
            versions_of.setdefault(f"k{k}", []).append((a, sk))
        dims.append((len(dims) + 1, f"k{k}", "x", "x", DAY + timedelta(days[0]), DAY + timedelta(days[0] - 1), False, "h"))  # never valid
    rows = [(n, f"k{0 if n % 3 == 0 else r.randrange(14)}", r.randrange(320)) for n in range(400)] + [(1000, None, 5)]
    df = spark.createDataFrame([(n, k, DAY + timedelta(d)) for n, k, d in rows], "n int, id string, day date")
    got = {x.n: x.sk for x in facts.bind_as_of(df, spark.createDataFrame(dims, DIM), "id", "day", "sk").collect()}
    want = {}
    for n, k, d in rows:
        if k in versions_of:  # k12, k13 and null have no version
            begun = [sk for a, sk in versions_of[k] if a <= d]
            want[n] = begun[-1] if begun else versions_of[k][0][1]
    assert got == want
    with pytest.raises(ValueError, match="unknown binding"):
        facts.fact_sales(*[df] * 8, binding="latest")


def _tables(spark):
    t = seed_tables(spark)
    cust = F.col("customer_id")
    t["customers"] = t["customers"].withColumns({"name": F.when(cust != "CUS001", F.col("name")), "city": F.when(cust == "CUS002", F.lit("c" * 51)).otherwise(F.col("city"))})
    t["products"] = t["products"].unionByName(t["products"].where("product_id = 'PRD001'"))
    t["inventory"] = t["inventory"].withColumn("store_id", F.when(F.col("product_id") == "PRD002", F.concat(F.lit("no"), "store_id")).otherwise(F.col("store_id")))
    return t


def test_quarantine_follows_references_and_the_rest_loads(spark):
    t = _tables(spark)
    out = quarantine.quarantine(t, STAGING)
    rows = {(r.tbl, r.row_id): r.broken for r in quarantine.report(out, STAGING).collect()}
    assert rows["customers", "CUS001"] == "not_null:name" and rows["customers", "CUS002"] == "length:city"
    assert out["products"].where("product_id = 'PRD001' AND array_contains(broken_rules, 'unique_key')").count() == 2
    bad_orders = {r.order_id for r in t["orders"].where("customer_id IN ('CUS001', 'CUS002')").collect()}
    assert {k[1] for k in rows if k[0] == "orders"} == bad_orders != set()
    for r in t["order_items"].collect():
        want = [x for x, b in (("fk:orders", r.order_id in bad_orders), ("fk:products", r.product_id == "PRD001")) if b]
        assert rows.get(("order_items", r.item_id), "") == ",".join(want)
    for r in t["inventory"].collect():
        want = [x for x, b in (("fk:products", r.product_id == "PRD001"), ("fk:stores", r.product_id == "PRD002")) if b]
        assert rows.get(("inventory", f"{r.store_id}|{r.product_id}"), "") == ",".join(want)
    for r in quarantine.counts(out).collect():
        assert r.accepted + r.rejected == t[r.tbl].count()
    clean = {n: quarantine.accepted(df) for n, df in out.items()}
    assert quality.violation_counts(clean, SOURCE).where("violations > 0").collect() == []
    store = scratch_path(spark, "store")
    with pytest.raises(ValueError, match="duplicate natural key"):
        versions.load(spark, store, t, LoadConfig(as_of=date(2024, 4, 1)))
    versions.load(spark, store, clean, LoadConfig(as_of=date(2024, 4, 1)))
    assert versions.open_version(spark, store).fact_sales.count() == clean["order_items"].count() > 0


def test_quarantine_of_circles_empty_tables_and_nulls(spark):
    node = _contract("node", "staging", [_c("id", STR, False, 3), _c("boss", STR), _c("team", INT)], key=["id"],
                     fks=[(("boss",), "node", ("id",)), (("team",), "team", ("no",))])
    team = _contract("team", "staging", [_c("no", INT, False), _c("lead", STR)], key=["no"], fks=[(("lead",), "node", ("id",))])
    contracts = {"node": node, "team": team}
    rows = [("a", None, 1), ("b", "a", 1), ("c", "b", None), ("d", "none", None), ("e", "d", 2), ("f", "e", None), ("long", "a", None),
            ("g", "long", 3), (None, "a", 1), (None, "a", 1), ("x", "y", None), ("y", "x", None)]
    nodes = spark.createDataFrame(rows, "id string, boss string, team int")
    teams = spark.createDataFrame([(1, "a"), (2, "a"), (3, "f"), (4, "g"), (5, None)], "no int, lead string")
    out = quarantine.quarantine({"node": nodes, "team": teams}, contracts, {})
    got = {n: sorted(tuple(r)[0] or "" for r in quarantine.accepted(df).collect()) if n == "node" else sorted(
        r.no for r in quarantine.accepted(df).collect()) for n, df in out.items()}
    # d has no boss; e, f follow, team 3 (led by f) and g, team 4 too; null ids break NOT NULL, once each
    assert got == {"node": ["a", "b", "c", "x", "y"], "team": [1, 2, 5]}
    nulls = out["node"].where("id IS NULL").collect()
    assert [r.broken_rules for r in nulls] == [["not_null:id"], ["not_null:id"]]
    assert set(out["node"].where("id = 'g'").first().broken_rules) == {"fk:node", "fk:team"}
    empty = quarantine.quarantine({"node": nodes.limit(0), "team": teams.limit(0)}, contracts, {})
    assert {r.tbl: (r.accepted, r.rejected) for r in quarantine.counts(empty).collect()} == {"node": (0, 0), "team": (0, 0)}
