"""Contract checks (FIXTURES F5, F11, F12)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from starloom.contracts import SOURCE, WAREHOUSE
from starloom.operators import quality
from starloom.sources.tables import conform


def test_not_null_unique_fk(spark):
    items = spark.createDataFrame(
        [("I1", "O1", "P1", 1, D("1.00"), None), ("I1", "O2", "P9", 1, D("1.00"), D("0"))],
        SOURCE["order_items"].schema,
    )
    orders = spark.createDataFrame(
        [("O1", "C1", date(2023, 1, 1), "Completed", D("1.00"), None)], SOURCE["orders"].schema)
    assert quality.dq_unique(items, ["item_id"]).count() == 1
    assert quality.dq_fk(items, orders, ["order_id"]).count() == 1
    nn = quality.dq_not_null(orders, ["order_id", "store_id"]).first()
    assert nn.null_columns == ["store_id"]
    checks = quality.violations({"order_items": items, "orders": orders}, SOURCE)
    assert checks["order_items.unique_key"].count() == 1
    assert checks["order_items.fk_orders"].count() == 1


def test_null_discount_breaks_fact_not_null(spark):
    from pyspark.sql import functions as F
    from starloom.operators import facts
    df = spark.createDataFrame([(D("10.00"), 2, None)], "p decimal(10,2), q int, pct decimal(5,2)")
    r = df.select(facts.measure_net_revenue(F.col("p"), F.col("q"), F.col("pct")).alias("net_revenue"))
    assert quality.dq_not_null(r, ["net_revenue"]).count() == 1


def test_grain_check_rejects_duplicate_snapshot(spark):
    row = (1, 10, 20, 20240401, 5, 1, None, date(2024, 4, 1))
    snap = spark.createDataFrame([row, (2,) + row[1:]], WAREHOUSE["fact_inventory_snapshot"].schema)
    checks = quality.violations({"fact_inventory_snapshot": snap}, WAREHOUSE)
    assert checks["fact_inventory_snapshot.unique_product_key_store_key_date_key"].count() == 1
    try:
        quality.validate(checks)
    except ValueError as e:
        assert "unique_product_key_store_key_date_key" in str(e)
    else:
        raise AssertionError("duplicate grain accepted")


def test_length_and_defaults(spark):
    df = spark.createDataFrame([("TOO-LONG-STATE",)], "state string")
    bad = quality.dq_domain(df, SOURCE["customers"])
    assert bad.first().column == "state"
    items = spark.createDataFrame([("I1", "O1", "P1", 1, D("1.00"))],
                                  "item_id string, order_id string, product_id string, quantity int, unit_price decimal(10,2)")
    filled = quality.dq_default(items, SOURCE["order_items"])
    assert filled.first().discount == 0
    assert conform(items, SOURCE["order_items"]).first().discount == D("0.00")


def test_rowcounts(spark):
    t = {"b": spark.range(3), "a": spark.range(5)}
    assert [(r.tbl, r.row_count) for r in quality.dq_rowcounts(t).collect()] == [("a", 5), ("b", 3)]


def test_loadcount(spark):
    r = quality.dq_loadcount(spark.range(25), 25).first()
    assert (r.actual, r.expected, r.ok) == (25, 25, True)
    assert quality.dq_loadcount(spark.range(24), 25).first().ok is False


def test_tables_present(spark):
    from starloom.plans.registry import warehouse_for

    from given import SF_SMALL

    wh = warehouse_for(spark, SF_SMALL)
    rows = quality.dq_tables_present(spark, wh.root).collect()
    present = {(r.table_schema, r.table_name): r.present for r in rows}
    assert all(v for (layer, _), v in present.items() if layer in ("staging", "warehouse"))
    assert not any(v for (layer, _), v in present.items() if layer == "public")


def test_decimal_overflow_raises_on_conform(spark):
    import pytest
    df = spark.createDataFrame([("P1", "n", "c", None, None, D("123456789.99"), D("1.00"), None)],
                               "product_id string, name string, category string, subcategory string, "
                               "brand string, cost decimal(12,2), list_price decimal(12,2), "
                               "supplier_id string")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW|overflow"):
        conform(df, SOURCE["products"]).collect()


def _nullable(schema):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def test_violation_counts_match_violation_rows(spark):
    items = spark.createDataFrame(
        [("I1", "O1", "P1", 1, D("1.00"), None), ("I1", "O2", "P9", None, D("1.00"), D("0")),
         ("I-TOO-LONG-FOR-TWENTY", "O3", "P1", 1, D("1.00"), D("0"))],
        _nullable(SOURCE["order_items"].schema),
    )
    orders = spark.createDataFrame(
        [("O1", "C1", date(2023, 1, 1), "Completed", D("1.00"), None)], SOURCE["orders"].schema)
    tables = {"order_items": items, "orders": orders}
    rows = {n: df.count() for n, df in quality.violations(tables, SOURCE).items()}
    counts = {r.check_name: r.violations for r in quality.violation_counts(tables, SOURCE).collect()}
    assert counts == rows
    assert counts["order_items.not_null"] == 1 and counts["order_items.length"] == 1
    assert counts["order_items.unique_key"] == 1 and counts["order_items.fk_orders"] == 2
