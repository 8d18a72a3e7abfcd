"""Table contracts: explicit schemas, keys, required columns, foreign keys, lengths.

Every table the library reads or writes is declared here once. Readers apply the schema
(never inferred); the data-quality operators turn keys, NOT NULL columns, foreign keys and
VARCHAR lengths into DataFrames of violations, because Parquet enforces none of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STR = T.StringType()
INT = T.IntegerType()
SHORT = T.ShortType()
LONG = T.LongType()
DATE = T.DateType()
BOOL = T.BooleanType()
BIN = T.BinaryType()


def DEC(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


@dataclass(frozen=True)
class Contract:
    name: str
    layer: str
    columns: tuple[tuple[str, T.DataType, bool], ...]  # (name, type, nullable)
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, nl) for n, t, nl in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c[0] for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [n for n, _, nl in self.columns if not nl]


def _c(name, typ, nullable=True, length=None):
    return (name, typ, nullable, length)


def _contract(name, layer, cols, key=(), unique=(), fks=(), defaults=None) -> Contract:
    return Contract(
        name=name,
        layer=layer,
        columns=tuple((n, t, nl) for n, t, nl, _ in cols),
        key=tuple(key),
        unique=tuple(tuple(u) for u in unique),
        foreign_keys=tuple(fks),
        lengths={n: ln for n, _, _, ln in cols if ln},
        defaults=dict(defaults or {}),
    )


# The column lists below are fixed values: names, order, types, lengths and defaults must equal the
# tables' declared ones.

# ---------------------------------------------------------------------------
# Operational source tables (identical columns in the staging mirror)
# ---------------------------------------------------------------------------

def _source_contracts(layer: str, with_fks: bool) -> dict[str, Contract]:
    c = {
        "suppliers": _contract("suppliers", layer, [
            _c("supplier_id", STR, False, 20), _c("name", STR, False, 100),
            _c("contact", STR, True, 100), _c("country", STR, True, 50),
            _c("lead_time_days", INT),
        ], key=["supplier_id"]),
        "products": _contract("products", layer, [
            _c("product_id", STR, False, 20), _c("name", STR, False, 200),
            _c("category", STR, False, 50), _c("subcategory", STR, True, 50),
            _c("brand", STR, True, 50), _c("cost", DEC(10, 2)), _c("list_price", DEC(10, 2)),
            _c("supplier_id", STR, True, 20),
        ], key=["product_id"]),
        "customers": _contract("customers", layer, [
            _c("customer_id", STR, False, 20), _c("name", STR, False, 100),
            _c("email", STR, True, 100), _c("phone", STR, True, 20),
            _c("address", STR, True, 200), _c("city", STR, True, 50),
            _c("state", STR, True, 2), _c("zip", STR, True, 10),
            _c("created_date", DATE, False),
        ], key=["customer_id"]),
        "stores": _contract("stores", layer, [
            _c("store_id", STR, False, 20), _c("name", STR, False, 100),
            _c("city", STR, True, 50), _c("state", STR, True, 2),
            _c("region", STR, True, 20), _c("type", STR, True, 20),
            _c("manager", STR, True, 100), _c("open_date", DATE),
        ], key=["store_id"]),
        "promotions": _contract("promotions", layer, [
            _c("promo_id", STR, False, 20), _c("name", STR, False, 100),
            _c("type", STR, True, 50), _c("discount_pct", DEC(5, 2)),
            _c("start_date", DATE), _c("end_date", DATE), _c("channel", STR, True, 50),
        ], key=["promo_id"]),
        "orders": _contract("orders", layer, [
            _c("order_id", STR, False, 20), _c("customer_id", STR, False, 20),
            _c("order_date", DATE, False), _c("status", STR, False, 20),
            _c("total_amount", DEC(12, 2), False), _c("store_id", STR, True, 20),
        ], key=["order_id"]),
        "order_items": _contract("order_items", layer, [
            _c("item_id", STR, False, 20), _c("order_id", STR, False, 20),
            _c("product_id", STR, False, 20), _c("quantity", INT, False),
            _c("unit_price", DEC(10, 2), False), _c("discount", DEC(5, 2)),
        ], key=["item_id"], defaults={"discount": 0}),
        "inventory": _contract("inventory", layer, [
            _c("store_id", STR, False, 20), _c("product_id", STR, False, 20),
            _c("quantity_on_hand", INT, False), _c("reorder_point", INT, False),
            _c("last_restock_date", DATE),
        ], key=["store_id", "product_id"]),
    }
    if with_fks:
        c["order_items"] = Contract(**{**c["order_items"].__dict__, "foreign_keys": (
            (("order_id",), "orders", ("order_id",)),
        )})
        c["inventory"] = Contract(**{**c["inventory"].__dict__, "foreign_keys": (
            (("store_id",), "stores", ("store_id",)),
            (("product_id",), "products", ("product_id",)),
        )})
    return c


SOURCE = _source_contracts("public", with_fks=True)
STAGING = _source_contracts("staging", with_fks=False)
SOURCE_TABLES = list(SOURCE)

# ---------------------------------------------------------------------------
# Warehouse (star schema)
# ---------------------------------------------------------------------------

SENTINEL_EXPIRY = "9999-12-31"
_VERSION_DEFAULTS = {"expiry_date": SENTINEL_EXPIRY, "is_current": True}

WAREHOUSE: dict[str, Contract] = {
    "dim_date": _contract("dim_date", "warehouse", [
        _c("date_key", INT, False), _c("full_date", DATE, False),
        _c("day_of_week", SHORT, False), _c("day_name", STR, False, 10),
        _c("day_of_month", SHORT, False), _c("day_of_year", SHORT, False),
        _c("week_of_year", SHORT, False), _c("month_number", SHORT, False),
        _c("month_name", STR, False, 10), _c("quarter_number", SHORT, False),
        _c("quarter_name", STR, False, 6), _c("year_number", SHORT, False),
        _c("fiscal_year", SHORT, False), _c("fiscal_quarter", SHORT, False),
        _c("is_weekend", BOOL, False), _c("is_holiday", BOOL, False),
        _c("holiday_name", STR, True, 50),
    ], key=["date_key"], defaults={"is_holiday": False}),
    "dim_customer": _contract("dim_customer", "warehouse", [
        _c("customer_key", INT, False), _c("customer_id", STR, False, 20),
        _c("customer_name", STR, False, 100), _c("email", STR, True, 100),
        _c("phone", STR, True, 20), _c("address", STR, True, 200),
        _c("city", STR, True, 50), _c("state", STR, True, 2),
        _c("zip_code", STR, True, 10), _c("customer_segment", STR, True, 20),
        _c("effective_date", DATE, False), _c("expiry_date", DATE, False),
        _c("is_current", BOOL, False), _c("row_hash", BIN),
    ], key=["customer_key"], defaults=_VERSION_DEFAULTS),
    "dim_product": _contract("dim_product", "warehouse", [
        _c("product_key", INT, False), _c("product_id", STR, False, 20),
        _c("product_name", STR, False, 200), _c("category", STR, False, 50),
        _c("subcategory", STR, True, 50), _c("brand", STR, True, 50),
        _c("cost_price", DEC(10, 2)), _c("list_price", DEC(10, 2)),
        _c("supplier_name", STR, True, 100), _c("supplier_country", STR, True, 50),
        _c("effective_date", DATE, False), _c("expiry_date", DATE, False),
        _c("is_current", BOOL, False), _c("row_hash", BIN),
    ], key=["product_key"], defaults=_VERSION_DEFAULTS),
    "dim_store": _contract("dim_store", "warehouse", [
        _c("store_key", INT, False), _c("store_id", STR, False, 20),
        _c("store_name", STR, False, 100), _c("city", STR, True, 50),
        _c("state", STR, True, 2), _c("region", STR, True, 20),
        _c("store_type", STR, True, 20), _c("manager_name", STR, True, 100),
        _c("opening_date", DATE),
    ], key=["store_key"], unique=[["store_id"]]),
    "dim_promotion": _contract("dim_promotion", "warehouse", [
        _c("promotion_key", INT, False), _c("promo_id", STR, False, 20),
        _c("promo_name", STR, False, 100), _c("promo_type", STR, True, 50),
        _c("discount_pct", DEC(5, 2)), _c("start_date", DATE), _c("end_date", DATE),
        _c("channel", STR, True, 50),
    ], key=["promotion_key"], unique=[["promo_id"]]),
    "fact_sales": _contract("fact_sales", "warehouse", [
        _c("sales_key", LONG, False), _c("date_key", INT, False),
        _c("customer_key", INT, False), _c("product_key", INT, False),
        _c("store_key", INT, False), _c("promotion_key", INT, True),
        _c("order_id", STR, False, 20), _c("order_line_num", INT, False),
        _c("quantity", INT, False), _c("unit_price", DEC(10, 2), False),
        _c("unit_cost", DEC(10, 2), False), _c("discount_amount", DEC(10, 2)),
        _c("net_revenue", DEC(12, 2), False), _c("gross_profit", DEC(12, 2), False),
        _c("tax_amount", DEC(10, 2)),
    ], key=["sales_key"], fks=[
        (("date_key",), "dim_date", ("date_key",)),
        (("customer_key",), "dim_customer", ("customer_key",)),
        (("product_key",), "dim_product", ("product_key",)),
        (("store_key",), "dim_store", ("store_key",)),
        (("promotion_key",), "dim_promotion", ("promotion_key",)),
    ], defaults={"discount_amount": 0, "tax_amount": 0}),
    "fact_inventory_snapshot": _contract("fact_inventory_snapshot", "warehouse", [
        _c("inventory_snapshot_key", LONG, False), _c("product_key", INT, False),
        _c("store_key", INT, False), _c("date_key", INT, False),
        _c("qty_on_hand", INT, False), _c("reorder_point", INT),
        _c("last_restock_date", DATE), _c("snapshot_date", DATE, False),
    ], key=["inventory_snapshot_key"], unique=[["product_key", "store_key", "date_key"]],
        fks=[
        (("product_key",), "dim_product", ("product_key",)),
        (("store_key",), "dim_store", ("store_key",)),
        (("date_key",), "dim_date", ("date_key",)),
    ]),
}

ALL: dict[str, dict[str, Contract]] = {
    "public": SOURCE,
    "staging": STAGING,
    "warehouse": WAREHOUSE,
}

# ---------------------------------------------------------------------------
# Driver test tables (TPC-H-like inputs the adapter maps onto the sources)
# ---------------------------------------------------------------------------

TS = T.TimestampNTZType()
DBL = T.DoubleType()

DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([T.StructField("r_regionkey", INT), T.StructField("r_name", STR)]),
    "nation": T.StructType([
        T.StructField("n_nationkey", INT), T.StructField("n_name", STR),
        T.StructField("n_regionkey", INT),
    ]),
    "customer": T.StructType([
        T.StructField("c_custkey", LONG), T.StructField("c_name", STR),
        T.StructField("c_nationkey", INT), T.StructField("c_acctbal", DBL),
        T.StructField("c_mktsegment", STR),
    ]),
    "supplier": T.StructType([
        T.StructField("s_suppkey", LONG), T.StructField("s_name", STR),
        T.StructField("s_nationkey", INT), T.StructField("s_acctbal", DBL),
    ]),
    "part": T.StructType([
        T.StructField("p_partkey", LONG), T.StructField("p_name", STR),
        T.StructField("p_brand", STR), T.StructField("p_type", STR),
        T.StructField("p_size", INT), T.StructField("p_retailprice", DBL),
    ]),
    "orders": T.StructType([
        T.StructField("o_orderkey", LONG), T.StructField("o_custkey", LONG),
        T.StructField("o_orderstatus", STR), T.StructField("o_totalprice", DBL),
        T.StructField("o_orderdate", TS), T.StructField("o_orderpriority", STR),
    ]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", LONG), T.StructField("l_partkey", LONG),
        T.StructField("l_suppkey", LONG), T.StructField("l_linenumber", INT),
        T.StructField("l_quantity", DBL), T.StructField("l_extendedprice", DBL),
        T.StructField("l_discount", DBL), T.StructField("l_tax", DBL),
        T.StructField("l_returnflag", STR), T.StructField("l_linestatus", STR),
        T.StructField("l_shipdate", TS),
    ]),
}
