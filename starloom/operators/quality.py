"""Data-quality operators: table constraints turned into DataFrames of violations.

Parquet enforces no key, NOT NULL, foreign key or length rule, so each rule is data work
here: an empty result means the rule holds. ``validate`` runs a set of them and raises on
the first violation (fetching at most a few example rows to the driver).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import ALL, Contract
from starloom.operators.scd import scd_current


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any required column, plus the list of offending columns."""
    if not cols:
        return df.limit(0).withColumn("null_columns", F.array().cast("array<string>"))
    return df.withColumn("null_columns", null_columns(cols)).where(F.size("null_columns") > 0)


def null_columns(cols: Sequence[str]) -> Column:
    """Names of the required columns that are NULL in a row."""
    flags = [F.when(F.col(c).isNull(), F.lit(c)) for c in cols]
    return F.filter(F.array(*flags).cast("array<string>"), lambda x: x.isNotNull())


def has_null(cols: Sequence[str]) -> Column:
    """Whether a required column is NULL in a row."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols], F.lit(False))


def too_long(df: DataFrame, contract: Contract) -> list[Column]:
    """For each column with a declared length, whether a row's value is longer."""
    return [F.length(c) > n for c, n in contract.lengths.items() if c in df.columns]


def long_values(df: DataFrame, contract: Contract) -> Column:
    """The values of a row that are longer than their declared length."""
    checks = [F.when(F.length(c) > n, F.struct(
        F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(n).alias("max_length")))
        for c, n in contract.lengths.items() if c in df.columns]
    return F.filter(F.array(*checks).cast("array<struct<column:string,value:string,max_length:int>>"),
                    lambda x: x.isNotNull())


def dq_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (composite keys allowed)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def dq_fk(
    child: DataFrame,
    parent: DataFrame,
    child_cols: Sequence[str],
    parent_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row. A NULL key is allowed."""
    parent_cols = list(parent_cols or child_cols)
    p = parent.select(*[F.col(pc).alias(f"__p{i}") for i, pc in enumerate(parent_cols)]).distinct()
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_cols])
    cond = [child[c] == p[f"__p{i}"] for i, c in enumerate(child_cols)]
    return child.where(not_null).join(p, cond, "left_anti")


def dq_default(df: DataFrame, contract: Contract) -> DataFrame:
    """Add declared defaults for columns that are absent; an explicit NULL stays NULL."""
    out = df
    for name, typ, _ in contract.columns:
        if name not in out.columns and name in contract.defaults:
            out = out.withColumn(name, F.lit(contract.defaults[name]).cast(typ))
    return out


def dq_domain(df: DataFrame, contract: Contract) -> DataFrame:
    """Values longer than their declared VARCHAR length, one row per offending value."""
    return df.select(F.explode(long_values(df, contract)).alias("v")).select("v.*")


def dq_rowcounts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per-table row counts, one branch per table, ordered by table name."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("tbl"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("tbl")


def dq_loadcount(df: DataFrame, expected: int | None = None) -> DataFrame:
    """Rows after a load, compared with an expected number when one is given."""
    out = df.agg(F.count(F.lit(1)).alias("actual"))
    exp = F.lit(expected).cast("long")
    return out.select("actual", exp.alias("expected"),
                      (exp.isNull() | (F.col("actual") == exp)).alias("ok"))


def dq_sales_sanity(fact_sales: DataFrame) -> DataFrame:
    """Row count, distinct orders / customers / products / stores, revenue and profit."""
    # one aggregate for each distinct count, joined as single rows: counting them all in one
    # would expand every row of the fact by the number of columns
    one = fact_sales.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.round(F.sum("net_revenue"), 2).cast("decimal(22,2)").alias("total_revenue"),
        F.round(F.sum("gross_profit"), 2).cast("decimal(22,2)").alias("total_profit"),
    )
    for column, name in (("order_id", "distinct_orders"), ("customer_key", "distinct_customers"),
                         ("product_key", "distinct_products"), ("store_key", "distinct_stores")):
        one = one.join(F.broadcast(fact_sales.agg(F.count_distinct(column).alias(name))))
    return one.select("total_rows", "distinct_orders", "distinct_customers", "distinct_products",
                      "distinct_stores", "total_revenue", "total_profit")


def dq_inventory_listing(
    snapshot: DataFrame, dim_product: DataFrame, dim_store: DataFrame
) -> DataFrame:
    """Snapshot rows with current product and store names, ordered by store, product."""
    p = scd_current(dim_product).select("product_key", "product_name")
    s = dim_store.select("store_key", "store_name")
    return (
        snapshot.join(p, "product_key").join(s, "store_key")
        .select("store_name", "product_name", "qty_on_hand", "reorder_point",
                "last_restock_date", "snapshot_date")
        .orderBy(F.col("store_name").asc_nulls_last(), F.col("product_name").asc_nulls_last())
    )


def dq_tables_present(spark: SparkSession, root: str) -> DataFrame:
    """Every contract table of the three layers, with whether its folder exists."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for layer, tables in ALL.items():
        for name in tables:
            path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{layer}/{name}")
            present = bool(path.getFileSystem(conf).exists(path))
            rows.append((layer, name, present))
    return spark.createDataFrame(rows, "table_schema string, table_name string, present boolean") \
        .orderBy("table_schema", "table_name")


def violations(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract],
               parents: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All rule checks for a set of tables: {"<table>.<rule>": violations DataFrame}."""
    out: dict[str, DataFrame] = {}
    parents = dict(parents or {})
    parents.update(tables)
    for name, df in tables.items():
        c = contracts[name]
        out[f"{name}.not_null"] = dq_not_null(df, c.required)
        if c.key:
            out[f"{name}.unique_key"] = dq_unique(df, c.key)
        for u in c.unique:
            out[f"{name}.unique_{'_'.join(u)}"] = dq_unique(df, u)
        for child_cols, parent, parent_cols in c.foreign_keys:
            if parent in parents:
                out[f"{name}.fk_{parent}"] = dq_fk(df, parents[parent], child_cols, parent_cols)
        out[f"{name}.length"] = dq_domain(df, c)
    return out


def violation_counts(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, Contract],
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Number of violations per rule (``check_name``, ``violations``), same rules and names as
    ``violations``. NOT NULL and length rules of a table are counted in one pass over it, by plain
    comparisons: no row gets a list of what it breaks. Foreign
    keys are grouped to (key, rows) before they meet their parents' keys, and key rules group by
    the key: a large parent costs a shuffle of keys and counts, never of whole rows."""
    parents = dict(parents or {})
    parents.update(tables)
    parts = []
    for name, df in tables.items():
        c = contracts[name]
        counts = {"not_null": F.count_if(has_null(c.required)),
                  "length": reduce(lambda a, b: a + b, [F.count_if(v) for v in too_long(df, c)], F.lit(0).cast("long"))}
        parts.append(
            df.agg(*[v.alias(k) for k, v in counts.items()]).select(F.explode(F.array(*[
                F.struct(F.lit(f"{name}.{k}").alias("check_name"), F.col(k).alias("violations")) for k in counts]))
                .alias("v")).select("v.*")
        )
        for child_cols, parent, parent_cols in c.foreign_keys:
            if parent in parents:
                used = df.groupBy(*child_cols).agg(F.count(F.lit(1)).alias("__rows"))
                parts.append(dq_fk(used, parents[parent], child_cols, parent_cols)
                             .agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("violations"))
                             .select(F.lit(f"{name}.fk_{parent}").alias("check_name"), "violations"))
        keyed = ([("unique_key", c.key)] if c.key else []) + [
            ("unique_" + "_".join(u), u) for u in c.unique]
        for label, cols in keyed:
            parts.append(dq_unique(df, cols).agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(f"{name}.{label}").alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def validate(checks: Mapping[str, DataFrame], examples: int = 3) -> None:
    """Raise ``ValueError`` naming the first failed check (with a few example rows)."""
    for name, df in checks.items():
        rows = df.limit(examples).collect()
        if rows:
            raise ValueError(f"data-quality check {name} failed, e.g. {[r.asDict() for r in rows]}")
