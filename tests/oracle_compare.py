"""Side-by-side check of registered Spark queries against their DuckDB SQL.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Rows are compared order-insensitively after normalising every value to text.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb


# Spark simpleString -> DuckDB type name (decimals compare as DECIMAL(p,s) on both sides).
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "string": "VARCHAR",
          "date": "DATE", "boolean": "BOOLEAN", "binary": "BLOB"}


def type_mismatches(sdf, rel) -> list[tuple[str, str, str]]:
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        if duck_types.get(f.name) != _TYPES.get(t, t.upper()):
            out.append((f.name, t, duck_types.get(f.name)))
    return out


def _norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, dict]:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec: dict = {"name": name}
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        scols = sdf.columns
        srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
        rec["spark_sec"] = round(time.time() - t0, 2)
        rec["rows"] = len(srows)
        if name not in sql:
            rec["status"] = "no-oracle"
            out[name] = rec
            if verbose:
                print(rec)
            continue
        rec["type_mismatches"] = type_mismatches(sdf, con.sql(sql[name]))
        cur = con.execute(sql[name])
        dcols = [d[0] for d in cur.description]
        drows = [tuple(_norm(x) for x in r) for r in cur.fetchall()]
        rec["oracle_rows"] = len(drows)
        if sorted(scols) != sorted(dcols):
            rec["status"] = f"columns differ: spark={scols} duck={dcols}"
        else:
            order = [dcols.index(c) for c in scols]
            drows = [tuple(r[i] for i in order) for r in drows]
            s_set, d_set = sorted(srows), sorted(drows)
            if s_set == d_set and not rec["type_mismatches"]:
                rec["status"] = "match"
            elif s_set == d_set:
                rec["status"] = "TYPES"
            else:
                only_s = [r for r in s_set if r not in set(d_set)][:3]
                only_d = [r for r in d_set if r not in set(s_set)][:3]
                rec["status"] = "MISMATCH"
                rec["only_spark"] = only_s
                rec["only_oracle"] = only_d
                rec["columns"] = scols
        out[name] = rec
        if verbose:
            print(rec, flush=True)
    return out


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, "/root/repo")
    from starloom.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark: SparkSession = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [n for n, r in res.items() if r["status"] not in ("match", "no-oracle")]
    print("MISMATCHED:", bad)
