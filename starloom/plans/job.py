"""Command-line job: load driver tables into a store as its next version and write the reports.

    spark-submit starloom/plans/job.py --sf-dir <tables> [--root <store>] [--as-of 2002-01-01]
        [--order-buckets N] [--by-month] [--queries q01_monthly_trend,...]

The first load of a store builds the star; later ones, with a later extract, merge the dimensions,
extend the calendar and append new lines and the snapshot (``plans.versions``). A load is seen by
readers once it is published, as a whole.

A load's staging tables and reports are written in its own folder, ``<store>/loads/<load>/``
(default store: a fresh folder inside the session's ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import json
import time
from dataclasses import replace
from datetime import date

from pyspark.sql import SparkSession

from starloom.operators import analytics as A
from starloom.plans import versions
from starloom.plans.warehouse import TESTDATA_CONFIG, stage_mirror, with_buckets
from starloom.session import get_session, scratch_path
from starloom.sources.adapter import adapt
from starloom.sources.tables import read_driver_tables


def run(spark: SparkSession, sf_dir: str, root: str | None = None, as_of: date | None = None,
        order_buckets: int | None = None, queries: list[str] | None = None, by_month: bool = False) -> dict:
    cfg = replace(TESTDATA_CONFIG, fact_partition_by_month=by_month)
    if as_of:
        cfg = replace(cfg, as_of=as_of)
    if order_buckets is not None:
        cfg = replace(cfg, order_buckets=order_buckets or None)
    root = root or scratch_path(spark, "store")
    timings: dict[str, float] = {}
    t = time.time()
    tables = read_driver_tables(spark, sf_dir)
    base, load_id = versions.begin(spark, root)
    if base:
        cfg = replace(cfg, order_buckets=base.order_buckets, lines_per_bucket=None)
    elif order_buckets is None:
        cfg = with_buckets(cfg, tables["lineitem"])
    folder = versions.load_folder(root, load_id)
    staging = stage_mirror(adapt(tables, order_buckets=cfg.order_buckets), folder, cfg.order_buckets)
    timings["stage"] = time.time() - t
    t = time.time()
    version = versions.load(spark, root, staging, cfg, at=(base, load_id))
    star = versions.open_version(spark, root, version.number)
    timings["load"] = time.time() - t
    for name in queries or list(A.QUERIES):
        fn = A.QUERIES[name]
        t = time.time()
        df = fn(star, cfg.as_of) if name == "q11_rfm" else fn(star)
        df.write.mode("overwrite").parquet(f"{folder}/reports/{name}")
        timings[name] = time.time() - t
    return {"root": root, "version": version.number, "reports": f"{folder}/reports",
            "seconds": {k: round(v, 3) for k, v in timings.items()}}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--root")
    ap.add_argument("--as-of", type=date.fromisoformat)
    ap.add_argument("--order-buckets", type=int)
    ap.add_argument("--by-month", action="store_true")
    ap.add_argument("--queries")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = get_session(args.master, app_name="starloom-job")
    out = run(spark, args.sf_dir, args.root, args.as_of, args.order_buckets,
              args.queries.split(",") if args.queries else None, args.by_month)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
