"""Benchmark: build the star from the driver tables, then time q01..q11 on the stored star.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5 timed runs per query after one warm-up run).
Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from starloom.session import get_session, scratch_path

    # The checkpoint folder comes from the session configuration (spark.checkpoint.dir);
    # get_session only creates a private one when none is configured.
    spark = get_session(
        f"local[{cpus}]",
        app_name="starloom-bench",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        },
    )

    from starloom.operators import analytics as A
    from starloom.plans.warehouse import TESTDATA_CONFIG, build_star, stage_mirror, with_buckets
    from starloom.sources.adapter import adapt
    from starloom.sources.tables import read_driver_tables

    t0 = time.time()
    root = scratch_path(spark, "star")
    tables = read_driver_tables(spark, sf_dir)
    cfg = with_buckets(TESTDATA_CONFIG, tables["lineitem"])
    staging = stage_mirror(adapt(tables), root, cfg.order_buckets)
    t_stage = time.time() - t0
    t1 = time.time()
    star = build_star(spark, staging, cfg, root)
    t_build = time.time() - t1

    def run(name):
        fn = A.QUERIES[name]
        df = fn(star, cfg.as_of) if name == "q11_rfm" else fn(star)
        df.write.format("noop").mode("overwrite").save()

    timings = {}
    for name in A.QUERIES:
        run(name)  # warm-up
        samples = []
        for _ in range(repeat):
            t = time.time()
            run(name)
            samples.append(time.time() - t)
        timings[name] = round(statistics.median(samples), 3)

    # SCD2 second batch: customers with an order in the last month of data get an e-mail
    # (a tracked column), about a tenth of all customers.
    from datetime import date, timedelta

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from starloom.operators import dims
    from starloom.operators import ranking as R
    from starloom.plans.warehouse import _write_read
    from starloom.sources.batches import customers_with_contact_update

    batch2 = customers_with_contact_update(
        staging["customers"], staging["orders"], active_since=date(2001, 7, 1))
    t2 = time.time()
    dim2 = _write_read(
        dims.dim_customer(star.dim_customer, batch2, staging["orders"],
                          cfg.as_of + timedelta(days=31), cfg.scd2_mode, cfg.gold, cfg.silver),
        scratch_path(spark, "refresh"), "dim_customer")
    t_scd2 = time.time() - t2
    changed = dim2.where(~F.col("is_current")).count()
    n_customers = star.dim_customer.count()

    # Global rank over customer totals: distributed path vs one-task window.
    totals = R.pin(star.fact_sales.groupBy("customer_key").agg(F.sum("net_revenue").alias("rev")))
    order = [R.desc("rev"), R.asc("customer_key")]

    def one_task(df, by, buckets=None):
        """The plain window over everything, for comparison."""
        return df.withColumn("r", F.rank().over(Window.orderBy(*[k.column() for k in by])))

    def distributed(df, by, buckets=None):
        return R.rank(df, by, out="r", buckets=buckets)

    def time_rank(how):
        samples = []
        for _ in range(repeat):
            t = time.time()
            how(totals, order, cpus).write.format("noop").mode("overwrite").save()
            samples.append(time.time() - t)
        return round(statistics.median(samples), 3)

    rank_dist = time_rank(distributed)
    rank_local = time_rank(one_task)
    share = R.largest_bucket_share(totals, order, cpus)

    # The same at order-line size: every line of the fact ranked by net revenue.
    lines = star.fact_sales.select("sales_key", "net_revenue")
    line_order = [R.desc("net_revenue"), R.asc("sales_key")]

    def time_line_rank(how):
        samples = []
        for _ in range(max(1, repeat // 2)):
            t = time.time()
            how(lines, line_order, cpus).write.format("noop").mode("overwrite").save()
            samples.append(time.time() - t)
        return round(statistics.median(samples), 3)

    line_rank_dist = time_line_rank(distributed)
    line_rank_local = time_line_rank(one_task)
    line_share = R.largest_bucket_share(lines, line_order, cpus)

    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "q01_q11_total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "stage_sec": round(t_stage, 3),
        "build_star_sec": round(t_build, 3),
        "scd2_refresh_sec": round(t_scd2, 3),
        "scd2_changed_keys": changed,
        "scd2_changed_share": round(changed / n_customers, 4) if n_customers else None,
        "rank_distributed_sec": rank_dist,
        "rank_single_partition_sec": rank_local,
        "rank_rows": totals.count(),
        "rank_largest_task_share_distributed": round(share, 4),
        "rank_largest_task_share_single_partition": 1.0,
        "line_rank_rows": lines.count(),
        "line_rank_distributed_sec": line_rank_dist,
        "line_rank_single_partition_sec": line_rank_local,
        "line_rank_largest_task_share_distributed": round(line_share, 4),
        "cpus": cpus,
        "shuffle_partitions": cpus,
        "repeat": repeat,
        "input_cached": False,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
