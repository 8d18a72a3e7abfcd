"""The streamed fact load equals the batch load, and a replayed batch does not duplicate."""

from __future__ import annotations

from datetime import date

from starloom.operators import dims, facts
from starloom.session import scratch_path
from starloom.sources.seed import seed_tables
from starloom.streaming.incremental import fact_sales_batch_writer, start_fact_sales_stream


def test_stream_matches_batch(spark):
    t = seed_tables(spark)
    as_of = date(2024, 4, 1)
    d = {
        "dim_customer": dims.dim_customer(None, t["customers"], t["orders"], as_of).checkpoint(),
        "dim_product": dims.dim_product(None, t["products"], t["suppliers"], as_of).checkpoint(),
        "dim_store": dims.dim_store(None, t["stores"]).checkpoint(),
        "dim_promotion": dims.dim_promotion(None, t["promotions"]).checkpoint(),
    }
    root = scratch_path(spark, "stream")
    items = t["order_items"]
    # two arrivals of whole orders, one file each (one micro-batch each)
    items.where("order_id <= 'ORD007'").coalesce(1).write.parquet(f"{root}/in/part1")
    items.where("order_id > 'ORD007'").coalesce(1).write.parquet(f"{root}/in/part2")
    q = start_fact_sales_stream(spark, f"{root}/in/*", t, d, f"{root}/fact", f"{root}/ckpt",
                                max_files_per_trigger=1)
    q.awaitTermination(300)
    out = spark.read.parquet(f"{root}/fact")
    assert out.count() == 25
    assert out.select("sales_key").distinct().count() == 25
    batch = facts.fact_sales(items, t["orders"], t["products"], t["promotions"],
                             d["dim_customer"], d["dim_product"], d["dim_store"], d["dim_promotion"])
    cols = [c for c in batch.columns if c != "sales_key"]
    got, want = set(out.select(*cols).collect()), set(batch.select(*cols).collect())
    assert got == want, (sorted(got - want)[:2], sorted(want - got)[:2])

    # replaying batch 0 overwrites its own partition instead of appending again
    writer = fact_sales_batch_writer(t, d, f"{root}/fact")
    writer(spark.read.parquet(f"{root}/in/part1"), 0)
    assert spark.read.parquet(f"{root}/fact").count() == 25
