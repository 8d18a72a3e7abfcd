"""Micro-batch loading of the sales fact with Structured Streaming.

The reference loads facts with ``INSERT ... SELECT``. The same operator (``facts.fact_sales``)
runs here once per micro-batch of newly arrived order lines: ``readStream`` over a folder of
staging order-line files, ``foreachBatch`` builds the fact rows of that batch against the
current dimensions and writes them to the fact table.

Exactly-once effect: every batch writes its own ``load_batch=<id>`` partition with dynamic
partition overwrite, so a batch replayed after a failure replaces its earlier output instead
of appending twice. Sales keys are numbered on from the largest key of the earlier batches (which
no longer change), so they are dense and a replayed batch gets the same keys.

Each micro-batch must carry whole orders: the line number restarts per batch, like the
reference, whose load numbers the lines it sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.contracts import STAGING
from starloom.operators import facts
from starloom.operators.ranking import assign_surrogate_keys
from starloom.sources.tables import path_exists


def _last_key(spark: SparkSession, out_path: str, batch_id: int) -> int:
    """The largest sales key of the batches before this one (0 if there is none)."""
    if not path_exists(spark, out_path):
        return 0
    earlier = spark.read.parquet(out_path).where(F.col("load_batch") < batch_id)
    return earlier.agg(F.max("sales_key")).first()[0] or 0


def fact_sales_batch_writer(
    staging: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    out_path: str,
    tax_rate: str = facts.TAX_RATE,
):
    """The ``foreachBatch`` function: order lines of one batch -> fact rows -> own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = facts.fact_sales(
            batch, staging["orders"], staging["products"], staging["promotions"],
            dims["dim_customer"], dims["dim_product"], dims["dim_store"], dims["dim_promotion"],
            tax_rate=tax_rate,
        )
        rows = assign_surrogate_keys(
            rows.drop("sales_key"), ["order_id", "item_id"], "sales_key",
            start_after=_last_key(batch.sparkSession, out_path, batch_id), key_type="bigint")
        (rows.withColumn("load_batch", F.lit(batch_id))
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("load_batch")
         .parquet(out_path))

    return write


def start_fact_sales_stream(
    spark: SparkSession,
    order_items_dir: str,
    staging: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    out_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops (batch-style
    catch-up); otherwise it keeps running with the default micro-batch trigger."""
    reader = spark.readStream.schema(STAGING["order_items"].schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.parquet(order_items_dir)
    writer = (
        lines.writeStream.foreachBatch(fact_sales_batch_writer(staging, dims, out_path))
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
