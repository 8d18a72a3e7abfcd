"""Sharding by jump consistent hashing: a document's key and the number of shards alone decide its
shard, without a table of the ring. Appending a shard moves 1 / (shards + 1) of the keys, all of
them into the new one. DataFrame functions only.

The key's SHA-256 seeds the published generator (a 64-bit linear congruential step); each step is
the next number of shards at which the key would move, and the walk ends beyond the present one.

:func:`write_shards` sorts documents by (shard, key, size, checksum) in ranges and writes one folder
a shard; a small manifest gives each range's first slot, so slots are gapless from 0 in each
shard. Ranges are also cut by input partition, so that a key, a text or a shard that holds a
third of all rows is spread over many tasks; texts are shuffled once.

Defined cases: a null key is the key of an empty string; a null text has size 1 and the checksum of
no bytes; documents of one key (repeated rows, or null keys) share a shard and have slots of
their own; an empty table gives no rows; other columns are kept in the struct ``row``, whatever
their names.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import read
from starloom.session import delete_at_exit, scratch_path

SHARDS = 16
LAW = "key"
#: Fixed values of the published jump hash: the generator's factor, its modulus, and the shift of the
#: bits that are used.
FACTOR, MODULUS, SHIFT, RANGE = 2862933555777941757, 1 << 64, 1 << 33, 1 << 31
#: Steps that are unrolled. A walk takes ln(shards) + 0.6 steps on average; more than 128 have a
#: probability below 1e-60 for any number of shards, and such a key would raise.
STEPS = 128


def key_seed(key: Column) -> Column:
    """The first 64 bits of the key's SHA-256 as an unsigned number."""
    digest = F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")


def jump(seed: Column, shards: int) -> Column:
    """struct(shard, grown_shard): the shard among ``shards``, and among one more."""
    if not 1 <= shards < RANGE:
        raise ValueError("shards must lie in 1 .. 2^31 - 1")
    following = lambda k: ((k * F.lit(FACTOR) + 1) % F.lit(Decimal(MODULUS))).cast("decimal(20,0)")

    def step(at: Column, _: Column) -> Column:
        bits = F.floor(at["k"] / F.lit(SHIFT)).cast("double")
        onward = F.floor((at["next"] + 1) * (F.lit(float(RANGE)) / (bits + 1.0))).cast("bigint")
        return F.when(at["next"] >= shards, at).otherwise(F.struct(
            at["next"].alias("shard"), onward.alias("next"), following(at["k"]).alias("k")))

    start = F.struct(F.lit(-1).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("next"), following(seed).alias("k"))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, STEPS))), start, step, lambda at: F.when(
        at["next"] >= shards, F.struct(
            at["shard"].cast("int").alias("shard"),
            F.when(at["next"] == shards, F.lit(shards)).otherwise(at["shard"]).cast("int").alias("grown_shard"))).otherwise(
        F.raise_error(F.lit("a jump walk took too many steps")).cast("struct<shard:int,grown_shard:int>")))
    return walk


def placed(documents: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """(row, size, text_crc32, shard, grown_shard): each document as the struct ``row``."""
    text = F.coalesce(documents["text"], F.lit(""))
    return documents.select(
        F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        jump(key_seed(documents[f"`{key}`"]), shards).alias("to")).select(
        "row", "size", "text_crc32", "to.shard", "to.grown_shard")


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id") -> None:
    """Write ``<path>/rows/shard=<k>`` (the rows of :func:`placed` and their place ``at``),
    ``<path>/schema`` (an empty table of their columns, since a store without rows has none) and
    ``<path>/manifest`` (shard, range, first place, first slot, rows)."""
    spark = documents.sparkSession
    order = ["shard", F.col(f"row.`{key}`"), "size", "text_crc32", "part"]
    rows = placed(documents, shards, key).withColumn("part", F.spark_partition_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("part")
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    rows.write.partitionBy("shard").parquet(f"{path}/rows")
    spark.createDataFrame([], rows.schema).write.parquet(f"{path}/schema")
    _manifest(_rows(spark, path)).write.parquet(f"{path}/manifest")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")
    return found.withColumn("range", F.shiftright("at", 33))


def _manifest(rows: DataFrame) -> DataFrame:
    ranges = rows.groupBy("shard", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # a row for each range and shard: bounded by the number of partitions and shards
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("first_slot", F.coalesce(F.sum("n").over(before), F.lit(0)))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(row, size, text_crc32, shard, slot, grown_shard) of written shards. A filter on ``shard``
    reads its folder only."""
    manifest = spark.read.parquet(f"{path}/manifest").select("shard", "range", "first", "first_slot")
    return _rows(spark, path).join(F.broadcast(manifest), ["shard", "range"]).select(
        "row", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("at") - F.col("first")).alias("slot"), "grown_shard")


def moving(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows that one more shard takes."""
    return rows.where(F.col("grown_shard") == shards)


def op13_sharding(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    documents = read(spark, sf_dir, "documents")
    write_shards(documents, path, SHARDS)
    delete_at_exit(spark, path)
    return read_shards(spark, path).select(
        "row.doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")


def _sql_walk() -> str:
    """One step of the walk a table: b, the shard so far; j, the next; k, the generator."""
    out = []
    for i in range(1, SHARDS + 1):
        out.append(f"""w{i} AS (
  SELECT * REPLACE (CASE WHEN j >= {SHARDS} THEN b ELSE j END AS b,
    CASE WHEN j >= {SHARDS} THEN j ELSE floor((j + 1) * ({RANGE}::DOUBLE / ((k // {SHIFT})::DOUBLE + 1)))::BIGINT END AS j,
    CASE WHEN j >= {SHARDS} THEN k ELSE (k * {FACTOR} + 1) % {MODULUS} END AS k) FROM w{i - 1})""")
    return ",\n".join(out)


#: crc32 by a table of 256 entries over the bytes of each text.
SQL = f"""
WITH RECURSIVE c(i, k, v) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM c WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tb FROM c WHERE k = 8),
d AS (
  SELECT doc_id, strlen(t)::BIGINT + 1 AS size,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda a, x: xor(a >> 8, tb[(xor(a, x) & 255) + 1]))) AS text_crc32,
         ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS seed
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents), crc),
w0 AS (SELECT doc_id, size, text_crc32, (-1)::BIGINT AS b, 0::BIGINT AS j, (seed * {FACTOR} + 1) % {MODULUS} AS k FROM d),
{_sql_walk()}
SELECT doc_id, size, text_crc32, '{LAW}' AS law, b::INT AS shard,
       row_number() OVER (PARTITION BY b ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       (CASE WHEN j = {SHARDS} THEN {SHARDS} ELSE b END)::INT AS grown_shard
FROM w{SHARDS}
"""
