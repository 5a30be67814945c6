"""Two-pass external shuffle into shards, with DataFrame functions alone.

Pass one scatters rows evenly into buckets that fit in a task's memory, by a seeded hash; each bucket is then put into random order by the
Fisher-Yates method (which is what ``shuffle`` does to an array) and written. Pass two gives each bucket its place after the buckets before it and cuts
the whole order into shards whose row counts differ by at most one (law ``rows``).

The hash takes the id and the row's position in the scan, so repeated rows and ids spread over all buckets as well. What pass one
wrote is read by pass two, so a task that runs again later moves no row. The order is fixed by the seed and the table's scan (its files and their splits). Nulls, empty texts and very long texts are rows like others;
an empty table gives empty shards. All columns are kept under ``row``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from aqspark.llm.common import new_path, small_side, stage_compact

SHARDS, SEED = 16, 42
#: A bucket is one array in a task. The longest texts come on top of this mean.
BUCKET_BYTES = 16 << 20
#: So many buckets for each shard at least, so that small tables use all tasks too.
BUCKETS_PER_SHARD = 16
#: Buckets of one task; it holds all of them when it collects their rows.
BUCKETS_PER_TASK = 4


def shuffled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``row`` (all columns of ``docs``), ``shard`` and ``slot``, the place in the shard from 0."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    buckets = max(shards * BUCKETS_PER_SHARD, -(-size // bucket_bytes))
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
    scattered = rows.select(F.pmod(F.xxhash64(F.lit(seed), F.col(f"row.`{doc_id}`"), "at"), F.lit(buckets)).cast("int").alias("bucket"), "at", "row")
    # few buckets in a task, in the order of the scan, so that the seed fixes the order
    each = scattered.repartition(-(-buckets // BUCKETS_PER_TASK), "bucket").groupBy("bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))), lambda x: x["row"]).alias("all"))
    mixed_up = each.select("bucket", F.posexplode(F.shuffle("all", seed)).alias("at", "row"))
    written = stage_compact(mixed_up, "buckets")
    return _cut(written, shards)


def _cut(written: DataFrame, shards: int) -> DataFrame:
    # one row per bucket: their number is bounded by the bytes over BUCKET_BYTES
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    before = counts.select("bucket", (F.sum("n").over(W.orderBy("bucket")) - F.col("n")).alias("before"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    place = F.col("before") + F.col("at")
    shard = F.expr(f"(before + at) * {shards} div {max(total, 1)}")
    cut = written.join(small_side(before), "bucket").select("row", place.alias("place"), shard.cast("int").alias("shard"))
    first = F.expr(f"(CAST(shard AS LONG) * {total} + {shards - 1}) div {shards}")
    return cut.select("row", "shard", (F.col("place") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str | None = None, **options) -> tuple[str, DataFrame]:
    """Write the shards as Parquet folders ``shard=K``; returns the path and the table read back."""
    spark = docs.sparkSession
    path = path or new_path(spark, "shards")
    cut = shuffled(docs, **options)
    cut.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return path, spark.read.schema(cut.schema).parquet(path)
