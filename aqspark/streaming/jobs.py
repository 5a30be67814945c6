"""Structured Streaming jobs over hourly readings. Each runs over what has arrived and stops (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from aqspark.operators import features as Ft
from aqspark.operators.forecast import last_n
from aqspark.sources import store as St
from aqspark.sources.staging import stage
from aqspark.spec import ObsSpec


def _run(stream: DataFrame, checkpoint: str, each, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(each)
        .start()
    )


def stream_ingest(stream: DataFrame, path: str, checkpoint: str, spec: ObsSpec, delay: str = "2 hours", trigger: dict | None = None) -> StreamingQuery:
    """Append readings to parquet, dropping repeats of a key that arrive within ``delay`` of each other and
    rows older than that. State holds the keys of that span only."""
    zoned = stream.withColumn(spec.time, F.col(spec.time).cast("timestamp")).withWatermark(spec.time, delay)
    once = zoned.dropDuplicatesWithinWatermark(spec.key)
    return (
        once.withColumn(spec.time, F.col(spec.time).cast("timestamp_ntz"))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_upsert(stream: DataFrame, path: str, checkpoint: str, spec: ObsSpec, shards: int = 4, trigger: dict | None = None) -> StreamingQuery:
    """Upsert each micro-batch by key. A batch that is run again after a failure changes nothing."""

    def each(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            St.upsert_features(path, batch, spec, shards)

    return _run(stream, checkpoint, each, trigger=trigger)


def _context(spark: SparkSession, path: str, since: DataFrame, spec: ObsSpec, shards: int, lookback_days: int) -> DataFrame:
    """Rows from each entity's ``_since`` on, and the rows before it that features can reach.

    Each shard has its own first month: only shards of entities with new rows are read, from ``lookback_days`` before their earliest one on. Older months
    are read only for the shards of entities that do not have enough rows there.
    """
    reach = Ft.feature_reach()
    table = spark.read.parquet(path)
    month, shard = F.col(St.MONTH).cast("string"), F.col(St.SHARD).cast("int")
    first = F.date_format(F.min("_since") - F.make_dt_interval(days=F.lit(lookback_days)), "yyyy-MM").alias("first")
    own = St.partition_columns(spec, shards)[St.SHARD].alias("own")
    edges = {r["own"]: r["first"] for r in since.groupBy(own).agg(first).collect()}  # a row per shard
    edge = F.create_map(*[F.lit(x) for pair in edges.items() for x in pair])[shard]
    near = table.where(month >= edge).join(since, spec.entity)
    enough = near.groupBy(spec.entity).agg(F.count_if(F.col(spec.time) < F.col("_since")).alias("_before"))
    short = stage(
        since.join(enough, spec.entity, "left").where(F.coalesce("_before", F.lit(0)) < reach).drop("_before"), "short"
    )
    far_shards = [r[0] for r in short.select(own).distinct().collect()]
    rows = near
    if far_shards:
        older = table.where((month < edge) & shard.isin(far_shards))
        rows = near.unionByName(older.join(short, spec.entity))
    rows = rows.drop(St.MONTH, St.SHARD)
    before = last_n(rows.where(F.col(spec.time) < F.col("_since")), spec.with_(seq=None), reach)
    return rows.where(F.col(spec.time) >= F.col("_since")).unionByName(before)


def stream_features(
    stream: DataFrame, observations: str, features: str, checkpoint: str, spec: ObsSpec, shards: int = 4,
    lookback_days: int = 120, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the feature table equal to a batch run over all readings so far, late ones included.

    A batch is upserted into the observation table; then the features of every row from the entity's earliest
    new reading on are computed again, with the same block windows as in batch, and upserted. No per-entity
    state is kept in a single task, so a busy entity is split like in batch.
    """

    def each(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        # rows of this batch are at hand again for the three uses below
        new = stage(batch, "batch")
        St.upsert_features(observations, new, spec, shards, zero_fill=False)  # an unknown reading stays unknown in later windows
        since = stage(new.where(F.col(spec.time).isNotNull() & F.col(spec.entity).isNotNull()).groupBy(spec.entity).agg(F.min(spec.time).alias("_since")), "since")
        if since.isEmpty():
            return
        context = _context(spark, observations, since, spec, shards, lookback_days)
        rows = Ft.all_features(context, spec.with_(seq=None))
        # upsert_features stages its input before it writes
        St.upsert_features(features, rows.where(F.col(spec.time) >= F.col("_since")).drop("_since"), spec.with_(seq=None), shards)

    return _run(stream, checkpoint, each, trigger=trigger)


def stream_daily(stream: DataFrame, path: str, checkpoint: str, spec: ObsSpec, delay: str = "2 hours", shards: int = 4, trigger: dict | None = None) -> StreamingQuery:
    """(entity, day, rows, mean, max, min) per calendar day, kept up to date by upsert."""
    zoned = stream.withColumn("_at", F.col(spec.time).cast("timestamp")).withWatermark("_at", delay)
    v = F.col(spec.target)
    daily = zoned.groupBy(spec.entity, F.window("_at", "1 day").alias("w")).agg(
        F.count("*").alias("rows"), F.avg(v).alias("aqi_mean"), F.max(v).alias("aqi_max"), F.min(v).alias("aqi_min")
    )
    flat = daily.select(
        spec.entity, F.col("w.start").cast("timestamp_ntz").alias(spec.time), "rows", "aqi_mean", "aqi_max", "aqi_min"
    )

    def each(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            St.upsert_features(path, batch, spec.with_(seq=None), shards, zero_fill=False)  # a day without readings stays unknown

    return _run(flat, checkpoint, each, mode="update", trigger=trigger)


def batch_daily(df: DataFrame, spec: ObsSpec) -> DataFrame:
    """The table :func:`stream_daily` converges to."""
    v = F.col(spec.target)
    day = F.date_trunc("day", F.col(spec.time)).cast("timestamp_ntz")
    return df.groupBy(spec.entity, day.alias(spec.time)).agg(
        F.count("*").alias("rows"), F.avg(v).alias("aqi_mean"), F.max(v).alias("aqi_max"), F.min(v).alias("aqi_min")
    )


