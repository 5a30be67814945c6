"""The keyed feature table: preparation, upsert, snapshots, and the reads built on it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from aqspark import spec as S
from aqspark.functions import scalar as X
from aqspark.operators.clean import keep_one
from aqspark.operators.forecast import last_n
from aqspark.sources.staging import stage
from aqspark.spec import ObsSpec

MONTH, SHARD = "month_key", "shard"


def prepare_for_store(df: DataFrame, spec: ObsSpec, zero_fill: bool = True) -> DataFrame:
    """Lower-case names with underscores, zone-less UTC time, complete keys, finite numbers (else 0, or null without ``zero_fill``)."""
    out = df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])
    if isinstance(out.schema[spec.time].dataType, T.TimestampType):
        out = out.withColumn(spec.time, F.to_utc_timestamp(spec.time, F.current_timezone()).cast("timestamp_ntz"))
    floating = [f.name for f in out.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    out = out.dropna(subset=spec.key).withColumns({c: X.null_if_not_finite(c) for c in floating})
    if not zero_fill:
        return out
    numeric = [f.name for f in out.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in spec.key]
    return out.fillna(0, subset=numeric)


def partition_columns(spec: ObsSpec, shards: int) -> dict[str, Column]:
    """Month, then a hash shard of the entity. A folder per entity would be millions of folders."""
    return {
        MONTH: F.date_format(spec.time, "yyyy-MM"),
        SHARD: F.pmod(F.xxhash64(spec.entity), F.lit(shards)).cast("int"),
    }


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def _read(spark: SparkSession, path: str) -> DataFrame:
    """All columns that any file of the table has, so that one added by a later upsert is neither hidden nor lost."""
    return spark.read.option("mergeSchema", True).parquet(path)


def _by_folder(df: DataFrame) -> DataFrame:
    """Rows of a folder meet in few tasks, so files don't grow as tasks times folders; adaptive execution splits large folders."""
    return df.hint("rebalance", F.col(MONTH), F.col(SHARD))


def write_processed(df: DataFrame, path: str, spec: ObsSpec, shards: int = 4, mode: str = "overwrite") -> None:
    """Rows of one partition are spread over several files when there are many (``maxRecordsPerFile``)."""
    (
        _by_folder(df.withColumns(partition_columns(spec, shards)))
        .write.mode(mode)
        .option("maxRecordsPerFile", 5_000_000)
        .partitionBy(MONTH, SHARD)
        .parquet(path)
    )


def merged(existing: DataFrame, incoming: DataFrame, spec: ObsSpec) -> DataFrame:
    """The table after an upsert, as a frame: incoming rows win over existing ones, later ones over earlier."""
    arrival = F.col(spec.seq).cast("long") if spec.seq and spec.seq in incoming.columns else F.lit(0).cast("long")
    old = existing.withColumn("_arrival", F.struct(F.lit(0).alias("r"), F.lit(0).cast("long").alias("s")))
    new = incoming.withColumn("_arrival", F.struct(F.lit(1).alias("r"), arrival.alias("s")))
    both = old.unionByName(new, allowMissingColumns=True)
    return keep_one(both, spec.key, "_arrival", "last").drop("_arrival")


def upsert_features(path: str, incoming: DataFrame, spec: ObsSpec, shards: int = 4, zero_fill: bool = True) -> DataFrame:
    """Insert or replace rows by (entity, time) and return the table.

    Only partitions with incoming rows are read and rewritten; the merged rows are staged first, so no path
    is overwritten while it is read. Doing it again with the same rows changes nothing, so a batch may be retried.
    Folders are replaced one after another: one writer at a time, and no reader while it writes (readers that can't wait read snapshots).
    """
    spark = incoming.sparkSession
    batch = stage(prepare_for_store(incoming, spec, zero_fill).withColumns(partition_columns(spec, shards)), "upsert")
    if _exists(spark, path):
        # at most one row per partition folder; the two lists prune the scan, the join picks the pairs
        touched = stage(batch.select(MONTH, SHARD).distinct(), "touched")
        lists = touched.agg(F.collect_set(MONTH).alias("m"), F.collect_set(SHARD).alias("s")).first()
        table = _read(spark, path)
        table = table.withColumns({MONTH: F.col(MONTH).cast("string"), SHARD: F.col(SHARD).cast("int")})
        pruned = table.where(F.col(MONTH).isin(lists["m"]) & F.col(SHARD).isin(lists["s"]))
        old = pruned.join(F.broadcast(touched), [MONTH, SHARD], "left_semi")
        result = merged(old, batch, spec)
    else:
        result = merged(batch.limit(0), batch, spec)
    staged = stage(result, "merged")
    (
        _by_folder(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 5_000_000)
        .partitionBy(MONTH, SHARD)
        .parquet(path)
    )
    return read_features(spark, path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path).drop(MONTH, SHARD)


def open_features(spark: SparkSession, path: str) -> DataFrame:
    """The table with its partition columns, by which ``training_window`` and ``latest_features`` prune what they read."""
    table = _read(spark, path)
    return table.withColumns({MONTH: F.col(MONTH).cast("string"), SHARD: F.col(SHARD).cast("int")})


def training_window(df: DataFrame, as_of: str, spec: ObsSpec, days: int = S.TRAINING_DAYS, fallback_all: bool = True) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` and later; if there are none, all rows
    (unless ``fallback_all`` is off). The choice hangs on one maximum, found without a second copy of the rows.

    Of a frame from ``open_features`` only the months from the first day on are read, for the maximum too.
    """
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days))
    recent = F.col(spec.time) >= start
    if MONTH not in df.columns:
        if not fallback_all:
            return df.where(recent)
        newest = df.agg(F.max(spec.time)).scalar()
        return df.where(recent | (newest < start))
    month = F.col(MONTH) >= F.date_format(start, "yyyy-MM")
    if fallback_all:
        none = df.where(month & recent).agg(F.max(spec.time)).scalar().isNull()
        month, recent = month | none, recent | none
    return df.where(month & recent).drop(MONTH, SHARD)


def rows_of_entity(df: DataFrame, spec: ObsSpec, entity: str, n: int, shards: int = 4) -> DataFrame:
    """Rows of one entity, its last ``n`` at least. In a frame from ``open_features`` only its shard (``shards`` as written) is
    read, and of that only the last months that hold ``n`` of its rows, which are counted first."""
    own = F.col(spec.entity) == entity
    if SHARD in df.columns:
        own &= F.col(SHARD) == F.pmod(F.xxhash64(F.lit(entity).cast(df.schema[spec.entity].dataType)), F.lit(shards)).cast("int")
        counts = df.where(own).groupBy(MONTH).agg(F.count("*").alias("_n"))  # a row per month
        later = F.sum("_n").over(Window.orderBy(F.desc(MONTH)))
        first = counts.withColumn("_later", later).where(F.col("_later") >= n).agg(F.max(MONTH)).scalar()
        own &= F.col(MONTH) >= F.coalesce(first, F.lit(""))
    return df.where(own)


def latest_features(df: DataFrame, spec: ObsSpec, n: int = 48, entity: str | None = None, shards: int = 4) -> DataFrame:
    """The last ``n`` rows of one entity, or of every entity."""
    if entity is None:
        return last_n(df.drop(MONTH, SHARD), spec, n)
    newest_first = [F.col(c).desc() for c in spec.order]
    return rows_of_entity(df, spec, entity, n, shards).drop(MONTH, SHARD).orderBy(*newest_first).limit(n)


def latest_snapshot(df: DataFrame, version: str = "version") -> DataFrame:
    """Rows of the newest version; as a partition column it is pruned at the scan."""
    return df.where(F.col(version) == df.agg(F.max(version)).scalar())


def write_snapshot(df: DataFrame, root: str, version: int) -> None:
    df.write.mode("errorifexists").parquet(f"{root}/version={version}")
