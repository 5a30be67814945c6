"""Reading observation tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from aqspark import spec as S
from aqspark.functions import scalar as X
from aqspark.operators.clean import keep_one
from aqspark.spec import ObsSpec

OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("city", T.StringType()),
        T.StructField("aqi", T.DoubleType()),
        *[T.StructField(c, T.DoubleType()) for c in (*S.POLLUTANTS, *S.WEATHER)],
    ]
)


def normalise(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Floating NaN to null, and a string time to a zone-less timestamp (unreadable text to null)."""
    out = {
        f.name: X.null_if_nan(f.name)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    if time in df.columns and isinstance(df.schema[time].dataType, T.StringType):
        out[time] = F.try_to_timestamp(F.col(time)).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def read_observations(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, time: str = "timestamp"
) -> DataFrame:
    """CSV columns are matched by the header's names, with types from ``schema``; no inference pass.

    Columns that a file does not have are left out. Files with another order of columns than the first are an error.
    """
    if fmt == "parquet":
        return normalise(spark.read.parquet(path), time)
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    wanted = schema or OBSERVATION_SCHEMA
    header = spark.read.csv(path, header=True).columns  # reads the first line only
    known = {f.name: f for f in wanted.fields}
    fields = [known.get(c, T.StructField(c, T.StringType())) for c in header]
    return normalise(spark.read.csv(path, header=True, schema=T.StructType(fields), enforceSchema=False), time)


_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")


def source_priority(candidates: list) -> DataFrame:
    """The first source that can be read and is not empty. Each candidate is a frame, or a function that
    returns one and may fail. If none is left, that is an error."""
    problems = []
    for i, candidate in enumerate(candidates):
        try:
            df = candidate() if callable(candidate) else candidate
            if not df.isEmpty():
                return df
            problems.append(f"source {i} is empty")
        except (AnalysisException, FileNotFoundError) as e:  # only a source that isn't there gives way to the next
            if isinstance(e, AnalysisException) and e.getCondition() not in _MISSING:
                raise
            problems.append(f"source {i}: {type(e).__name__}: {str(e)[:200]}")
    raise ValueError("no source has data: " + "; ".join(problems))


def fresh_within_ttl(df: DataFrame, as_of, fetched_at: str = "fetched_at", ttl_seconds: int = S.CACHE_TTL_SECONDS) -> DataFrame:
    now = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return df.where(X.is_fresh(fetched_at, now, ttl_seconds))


def merge_history(existing: DataFrame, incoming: DataFrame, spec: ObsSpec) -> DataFrame:
    """Both sets of rows, the last to arrive per key; rows of ``incoming`` are later than all existing."""
    seq = F.col(spec.seq).cast("long") if spec.seq else F.lit(0).cast("long")

    def marked(df, rank):
        return df.withColumn("_arrival", F.struct(F.lit(rank).alias("rank"), seq.alias("seq")))

    both = marked(existing, 0).unionByName(marked(incoming, 1), allowMissingColumns=True)
    return keep_one(both, spec.key, "_arrival", "last").drop("_arrival")


def geocode_join(places: DataFrame, gazetteer: DataFrame, on: str, value_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) places. Of several entries with one name the first by ``value_columns`` is taken.

    The gazetteer is broadcast by Spark only if it is small enough.
    """
    one = gazetteer.groupBy(on).agg(F.min(F.struct(*value_columns)).alias("_g"))
    joined = places.join(one, on, "left")
    matched = joined.where(F.col("_g").isNotNull()).select(*places.columns, "_g.*")
    unmatched = joined.where(F.col("_g").isNull()).select(*places.columns)
    return matched, unmatched


def list_cities(df: DataFrame, spec: ObsSpec) -> DataFrame:
    return df.select(spec.entity).distinct()


def city_listing(df: DataFrame, spec: ObsSpec, default: str) -> DataFrame:
    """(entity, is_default, total)."""
    cities = list_cities(df, spec)
    total = cities.agg(F.count("*")).scalar()
    return cities.select(spec.entity, (F.col(spec.entity) == default).alias("is_default"), total.alias("total"))


