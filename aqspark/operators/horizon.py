"""Supervised horizon frames, temporal splits, folds and even sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W
from pyspark.sql import types as T

from aqspark import spec as S
from aqspark.operators import blocks as B
from aqspark.spec import ObsSpec

OFFSET, TARGET = "timestamp_offset", "target_aqi"
# Columns a model must not see
LEAKAGE = ("aqi", "target_aqi", "timestamp", "city", "aqi_diff_1h", "aqi_diff_3h", "aqi_pct_1h")


NEXT = "_next"


def horizon_arrays(df: DataFrame, spec: ObsSpec, hours: int = S.HORIZON) -> DataFrame:
    """Each row with the known target values of the next ``hours`` rows, as an array of (h, v).

    One window, before any expansion. Missing values keep their position h and are then left out.
    """
    value = F.col(spec.target)

    def build(w):
        return {NEXT: F.collect_list(F.struct(value.alias("v"))).over(w.rowsBetween(1, hours))}

    near = B.windowed(df, spec, build, before=0, after=hours)
    numbered = F.transform(NEXT, lambda e, i: F.struct((i + 1).cast("int").alias("h"), e["v"].alias("v")))
    return near.withColumn(NEXT, F.filter(numbered, lambda e: e["v"].isNotNull()))


def expand_horizons(df: DataFrame, index: str | None = None) -> DataFrame:
    """One row per array entry; a narrow step. ``index`` names a column with the number of the first entry."""
    rest = [c for c in df.columns if c not in (NEXT, index)]
    out = df.select(*rest, *([index] if index else []), F.posexplode(NEXT).alias("_k", "_e"))
    number = [(F.col(index) + F.col("_k")).alias(index)] if index else []
    return out.select(*rest, F.col("_e.h").alias(OFFSET), F.col("_e.v").alias(TARGET), *number)


def horizon_targets(df: DataFrame, spec: ObsSpec, hours: int = S.HORIZON) -> DataFrame:
    """One row per observation and horizon h: the target value h rows ahead in the entity.

    The expansion comes after the only window, so the expanded frame is never shuffled or sorted.
    """
    return expand_horizons(horizon_arrays(df, spec, hours))


def horizon_targets_time(df: DataFrame, spec: ObsSpec, hours: int = S.HORIZON) -> DataFrame:
    """Like :func:`horizon_targets`, but the target is the value at the very hour ``time + h``.

    Groups are (entity, calendar bucket, phase): only readings whose clocks differ by whole hours can meet, so the frame of a row
    holds a reading an hour at most, at any sensor rate (more only where an instant is repeated). Readings of the first ``hours`` hours of a bucket
    are copied into the bucket before it, so each group holds all the readings its rows look at.
    """
    days = -(-hours // 24)
    wide = spec.with_(bucket_days=max(spec.bucket_days, days))
    bucket, edge = B.calendar_bucket(wide), F.date_sub(F.col(spec.time).cast("date"), days)
    before = B.calendar_bucket(wide.with_(time="_edge"))
    copies = F.when(before < bucket, F.array(bucket, before)).otherwise(F.array(bucket))
    since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(spec.time))
    hour = F.lit(3_600_000_000)
    placed = (
        df.withColumns({"_phase": F.pmod(since, hour), "_hour": F.floor(since / hour), "_edge": edge})
        .withColumn("_g", F.explode(copies))
        .withColumn("_own", F.col("_g") == bucket)
        .repartition(spec.entity, "_g", "_phase")
    )
    ahead = W.partitionBy(spec.entity, "_g", "_phase").orderBy("_hour").rangeBetween(1, hours)
    found = F.collect_list(F.struct(F.col("_hour").alias("at"), F.col(spec.target).alias("v"))).over(ahead)
    rows = placed.withColumn(NEXT, found).where("_own")
    known = F.filter(NEXT, lambda e: e["v"].isNotNull())
    numbered = F.transform(known, lambda e: F.struct((e["at"] - F.col("_hour")).cast("int").alias("h"), e["v"].alias("v")))
    return expand_horizons(rows.withColumn(NEXT, numbered).select(*df.columns, NEXT))


def feature_columns(df: DataFrame, target: str = TARGET, spec: ObsSpec = ObsSpec()) -> list[str]:
    """Numeric model inputs in schema order, without leakage."""
    excluded = {*LEAKAGE, target, spec.target, spec.entity, spec.time}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in excluded]


def _then(df: DataFrame) -> list[str]:
    return [OFFSET] if OFFSET in df.columns else []


def temporal_split(
    df: DataFrame, spec: ObsSpec, test_fraction: float = S.TEST_FRACTION, mode: str = "position", cut=None
) -> DataFrame:
    """Add ``split`` = train / test.

    ``position``: the first part of the rows in (entity, time, offset) order trains; with several
    entities that separates entities. ``time``: rows before ``cut`` (a timestamp literal) train.
    """
    if mode == "time":
        before = F.col(spec.time) < F.lit(cut).cast("timestamp_ntz")
        return df.withColumn("split", F.when(before, "train").otherwise("test"))
    if mode != "position":
        raise ValueError(f"unknown mode {mode!r}")
    indexed = B.with_global_index(df, spec, _then(df))
    first_test = F.floor(F.col("_n") * F.lit(1 - test_fraction))
    label = F.when(F.col("_idx") < first_test, "train").otherwise("test")
    return indexed.withColumn("split", label).drop("_idx", "_n")


def sample_hit(i: Column, n: Column, max_rows: int) -> Column:
    """The number k of the sample row that index ``i`` is, or null: kept indices are ``trunc(k * step)``,
    and a row tells by itself whether some k hits it. Frames no longer than ``max_rows`` are kept whole."""
    if max_rows == 1:
        return F.when(i == 0, F.lit(0).cast("long"))
    step = (n - 1) / F.lit(float(max_rows - 1))
    near = F.round(i / F.nullif(step, F.lit(0.0)))
    hits = F.filter(
        F.array(*[near + d for d in (-1, 0, 1)]),
        lambda k: (k >= 0) & (k <= max_rows - 1) & (F.floor(k * step) == i),
    )
    return F.when(n <= max_rows, i).when(i == n - 1, F.lit(max_rows - 1)).otherwise(F.get(hits, F.lit(0)).cast("long"))


def even_sample(df: DataFrame, spec: ObsSpec, max_rows: int = S.MAX_CV_ROWS) -> DataFrame:
    """At most ``max_rows`` rows spread evenly over the ordered frame, both ends included."""
    indexed = B.with_global_index(df, spec, _then(df))
    return indexed.where(sample_hit(F.col("_idx"), F.col("_n"), max_rows).isNotNull()).drop("_idx", "_n")


def expanding_members(i: Column, n: Column, folds: int, rows_per_fold: int) -> Column:
    """Array of (fold, role) in which row ``i`` of ``n`` takes part."""
    splits = F.least(F.lit(folds), F.greatest(F.lit(2), F.floor(n / F.lit(rows_per_fold)))).cast("int")
    size = F.floor(n / (splits + 1))

    def member(f):
        start = n - (splits - f) * size
        role = F.when(i < start, "train").when(i < start + size, "test")
        return F.struct(f.cast("int").alias("fold"), role.alias("role"))

    members = F.transform(F.sequence(F.lit(0), splits - 1), member)
    return F.filter(members, lambda m: m["role"].isNotNull())


def time_series_folds(df: DataFrame, spec: ObsSpec, folds: int = S.CV_FOLDS, rows_per_fold: int = 5000) -> DataFrame:
    """(row, fold, role): expanding train sets, equal test sets at the end, in order."""
    indexed = B.with_global_index(df, spec, _then(df))
    members = expanding_members(F.col("_idx"), F.col("_n"), folds, rows_per_fold)
    return indexed.withColumn("_m", F.explode(members)).select(*df.columns, "_m.fold", "_m.role")


def contiguous_fold(i: Column, n: Column, folds: int) -> Column:
    small = F.floor(n / F.lit(folds))
    longer = n % folds
    edge = longer * (small + 1)
    late = longer + F.floor((i - edge) / F.greatest(small, F.lit(1)))
    return F.when(i < edge, F.floor(i / (small + 1))).otherwise(late).cast("int")


def contiguous_folds(df: DataFrame, spec: ObsSpec, folds: int = 3) -> DataFrame:
    """Add ``fold``: unshuffled runs of equal length, the first ``n mod folds`` one row longer."""
    indexed = B.with_global_index(df, spec, _then(df))
    return indexed.withColumn("fold", contiguous_fold(F.col("_idx"), F.col("_n"), folds)).drop("_idx", "_n")
