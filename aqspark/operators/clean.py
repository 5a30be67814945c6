"""Deduplication, filtering, gap filling, outlier capping."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, Window as W
from pyspark.sql import types as T

from aqspark import spec as S
from aqspark.functions import scalar as X
from aqspark.operators.blocks import BUCKET, by_group, calendar_bucket
from aqspark.operators.quantiles import quantiles_wide, with_parameters
from aqspark.spec import ObsSpec


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def keep_one(df: DataFrame, key: list[str], seq: str, which: str) -> DataFrame:
    """One row per key: the ``first`` or ``last`` to arrive. Map-side combining leaves at most one row
    per key and task, so many copies of one key do not meet in one task."""
    rest = [c for c in df.columns if c not in key]
    pick = {"first": F.min_by, "last": F.max_by}[which]
    row = pick(F.struct(*rest), F.struct(F.col(seq)))
    return df.groupBy(*key).agg(row.alias("_row")).select(*key, "_row.*").select(*df.columns)


def dedupe_first(df: DataFrame, spec: ObsSpec) -> DataFrame:
    if not spec.seq:
        raise ValueError("dedupe_first needs spec.seq, the arrival order")
    return keep_one(df, spec.key, spec.seq, "first")


def filter_entities(df: DataFrame, entities: list[str] | DataFrame, spec: ObsSpec) -> DataFrame:
    """Keep listed entities: a literal list, or a one-column frame for long lists."""
    if isinstance(entities, DataFrame):
        wanted = entities.select(F.col(entities.columns[0]).alias(spec.entity)).distinct()
        return df.join(wanted, spec.entity, "left_semi")
    return df.where(F.col(spec.entity).isin(list(entities)))


def drop_null_target(df: DataFrame, spec: ObsSpec) -> DataFrame:
    """NaN counts as missing; an empty result is for the job to notice."""
    return df.dropna(subset=[spec.target])


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def drop_incomplete_or_short(df: DataFrame, spec: ObsSpec) -> DataFrame:
    """Rows without nulls; of an entity that has none, because its series is shorter than a lag, all rows."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    known = [F.col(c).isNotNull() & ~F.isnan(c) if c in floating else F.col(c).isNotNull() for c in df.columns]
    flagged = df.withColumn("_whole", reduce(and_, known))
    any_whole = flagged.groupBy(spec.entity).agg(F.max("_whole").alias("_any"))
    return flagged.join(any_whole, spec.entity).where(F.col("_whole") | ~F.col("_any")).select(*df.columns)


def clip_target(df: DataFrame, spec: ObsSpec, low: float = S.AQI_MIN, high: float = S.AQI_MAX) -> DataFrame:
    return df.withColumn(spec.target, X.clip(spec.target, low, high))


def clean(df: DataFrame, spec: ObsSpec, entities: list[str] | DataFrame | None = None) -> DataFrame:
    """First row per key, listed entities, known target, target in range.

    The entity filter runs first: it tests a key column, so the outcome is the same and fewer rows move.
    """
    kept = df if entities is None else filter_entities(df, entities, spec)
    return clip_target(drop_null_target(dedupe_first(kept, spec), spec), spec)


def _order_value(spec: ObsSpec) -> Column:
    # a plain column keeps the aggregate hash-based; a struct would make it sort
    return F.col(spec.time) if len(spec.order) == 1 else F.struct(*spec.order)


def _carriers(cut: DataFrame, spec: ObsSpec, columns: list[str], forward: bool, backward: bool) -> DataFrame:
    """One row per (entity, bucket) with the values its leading gaps take (forward), or its trailing gaps
    (backward only)."""

    def known(c):
        return F.when(F.col(c).isNotNull(), _order_value(spec))

    ends = cut.groupBy(spec.entity, BUCKET).agg(
        *[F.max_by(c, known(c)).alias(f"_last_{c}") for c in columns],
        *[F.min_by(c, known(c)).alias(f"_first_{c}") for c in columns],
    )
    by_entity = W.partitionBy(spec.entity).orderBy(BUCKET)
    earlier = by_entity.rowsBetween(W.unboundedPreceding, -1)
    later = by_entity.rowsBetween(1, W.unboundedFollowing)
    whole = by_entity.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def value(c):
        if not forward:
            return F.first(f"_first_{c}", ignorenulls=True).over(later)
        before = F.last(f"_last_{c}", ignorenulls=True).over(earlier)
        return F.coalesce(before, F.first(f"_first_{c}", ignorenulls=True).over(whole)) if backward else before

    return ends.select(spec.entity, BUCKET, *[value(c).alias(c) for c in columns])


def fill(df: DataFrame, spec: ObsSpec, columns: list[str] | None = None, forward: bool = True, backward: bool = True) -> DataFrame:
    """Forward fill, then backward fill, per entity.

    A task sees one (entity, bucket). What reaches over a bucket's edge comes from one extra row per bucket
    that sorts ahead of the others and carries the value to start with: the last known one before the bucket,
    or, where there is none, the entity's first known one, which is all that is left for the backward fill.
    """
    columns = [c for c in (columns or numeric_columns(df)) if c not in spec.order]
    cut = df.withColumn(BUCKET, calendar_bucket(spec))
    heads = _carriers(cut, spec, columns, forward, backward).withColumn("_row", F.lit(0))
    both = by_group(cut.withColumn("_row", F.lit(1)).unionByName(heads, allowMissingColumns=True), spec, BUCKET)
    order = [F.col(c) if forward else F.col(c).desc() for c in spec.order]
    upto = W.partitionBy(spec.entity, BUCKET).orderBy("_row", *order).rowsBetween(W.unboundedPreceding, 0)
    held = {c: F.last(c, ignorenulls=True).over(upto) for c in columns}
    return both.withColumns(held).where(F.col("_row") == 1).select(*df.columns)


def forward_fill(df: DataFrame, spec: ObsSpec, columns: list[str] | None = None) -> DataFrame:
    return fill(df, spec, columns, forward=True, backward=False)


def backward_fill(df: DataFrame, spec: ObsSpec, columns: list[str] | None = None) -> DataFrame:
    return fill(df, spec, columns, forward=False, backward=True)


def medians(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    return quantiles_wide(df, {c: (c, 0.5) for c in columns}, by)


def median_impute(df: DataFrame, columns: list[str], by: list[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """Missing values become the column median of ``fit_on`` (by default of the frame itself)."""
    fitted = medians(fit_on if fit_on is not None else df, columns, by)
    joined, fit = with_parameters(df, fitted, by)
    filled = {c: F.coalesce(X.null_if_nan(F.col(c).cast("double")), fit[c]) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def impute(df: DataFrame, spec: ObsSpec, columns: list[str] | None = None) -> DataFrame:
    """Forward fill, backward fill, then the median of the filled frame for what an entity never reported."""
    columns = [c for c in (columns or numeric_columns(df)) if c not in spec.order]
    return median_impute(fill(df, spec, columns), columns)


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from one pass; NaN counts as null."""
    fields = df.schema.fields

    def missing(f):
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        return F.col(f.name).isNull() | F.isnan(f.name) if floating else F.col(f.name).isNull()

    counted = df.agg(*[F.count_if(missing(f)).alias(f.name) for f in fields])
    cells = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("nulls")) for f in fields])
    return counted.select(F.explode(cells).alias("c")).select("c.*")


def iqr_fences(df: DataFrame, columns: list[str], by: list[str] = (), reach: float = 1.5) -> DataFrame:
    """``<c>_q1, <c>_q3, <c>_low, <c>_high`` per column; one row, or one per group."""
    names = {f"{c}_{q}": (c, p) for c in columns for q, p in (("q1", 0.25), ("q3", 0.75))}
    quartiles = quantiles_wide(df, names, by)
    fences = {}
    for c in columns:
        iqr = F.col(f"{c}_q3") - F.col(f"{c}_q1")
        fences[f"{c}_low"] = F.col(f"{c}_q1") - reach * iqr
        fences[f"{c}_high"] = F.col(f"{c}_q3") + reach * iqr
    return quartiles.withColumns(fences)


def winsorise(
    df: DataFrame,
    columns: list[str] | None = None,
    by: list[str] = (),
    fit_on: DataFrame | None = None,
    count_as: str | None = None,
) -> DataFrame:
    """Cap values at the fences of ``fit_on`` (by default the frame itself); no row is dropped.
    ``count_as`` names a column that tells how many values of the row were capped."""
    columns = [c for c in (columns or S.WINSORISED) if c in df.columns]
    fences = iqr_fences(fit_on if fit_on is not None else df, columns, by)
    joined, fit = with_parameters(df, fences, by)
    out = {c: X.clip(F.col(c).cast("double"), fit[f"{c}_low"], fit[f"{c}_high"]) for c in columns}
    if count_as:
        outside = [(F.col(c) < fit[f"{c}_low"]) | (F.col(c) > fit[f"{c}_high"]) for c in columns]
        out[count_as] = sum((F.when(o, 1).otherwise(0) for o in outside), F.lit(0))
    return joined.withColumns(out).select(*df.columns, *([count_as] if count_as else []))
