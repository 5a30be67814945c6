"""Row positions and bounded blocks for series of any length.

A window partitioned by entity alone puts a whole series in one task; an entity that holds a
third of the data would then never finish. Instead each row gets its exact position in its
series (counts per calendar bucket, a running sum of those counts, a row number inside the
bucket), positions are cut into blocks of fixed size, and each block receives copies of the few
rows before or after it that its windows reach. Windows run per (entity, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from aqspark.sources.staging import stage
from aqspark.spec import ObsSpec

POS, BLOCK, OWN, BUCKET, SUB = "_pos", "_block", "_own", "_bucket", "_sub"


def calendar_bucket(spec: ObsSpec) -> Column:
    """Number of the time bucket of a row. Buckets of part of a day are counted in seconds; rows of one instant share a bucket."""
    time = F.col(spec.time)
    days = F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date"))
    if float(spec.bucket_days).is_integer():
        return F.floor(days / F.lit(int(spec.bucket_days))).cast("int")
    seconds = days.cast("long") * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return F.floor(seconds / F.lit(spec.bucket_days * 86400)).cast("int")


def by_group(df: DataFrame, spec: ObsSpec, group: str) -> DataFrame:
    """Partition by (entity, group) before a window over that pair.

    The window would shuffle that way itself, unless the rows come partitioned by entity alone (after a join
    on it, say), which Spark would accept, and one task would get a whole series.
    """
    return df.repartition(spec.entity, group)


def _numbered(bucketed: DataFrame, starts: DataFrame, spec: ObsSpec, then: list[str], weight: str | None, out: str) -> DataFrame:
    """Give each row the start of its bucket plus what comes before it inside the bucket.

    The starts travel as one extra row per bucket that sorts ahead of the others: one shuffle and one
    sort, where a join would sort twice.
    """
    rows = bucketed.withColumns({"_row": F.lit(1), "_start": F.lit(None).cast("long")})
    heads = starts.select(spec.entity, BUCKET, F.col("_start").cast("long"), F.lit(0).alias("_row"))
    w = W.partitionBy(spec.entity, BUCKET).orderBy("_row", *spec.order, *then)
    if weight is None:
        inside = F.row_number().over(w) - 2
    else:
        inside = F.coalesce(F.sum(weight).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    both = by_group(rows.unionByName(heads, allowMissingColumns=True), spec, BUCKET)
    start = F.first("_start").over(w.rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn(out, start + inside).where(F.col("_row") == 1).drop("_row", "_start", BUCKET)


def with_position(df: DataFrame, spec: ObsSpec) -> DataFrame:
    """Add the 0-based position of each row in its entity, ordered by time then arrival.

    The count pass reads two columns; the running sum is over one row per entity and bucket.
    """
    bucketed = df.withColumn(BUCKET, calendar_bucket(spec))
    before = W.partitionBy(spec.entity).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy(spec.entity, BUCKET)
        .agg(F.count("*").alias("_n"))
        .select(spec.entity, BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return _numbered(bucketed, starts, spec, [], None, POS).select(*df.columns, POS)


def in_blocks(df: DataFrame, spec: ObsSpec, before: int, after: int = 0, heads: DataFrame | None = None) -> DataFrame:
    """Cut positioned rows into blocks; each block also holds ``before`` earlier and ``after`` later
    rows as copies (``_own`` false). A row has at most two copies besides its own.

    ``heads``: a row per (entity, block) with further columns, which joins its block at position -1."""
    size = max(spec.block_rows, before, after)
    block = F.floor(F.col(POS) / F.lit(size))
    local = F.col(POS) - block * size

    def to(offset: int) -> Column:
        return F.struct((block + offset).alias(BLOCK), F.lit(offset == 0).alias(OWN))

    ahead = (local >= size - before) if before else F.lit(False)
    behind = ((local < after) & (block > 0)) if after else F.lit(False)
    copies = (
        F.when(ahead & behind, F.array(to(0), to(1), to(-1)))
        .when(ahead, F.array(to(0), to(1)))
        .when(behind, F.array(to(0), to(-1)))
        .otherwise(F.array(to(0)))
    )
    exploded = df.withColumn("_copy", F.explode(copies)).select(*df.columns, f"_copy.{BLOCK}", f"_copy.{OWN}")
    if heads is not None:
        marked = heads.withColumns({POS: F.lit(-1).cast("long"), OWN: F.lit(False)})
        exploded = exploded.unionByName(marked, allowMissingColumns=True)
    return by_group(exploded, spec, BLOCK)


def block_window(spec: ObsSpec) -> W:
    return W.partitionBy(spec.entity, BLOCK).orderBy(POS)


def block_over(spec: ObsSpec, *lead: str) -> str:
    """The same window as SQL text, optionally ordered by further columns first."""
    return f"PARTITION BY `{spec.entity}`, {BLOCK} ORDER BY {', '.join([*lead, POS])}"


def windowed(df: DataFrame, spec: ObsSpec, build, before: int, after: int = 0) -> DataFrame:
    """Add columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``build(window)`` returns a dict of column expressions over the given window spec.
    """
    blocks = in_blocks(with_position(df, spec), spec, before, after)
    return blocks.withColumns(build(block_window(spec))).where(OWN).drop(POS, BLOCK, OWN)


def ordered_prefix(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over all rows ahead of each row in ``order``, over the whole frame.

    The frame is range-partitioned and written once with its partition number, which fixes the
    partitioning for both uses below. Only the totals per partition, as many rows as there are
    partitions, meet in one task.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    table = stage(ranged, "prefix")
    totals = table.groupBy("_part").agg(F.sum(value).alias("_total"))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    # bounded: one row per range partition
    return (
        table.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_part", "_offset")
    )


def with_global_index(
    df: DataFrame, spec: ObsSpec, then: list[str] = (), weight: Column | None = None, out: str = "_idx", total: str = "_n"
) -> DataFrame:
    """0-based index of each row in (entity, time, *then) order over the whole frame, and the row count.

    Same idea as :func:`with_position`: counts per (entity, bucket), their prefix sums, a running number
    inside the bucket. No task sorts more than one bucket. With ``weight`` a row stands for that many rows
    and ``out`` is the index of its first one, so rows can be numbered before they are expanded.
    """
    weight = F.lit(1) if weight is None else weight
    bucketed = df.withColumns({BUCKET: calendar_bucket(spec), "_w": weight.cast("long")})
    counts = bucketed.groupBy(spec.entity, BUCKET).agg(F.sum("_w").alias("_n_bucket"))
    starts = ordered_prefix(counts, [spec.entity, BUCKET], "_n_bucket", "_start")
    rows = starts.agg(F.coalesce(F.sum("_n_bucket"), F.lit(0))).scalar()
    numbered = _numbered(bucketed, starts.drop("_n_bucket"), spec, list(then), "_w", out)
    return numbered.withColumn(total, rows).select(*df.columns, out, total)
