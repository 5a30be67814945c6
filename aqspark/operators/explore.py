"""Exploratory summaries: histogram, density, correlations, coverage."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from aqspark.functions import scalar as X
from aqspark.operators.clean import numeric_columns
from aqspark.spec import ObsSpec


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, rows) for equal-width bins from least to most, the last closed on the right.
    Empty bins are kept."""
    x = X.null_if_nan(F.col(column).cast("double"))
    known = df.select(x.alias("x")).where(F.col("x").isNotNull())
    edges = known.agg(F.min("x").alias("low"), F.max("x").alias("high")).select(F.struct("*")).scalar()
    width = (edges["high"] - edges["low"]) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("x") - edges["low"]) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
    counts = known.groupBy(F.coalesce(place, F.lit(0)).cast("int").alias("bin")).agg(F.count("*").alias("rows"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (edges["low"] + F.col("bin") * width).alias("low"),
        (edges["low"] + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def density_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """(point, x, density): Gaussian kernel density with Scott's bandwidth on an even grid.

    Equal values are counted before the grid is laid out, and each task adds up its own share of the
    grid, so ``points`` rows per task are shuffled.
    """
    x = X.null_if_nan(F.col(column).cast("double"))
    known = df.select(x.alias("x")).where(F.col("x").isNotNull())
    shape = known.agg(
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.count("*").alias("n"),
        (F.stddev_samp("x") * F.pow(F.count("*").cast("double"), F.lit(-0.2))).alias("h"),
    )
    shape = shape.select(F.struct("*")).scalar()
    counted = known.groupBy("x").agg(F.count("*").alias("m"))
    at = shape["low"] + F.col("point") * (shape["high"] - shape["low"]) / F.lit(points - 1)
    spread = counted.select("x", "m", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    width = F.nullif(shape["h"], F.lit(0.0))  # a constant column has no curve: its density is null
    z = (at - F.col("x")) / width
    return (
        spread.groupBy("point")
        .agg(F.sum(F.col("m") * F.exp(-0.5 * z * z)).alias("mass"))
        .select(
            "point",
            at.alias("x"),
            (F.col("mass") / (shape["n"] * width * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
        )
    )


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(a, b, corr) for all pairs; each pair uses the rows where both are known. Null for a constant column and where no row knows both.

    Rows are laid out by pair and combined in the tasks, so one row per pair and task is shuffled and the aggregate
    stays narrow however many columns there are.
    """
    columns = columns or numeric_columns(df)
    values = F.array(*[X.null_if_nan(F.col(c).cast("double")) for c in columns])
    first = df.select(values.alias("v")).select("v", F.posexplode("v").alias("i", "x")).where("x IS NOT NULL")
    pairs = first.select("i", "x", "v", F.explode(F.sequence("i", F.lit(len(columns) - 1))).alias("j"))
    known = pairs.select("i", "j", "x", F.get("v", F.col("j")).alias("y")).where("y IS NOT NULL")
    # a varying column has a positive deviation, unless it underflows
    spread = F.nullif(F.stddev_pop("x") * F.stddev_pop("y"), F.lit(0.0))
    varies = (F.min("x") < F.max("x")) & (F.min("y") < F.max("y"))
    corr = known.groupBy("i", "j").agg(F.when(varies, F.covar_pop("x", "y") / spread).alias("corr"))
    names, n, spark = F.array(*map(F.lit, columns)), F.lit(len(columns)), df.sparkSession
    grid = spark.range(len(columns) ** 2).select(F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"))
    both = (F.least("row", "col") == F.col("i")) & (F.greatest("row", "col") == F.col("j"))
    return grid.join(corr, both, "left").select(F.get(names, F.col("row")).alias("a"), F.get(names, F.col("col")).alias("b"), "corr")


def coverage_summary(df: DataFrame, spec: ObsSpec) -> DataFrame:
    return df.groupBy(spec.entity).agg(
        F.count("*").alias("rows"), F.min(spec.time).alias("first_time"), F.max(spec.time).alias("last_time")
    )


def total_coverage(df: DataFrame, spec: ObsSpec) -> DataFrame:
    """The whole table in one row; built on the per-entity summary, so entities need no second count."""
    return coverage_summary(df, spec).agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("entities"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    )
