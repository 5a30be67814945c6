"""Fitted pipelines in versioned folders, with one metadata row per version."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from aqspark import spec as S

METADATA_SCHEMA = (
    "version int, model_name string, mae double, rmse double, r2 double, cv_rmse_mean double, cv_rmse_std double, "
    "feature_count int, feature_names array<string>, trained_at string, "
    "config struct<test_size: double, cv_folds: int, random_seed: int>, path string"
)


def registry_save(spark: SparkSession, root: str, model: PipelineModel, metrics: dict, features: list[str], version: int | None, trained_at: str) -> DataFrame:
    """Save the pipeline (scaler included) and append its metadata row; returns the metadata table.

    Without ``version`` it is the one after the newest. A version that cannot be written is an error.
    """
    version = next_version(spark, root) if version is None else version
    path = f"{root}/models/version={version}"
    model.write().save(path)
    row = (
        version,
        metrics["model_name"],
        *[float(metrics[k]) if metrics.get(k) is not None else None for k in ("mae", "rmse", "r2", "cv_rmse_mean", "cv_rmse_std")],
        len(features),
        list(features),
        trained_at,
        (S.TEST_FRACTION, S.CV_FOLDS, S.SEED),
        path,
    )
    spark.createDataFrame([row], METADATA_SCHEMA).write.mode("append").parquet(f"{root}/metadata")
    return registry_versions(spark, root)


def next_version(spark: SparkSession, root: str) -> int:
    try:
        newest = registry_versions(spark, root).agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return (newest or 0) + 1


def registry_versions(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).parquet(f"{root}/metadata")


def registry_best(metadata: DataFrame) -> DataFrame:
    """The version with the lowest rmse; without any known rmse, the newest version."""
    row = F.struct(*metadata.columns)
    lowest = F.min_by(row, F.when(F.col("rmse").isNotNull(), F.struct("rmse", "version")))
    return metadata.agg(F.coalesce(lowest, F.max_by(row, "version")).alias("b")).select("b.*")


def registry_load(spark: SparkSession, root: str) -> tuple[PipelineModel, DataFrame]:
    best = registry_best(registry_versions(spark, root))
    return PipelineModel.load(best.first()["path"]), best


def newest_metadata(first: DataFrame, second: DataFrame) -> DataFrame:
    """Of two metadata sources the row trained last; ``first`` wins a tie."""
    both = first.withColumn("_p", F.lit(1)).unionByName(second.withColumn("_p", F.lit(0)), allowMissingColumns=True)
    row = F.struct(*[c for c in both.columns if c != "_p"])
    return both.agg(F.max_by(row, F.struct(F.coalesce("trained_at", F.lit("")), F.col("_p"))).alias("b")).select("b.*")


def apply_metadata(forecasts: DataFrame, metadata: DataFrame, fields=("model_name", "mae", "rmse", "r2", "trained_at")) -> DataFrame:
    """Overlay model name and metrics of the one metadata row; what it lacks keeps the forecast's value."""
    known = [c for c in fields if c in metadata.columns]
    m = metadata.select(F.struct(*known)).scalar()
    return forecasts.withColumns(
        {c: F.coalesce(m[c], F.col(c)) if c in forecasts.columns else m[c] for c in known}
    )
