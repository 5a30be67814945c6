"""Model metrics, leaderboards and feature importance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """mae, rmse and r2 in one aggregation; unrounded."""
    error = F.col(label) - F.col(prediction)
    total = F.var_pop(label) * F.count(label)
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / F.nullif(total, F.lit(0.0))).alias("r2"),
    )


def cv_summary(folds: DataFrame, by: list[str] = (), rmse: str = "rmse") -> DataFrame:
    """Mean and population deviation of the fold errors."""
    return folds.groupBy(*by).agg(
        F.avg(rmse).alias("cv_rmse_mean"), F.stddev_pop(rmse).alias("cv_rmse_std")
    )


def leaderboard(results: DataFrame) -> DataFrame:
    return results.orderBy("rmse", "mae", "model_name")


def best_model(results: DataFrame) -> DataFrame:
    """The row with the lowest rmse, then mae; no sort of the table."""
    best = F.min_by(F.struct(*results.columns), F.struct("rmse", "mae", "model_name")).alias("b")
    return results.agg(best).select("b.*")


def mean_abs_importance(attribution: DataFrame, k: int = 15, by: list[str] = ()) -> DataFrame:
    """The ``k`` features with the largest mean absolute attribution, from (feature, attribution) rows; of each group of ``by``."""
    means = attribution.groupBy(*by, "feature").agg(F.avg(F.abs("attribution")).alias("importance"))
    if not by:
        return top_k_features(means, k)
    # a group has as many rows as there are features
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("importance"), "feature"))
    return means.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def top_k_features(importance: DataFrame, k: int) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)
