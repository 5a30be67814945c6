"""Robust scaling by exact median and interquartile range."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aqspark.operators.quantiles import exact_quantiles


def scale_parameters(train: DataFrame, columns: list[str], weight: str | None = None) -> DataFrame:
    """(column, center, scale); a column without spread keeps scale 1. ``weight``: how many equal rows a row stands for."""
    names = {"q1": 0.25, "center": 0.5, "q3": 0.75}
    picks = [F.expr(f"max(if(prob = {p}D, value, NULL)) AS {name}") for name, p in names.items()]
    wide = exact_quantiles(train, columns, list(names.values()), weight=weight).groupBy("column").agg(*picks)
    return wide.selectExpr("column", "center", "if(q3 = q1, 1D, q3 - q1) AS scale")


def apply_scale(df: DataFrame, parameters: DataFrame, columns: list[str]) -> DataFrame:
    # two numbers per column
    fitted = parameters.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("center", "scale"))))).scalar()
    out = df.withColumn("_fit", fitted)
    scaled = {c: f"(`{c}` - _fit['{c}'].center) / _fit['{c}'].scale" for c in columns}
    return out.selectExpr(*[f"{scaled[c]} AS `{c}`" if c in scaled else f"`{c}`" for c in df.columns])


def robust_scale(df: DataFrame, columns: list[str], split: str | None = "split") -> DataFrame:
    """Fit on the rows marked ``train`` and apply to all rows; with ``split=None`` fit on all."""
    train = df if split is None else df.where(F.col(split) == "train")
    return apply_scale(df, scale_parameters(train, columns), columns)
