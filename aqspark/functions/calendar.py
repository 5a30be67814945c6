"""Calendar parts of a timestamp and their cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

CALENDAR = ("hour", "day_of_week", "day_of_month", "month", "is_weekend", "quarter")
CYCLES = (("hour", "hour", 24), ("month", "month", 12), ("dow", "day_of_week", 7))
CYCLIC = tuple(f"{name}_{fn}" for name, _, _ in CYCLES for fn in ("sin", "cos"))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Monday is day 0 (``weekday``, not ``dayofweek``)."""
    dow = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
        "is_weekend": (dow >= 5).cast("int"),
        "quarter": F.quarter(ts),
    }


def cyclic_parts(parts: dict[str, Column]) -> dict[str, Column]:
    out = {}
    for name, source, period in CYCLES:
        angle = F.lit(2 * math.pi) * parts[source] / F.lit(float(period))
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def calendar_features(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.withColumns(calendar_parts(F.col(time)))


def cyclic_features(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Works from the time column alone; existing calendar columns are not needed."""
    return df.withColumns(cyclic_parts(calendar_parts(F.col(time))))


def time_features(df: DataFrame, time: str = "timestamp") -> DataFrame:
    parts = calendar_parts(F.col(time))
    return df.withColumns({**parts, **cyclic_parts(parts)})
