"""Landed JSON payloads of a weather service to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aqspark.functions import scalar as X
from aqspark import spec as S

# Field names and defaults of the payloads
WEATHER_SCHEMA = (
    "main struct<temp: double, feels_like: double, humidity: double, pressure: double>, "
    "wind struct<speed: double, deg: double>, clouds struct<all: double>, visibility double, "
    "weather array<struct<main: string>>"
)
COMPONENTS = "co: double, no: double, no2: double, o3: double, so2: double, pm2_5: double, pm10: double, nh3: double"
AIR_SCHEMA = f"list array<struct<dt: bigint, main: struct<aqi: int>, components: struct<{COMPONENTS}>>>"
DEFAULT_WIND_DEG = 0.0
DEFAULT_VISIBILITY = 10000.0


def parse_weather_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    p = F.from_json(payload, WEATHER_SCHEMA)
    rest = [c for c in df.columns if c != payload]
    return df.withColumn("_p", p).select(
        *rest,
        F.col("_p.main.temp").alias("temp"),
        F.col("_p.main.feels_like").alias("feels_like"),
        F.col("_p.main.humidity").alias("humidity"),
        F.col("_p.main.pressure").alias("pressure"),
        F.col("_p.wind.speed").alias("wind_speed"),
        F.coalesce("_p.wind.deg", F.lit(DEFAULT_WIND_DEG)).alias("wind_deg"),
        F.col("_p.clouds.all").alias("clouds"),
        F.coalesce("_p.visibility", F.lit(DEFAULT_VISIBILITY)).alias("visibility"),
        F.get("_p.weather", F.lit(0))["main"].alias("weather_main"),
    )


def _reading(item: Column, mode: str) -> list[Column]:
    parts = {c: F.coalesce(item["components"][c], F.lit(0.0)) for c in S.POLLUTANTS}
    epa = X.owm_to_epa(item["main"]["aqi"], item["components"]["pm2_5"], mode)
    return [epa.alias("aqi"), item["main"]["aqi"].alias("owm_aqi"), *[c.alias(n) for n, c in parts.items()]]


def parse_air_payload(df: DataFrame, payload: str = "payload", mode: str = "strict") -> DataFrame:
    """The first reading of each payload; absent components are 0."""
    rest = [c for c in df.columns if c != payload]
    item = df.withColumn("_i", F.get(F.from_json(payload, AIR_SCHEMA)["list"], F.lit(0)))
    return item.select(*rest, *_reading(F.col("_i"), mode))


def explode_history_payload(df: DataFrame, payload: str = "payload", mode: str = "strict") -> DataFrame:
    """One row per reading; ``dt`` counts seconds from 1970 in UTC. Rows are not sorted."""
    rest = [c for c in df.columns if c != payload]
    items = df.select(*rest, F.explode(F.from_json(payload, AIR_SCHEMA)["list"]).alias("_i"))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = start + F.make_dt_interval(secs=F.col("_i.dt").cast("decimal(18,6)"))
    return items.select(*rest, at.alias("timestamp"), *_reading(F.col("_i"), mode)).drop("owm_aqi")


def zero_fill_payload(df: DataFrame) -> DataFrame:
    """Infinite, NaN and missing numbers become 0."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: X.null_if_not_finite(c) for c in floating}).fillna(0)
