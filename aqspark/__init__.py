"""Spark-native feature, forecast and evaluation operators for hourly sensor series."""

from aqspark.spec import ObsSpec

__all__ = ["ObsSpec"]
