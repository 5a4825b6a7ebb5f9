"""Spark-native analytics over web access logs and network packet records."""

from tracewarden.config import DetectionConfig

__all__ = ["DetectionConfig"]
