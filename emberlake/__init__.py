"""Spark-native analytics for satellite fire detections."""

__version__ = "0.1.0"
