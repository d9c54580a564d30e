"""Spark-native analytics for tiled volumetric time series, and operators for large text corpora."""

__version__ = "0.1.0"
