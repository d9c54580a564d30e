"""Drift statistics and inspection tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan


def magnitude(*parts: Column) -> Column:
    total = F.lit(0.0)
    for p in parts:
        total = total + p.cast("double") * p.cast("double")
    return F.sqrt(total)


def outliers(series: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose magnitude is beyond max(3 * median, median + 5) of their series."""
    limits = scan.medians(series, key, value).withColumn("limit", F.greatest(3 * F.col("med"), F.col("med") + 5))
    return series.join(limits, key).where(F.col(value) > F.col("limit")).drop("limit")


def cumulative(series: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Running totals, rounded to two places, of each series."""
    names = [f"cum_{v}" for v in values]
    return scan.prefix_sums(series, key, order, values, names).withColumns({n: F.round(n, 2) for n in names})


def max_projection(voxels: DataFrame, keep: list[str]) -> DataFrame:
    return voxels.groupBy(*keep).agg(F.max("v").alias("v"))


def centre_crop(voxels: DataFrame, ny: int, nx: int, size: int) -> DataFrame:
    """Voxels of the centred lateral window of at most ``size`` pixels."""
    out = voxels
    for c, n in (("y", ny), ("x", nx)):
        m = min(n, size)
        a = (n - m) // 2
        out = out.where((F.col(c) >= a) & (F.col(c) < a + m)).withColumn(c, F.col(c) - a)
    return out
