"""The package itself, for executors that do not see the driver's path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]


def ship_code(spark: SparkSession) -> None:
    """Hands the package to Spark's own file server, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_tesserae_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(), "tesserae_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, Path(_PACKAGE.name) / p.relative_to(_PACKAGE))
    sc.addPyFile(path)
    sc._tesserae_shipped = True
