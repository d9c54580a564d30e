"""The folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a private folder that serves a local master alone."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that all of them see")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tesserae-ckpt-"))
        named = sc.getCheckpointDir()
    return named


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Of what is made here, Spark drops the shuffle files as soon as it is done: they are not read again, and would stay on the
    executors' disks until the driver's next collection of garbage."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """An eager checkpoint that leaves no shuffle files."""
    with cleaned(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan takes the setting as it is made


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` from Parquet in the shared folder: a checkpoint of few bytes, that leaves no shuffle files."""
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    with cleaned(spark):
        df.select("*").write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """A table that every round writes anew; what the round before wrote goes."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/rounds-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame) -> DataFrame:
        out = stored(df, f"{self.folder}/{self.n}")
        if self.n:
            remove_folder(self.spark, f"{self.folder}/{self.n - 1}")
        self.n += 1
        return out


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark knows."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
