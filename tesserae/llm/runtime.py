"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import ship
from ..sources.shared import checkpointed, remove_folder  # noqa: F401

#: Arrow batches go by bytes, not only by rows: texts can be long.  An own setting of the session stays.
ARROW_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20), "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
MOST_PARTITIONS = 1 << 17
UNKNOWN = 1 << 60  # sizes that Spark states for what is no file


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, and bound Arrow batches."""
    set_already = spark.conf.getAll
    for key, value in ARROW_BATCH.items():
        if key not in set_already:
            spark.conf.set(key, value)
    ship.ship_code(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one, set as the checkpoint folder, only with a local master."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that all of them see")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tesserae-ckpt-"))
    return named or sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder; what was shuffled on the way goes at once."""
    shared_folder(df.sparkSession)
    return checkpointed(df)


def release_memory() -> None:
    """Give freed memory back to the system: workers are kept, and several stand beside one executor."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def unused(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of the frame has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shielded(docs: DataFrame, *read: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns but those that are ``read`` under names that nothing else has, and what gives them back."""
    names = {c: c if c in read else f"other{i}" for i, c in enumerate(docs.columns)}
    safe = docs.toDF(*names.values())
    return safe, lambda df: df.select(*[F.col(new).alias(old) for old, new in names.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def input_bytes(df: DataFrame) -> int:
    """Size of the files that a frame reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return sum(x for x in sizes if x < UNKNOWN)


def partitions_for(df: DataFrame, size: int) -> int:
    """Shuffle partitions of a frame: as set, or one for each ``size`` bytes of the files it reads, if those are more."""
    return max(shuffle_partitions(df.sparkSession), min(-(-input_bytes(df) // size), MOST_PARTITIONS))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
