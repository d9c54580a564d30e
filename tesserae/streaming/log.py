"""The result log as a stream: new files of an append-only folder, the last row of each key kept in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.tasks import last_wins
from ..sources import files

SCHEMA = "key string, kind string, seq long, dz int, dy int, dx int"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the log as they come; lines that do not parse are left out, as in the batch reader."""
    rows = spark.readStream.schema(f"{SCHEMA}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(folder)
    return rows.where("_bad is null and key is not null").drop("_bad")


def first_seen(rows: DataFrame) -> DataFrame:
    """Each key once: a task that is computed again changes nothing for those who wait for it."""
    return rows.dropDuplicates(["key"])


def keep_last(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Merges each batch into the table at ``target``/n, a version per batch; a batch that runs again writes the same.  The last
    two versions stay, as readers may still be at the one before.  A batch rewrites the whole table: for tables beyond what
    that is worth, a ledger by partitions (``jobs/note_ledger.py``) touches only those of its rows.
    """

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        if n:
            batch = spark.read.parquet(f"{target}/{n - 1}").unionByName(batch)
        last_wins(batch, "key", ["seq"]).write.mode("overwrite").parquet(f"{target}/{n}")
        files.remove(f"{target}/{n - 2}")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
