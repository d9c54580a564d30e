"""A ledger of free-text notes on a run's timeline, fed by a stream of files.

    python -m jobs.note_ledger jobs/note_ledger.yaml [--set KEY=VALUE ...]

Why a timepoint was special is told by notes, and notes are corrected and delivered again.  As with results, a revision goes by
the digest of its content: ``output``/ledger gains a line for each revision (note, key) that it has not, and
``output``/latest has the last revision of each note.  Both are Parquet, partitioned by the acquired file that the note's
timepoint lies in (ledger: and by micro-batch); a note of no timepoint, without an id, goes to file -1.

The stream reads new files alone (``notes``, a folder or a pattern of paths, with its ``checkpoint``; at most ``files_per_batch`` at once) and ends when there are no
more.  A micro-batch looks up and writes only partitions of the files that its notes lie in.  Its lines go to its own partitions
of the ledger, which Spark's dynamic overwrite replaces, and lookups leave the batch's own lines out; so a batch that is run
again after a crash, wherever it broke off, writes the same.  Texts are read once and never shuffled.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import layout, tasks
from tesserae.plans.acquisition import Acquisition

from .common import Config, checked, main

log = logging.getLogger("note_ledger")
LEDGER = "doc_id long, source string, lang string, key string, n_chars long, n_words long, t int, local_t int, modified timestamp, batch long, file_i int"


def revisions(notes: DataFrame, times: DataFrame) -> DataFrame:
    """A row per revision (doc_id, key) of ``notes`` (doc_id, source, lang, text, modified), with its place on the timeline; the
    copy of the newest file counts.  The n-th note belongs to timepoint n, counted round."""
    text = F.coalesce("text", F.lit(""))
    own = notes.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", tasks.digest(text).alias("key"), F.char_length(text).cast("long").alias("n_chars"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"), "modified")
    rest = ["modified", "source", "lang", "n_chars", "n_words"]
    one = own.groupBy("doc_id", "key").agg(F.max(F.struct(*rest)).alias("x")).select("doc_id", "key", *[f"x.{c}" for c in rest])
    n = times.agg(F.count("*").alias("nt"))  # one row
    at = one.crossJoin(F.broadcast(n)).withColumn("t", F.pmod("doc_id", "nt").cast("int")).drop("nt")
    return at.join(times, "t", "left").withColumn("file_i", F.coalesce("file_i", F.lit(-1)))


def _replace(rows: DataFrame, path: str, *by: str) -> None:
    """Replaces the partitions that ``rows`` has; a file of the run that holds many notes is split over several tasks."""
    rows.hint("rebalance", "file_i").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def record(batch: DataFrame, n: int, times: DataFrame, output: str) -> None:
    """Adds the lines of micro-batch ``n`` and brings the latest revisions of the files it touches up to date."""
    spark = batch.sparkSession
    columns = [c.split()[0] for c in LEDGER.split(", ")]
    ledger = lambda: spark.read.schema(LEDGER).parquet(f"{output}/ledger")
    found = revisions(batch, times).persist()
    try:
        touched = [r[0] for r in found.select("file_i").distinct().collect()]  # of a run's files
        held = ledger().where(F.col("file_i").isin(touched) & (F.col("batch") < n)).select(F.col("doc_id").alias("old_id"), F.col("key").alias("old_key"))
        new = found.join(held, F.col("doc_id").eqNullSafe(F.col("old_id")) & (F.col("key") == F.col("old_key")), "left_anti")
        _replace(new.withColumn("batch", F.lit(n).cast("long")).select(columns), f"{output}/ledger", "batch", "file_i")
    finally:
        found.unpersist()
    lines = ledger().where(F.col("file_i").isin(touched) & (F.col("batch") <= n)).drop("local_t")
    last = tasks.last_wins(lines, "doc_id", ["batch", "modified", "key"]).join(times.select("t", "local_t"), "t", "left")
    _replace(last.select(columns), f"{output}/latest", "file_i")


def run(spark: SparkSession, config: Config) -> Config:
    """Takes the files of notes that are new since the last run; what was read and written is logged and returned."""
    checked(config, {"tables", "notes", "output", "checkpoint"}, {"files_per_batch"})
    output = config["output"]
    for name in ("ledger", "latest"):  # an empty table where there is none yet
        spark.createDataFrame([], LEDGER).write.mode("append").partitionBy("file_i").parquet(f"{output}/{name}")
    times = layout.timeline(Acquisition(spark, config["tables"]).files)
    notes = spark.readStream.schema(spark.read.parquet(config["notes"]).schema).option("maxFilesPerTrigger", int(config.get("files_per_batch", 1000))).parquet(config["notes"])
    rows = notes.select("doc_id", "source", "lang", "text", F.col("_metadata.file_modification_time").alias("modified"))
    log.info("reads new files of %s, timeline of %s", config["notes"], config["tables"])
    query = rows.writeStream.foreachBatch(lambda batch, n: record(batch, n, times, output)).option("checkpointLocation", config["checkpoint"]).trigger(availableNow=True).start()
    query.awaitTermination()
    batches = {p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"]}
    lines = spark.read.schema(LEDGER).parquet(f"{output}/ledger").where(F.col("batch").isin(list(batches))).count() if batches else 0
    found = {"batches": len(batches), "read": sum(batches.values()), "lines": lines}
    log.info("read %(read)d notes in %(batches)d batches, wrote %(lines)d lines", found)
    return found


def ledger(spark: SparkSession, output: str) -> DataFrame:
    """The whole output: all lines, and whether each is the latest of its note."""
    read = lambda name: spark.read.schema(LEDGER).parquet(f"{output}/{name}")
    last = read("latest").select(F.col("doc_id").alias("last_id"), F.col("key").alias("last_key"))
    met = read("ledger").join(last, F.col("doc_id").eqNullSafe(F.col("last_id")) & (F.col("key") == F.col("last_key")), "left")
    return met.withColumn("latest", F.col("last_key").isNotNull()).drop("last_id", "last_key")


if __name__ == "__main__":
    main("note_ledger", run)
