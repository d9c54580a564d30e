"""Coverage of a run by timepoint: what lives, what has to be computed, what is done and what comes next.

    python -m jobs.run_report jobs/run_report.yaml [--set KEY=VALUE ...]

``tables`` is the folder of the acquisition's tables, ``log`` the result log that tells what is done (without it a memo made
from the tables stands in), ``output`` the report: Parquet, a partition ``file_i`` for each acquired
file, a row for each timepoint.  With ``files`` only those partitions are made and replaced, as after new acquisitions or a
changed override; the others stay as they are.  A run over the same tables writes the same rows, however often: a partition is
replaced as a whole by Spark's dynamic overwrite.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import tasks
from tesserae.operators.coords import durable
from tesserae.plans.acquisition import Acquisition
from tesserae.sources import store

from .common import Config, checked, main

log = logging.getLogger("run_report")


def coverage(a: Acquisition, files: list[int] | None = None, done: DataFrame | None = None) -> DataFrame:
    """A row per timepoint of the files: living tiles, anchors and pairs, drops, tasks of either kind, done and pending ones, and
    the first pending task in work order.  ``done``: keys of what is computed, else those of the acquisition's memo."""
    times = a.times if files is None else a.times.where(F.col("file_i").isin([int(f) for f in files]))
    here = lambda df: df if files is None else df.join(times.select("t"), "t", "left_semi")
    tiles = here(a.state).groupBy("t").agg(F.count("*").alias("n_tiles"), F.count(F.when(F.col("anchor"), 1)).alias("n_anchors"))
    pairs = here(a.pairs_at).groupBy("t").agg(F.count("*").alias("n_pairs"))
    drops = here(a.overrides.where("verb = 'drop'")).groupBy("t").agg(F.concat_ws(",", F.sort_array(F.collect_set("name"))).alias("dropped"))
    plan = a.plan if files is None else durable(tasks.plan(here(a.time_tasks), here(a.pair_tasks)))
    known = a.memo(plan) if done is None else done.select("key").distinct()
    work = plan.join(known.withColumn("hit", F.lit(True)), "key", "left")
    waits = F.col("hit").isNull()
    of_kind = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    first = F.min(F.when(waits, F.struct(*tasks.ORDER[1:], "what")))["what"]
    todo = work.groupBy("t").agg(of_kind("time").alias("n_drift_tasks"), of_kind("pair").alias("n_pair_tasks"), F.count("hit").alias("n_done"), F.count(F.when(waits, 1)).alias("n_pending"), first.alias("next_task"))
    counts = [f"n_{c}" for c in ("tiles", "anchors", "pairs", "drift_tasks", "pair_tasks", "done", "pending")]
    out = times.join(tiles, "t", "left").join(pairs, "t", "left").join(drops, "t", "left").join(todo, "t", "left")
    return out.select("file_i", "t", "local_t", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("dropped", F.lit("")).alias("dropped"), "next_task")


def run(spark: SparkSession, config: Config) -> Config:
    """Writes the coverage report of a run; what was read and written is logged and returned."""
    checked(config, {"tables", "output"}, {"files", "log"})
    files = config.get("files")
    seen = Observation("written")
    a = Acquisition(spark, config["tables"])
    done = store.read_offsets(spark, config["log"]) if config.get("log") else None
    report = coverage(a, files, done).observe(seen, F.count("*").alias("timepoints"), F.coalesce(F.sum("n_done") + F.sum("n_pending"), F.lit(0)).alias("tasks"), F.coalesce(F.sum("n_pending"), F.lit(0)).alias("pending"))
    log.info("reads events, supplier of %s%s, %s", config["tables"], "" if files is None else f", files {files}", f"results of {config['log']}" if done is not None else "the memo of the tables")
    # a task per file: a partition's rows are as many as its timepoints
    report.repartition("file_i").sortWithinPartitions("file_i", "t").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_i").parquet(config["output"])
    found = dict(seen.get)
    log.info("wrote %(timepoints)d timepoints with %(tasks)d tasks, %(pending)d pending", found)
    return found


if __name__ == "__main__":
    main("run_report", run)
