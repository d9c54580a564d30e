"""The jobs as registered queries: each runs twice over the whole tables into one new folder, which stays."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tesserae.plans.oracles import base
from tesserae.sources.shared import shared_folder

from . import note_ledger, run_report


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = _folder(spark, "run_report")
    for _ in range(2):
        run_report.run(spark, {"tables": sf_dir, "output": output})
    return spark.read.parquet(output)


def job2(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "note_ledger")
    config = {"tables": sf_dir, "notes": f"{sf_dir}/documents.parquet*", "output": f"{folder}/out", "checkpoint": f"{folder}/checkpoint"}
    for _ in range(2):
        note_ledger.run(spark, config)
    return note_ledger.ledger(spark, config["output"]).drop("batch", "modified")  # these tell of the run and the file


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_run_report": job1, "job2_note_ledger": job2}
SQL: dict[str, str] = {
    "job1_run_report": base("""
, s AS (SELECT t, count(*) AS n_tiles, count(*) FILTER (WHERE anchor) AS n_anchors FROM state GROUP BY t),
p AS (SELECT t, count(*) AS n_pairs FROM pairs_at GROUP BY t),
o AS (SELECT t, string_agg(name, ',' ORDER BY name) AS dropped FROM ovr WHERE verb = 'drop' GROUP BY t),
w AS MATERIALIZED (SELECT t, kind, kind_rank, a, b, what, CAST('0x' || substr(key, 1, 4) AS INTEGER) % 7 <> 0 AS hit FROM tasks),
k AS (SELECT t, count(*) FILTER (WHERE kind = 'time') AS nd, count(*) FILTER (WHERE kind = 'pair') AS np, count(*) FILTER (WHERE hit) AS n_done, count(*) FILTER (WHERE NOT hit) AS n_pending FROM w GROUP BY t),
f AS (SELECT t, what FROM w WHERE NOT hit QUALIFY row_number() OVER (PARTITION BY t ORDER BY kind_rank, a, b) = 1)
SELECT file_i, t, local_t, coalesce(n_tiles, 0) AS n_tiles, coalesce(n_anchors, 0) AS n_anchors, coalesce(n_pairs, 0) AS n_pairs, coalesce(nd, 0) AS n_drift_tasks, coalesce(np, 0) AS n_pair_tasks,
  coalesce(n_done, 0) AS n_done, coalesce(n_pending, 0) AS n_pending, coalesce(dropped, '') AS dropped, what AS next_task
FROM times LEFT JOIN s USING (t) LEFT JOIN p USING (t) LEFT JOIN o USING (t) LEFT JOIN k USING (t) LEFT JOIN f USING (t)"""),
    "job2_note_ledger": base(r"""
, n AS (SELECT doc_id, source, lang, coalesce(text, '') AS x, CAST(doc_id % (SELECT nt FROM nf) AS INTEGER) AS t FROM documents)
SELECT doc_id, source, lang, substr(sha256(x), 1, 16) AS key, length(x) AS n_chars, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n_words, t, local_t, file_i, true AS latest FROM n JOIN times USING (t)"""),
}
