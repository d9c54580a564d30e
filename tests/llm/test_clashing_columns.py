"""Columns of whatever names pass through the stages with their values."""

import corpus_pipeline
from tesserae.llm.runtime import durable

NAMES = ["__key", "__print", "__gone", "__gone_k", "__gone_fp", "__doc", "__text", "__spans", "__fp", "__k", "__id", "of", "at", "kind", "key", "k", "fp", "other0", "other1", "component_id", "n_shingles", "hits", "a b", "x.y"]
SF = "/root/testdata/sf0.001"


def test_all_stages_keep_other_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    wide = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    plain, now = durable(docs), durable(wide)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, now = durable(stage(spark, plain, SF)), durable(stage(spark, now, SF))
        assert now.columns == wide.columns, name
        rows = now.collect()
        assert all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in NAMES), name
        assert sorted((r.doc_id, r.text, r.n_chars) for r in rows) == sorted((r.doc_id, r.text, r.n_chars) for r in plain.collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, now, SF).count() == len(rows)
