"""A corpus pipeline over the documents table: quality, near copies, repeated passages, benchmark leaks, tokens.

Defined cases, in all stages: documents with a null or empty text stay, and have no tokens; so do rows with a null id, which
are judged by their text; rows that share an id are one document; other columns, whatever their names, pass through all
stages but the last; an empty table, and empty tables of labels or benchmark items, give what their stages say of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm import bpe_automaton, decontaminate, kn_quality, minhash_dedup, substring_dedup
from tesserae.llm.runtime import remove_folder, shared_folder, table
from tesserae.llm.token_counts import default_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return kn_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_dedup.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in a document with a smaller id."""
    return substring_dedup.remove(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return bpe_automaton.round_trip(docs, default_tokenizer())


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_copies),
    ("substring dedup", passages),
    ("benchmark decontamination", benchmark_leaks),
    ("BPE encoding and decoding", tokens),
]
#: SQL can't express the perplexities, the components and the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}")
        docs = spark.read.parquet(path)
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")  # only the last stage's rows are returned
    return docs
