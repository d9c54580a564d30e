"""License scans by an exact set-similarity join of text blocks with license templates.

The words of all templates are put in one global order, rarest first by the number of documents that hold them, counted
over the whole table.  Blocks are windows of ``BLOCK`` words over the whole text, across line ends, that overlap by half, so
that every run of ``BLOCK / 2`` words lies within one.  A block contains a template if it holds at least ``THRESHOLD``
percent of the template's distinct words; then it holds one of the template's ``n - need + 1`` rarest (prefix filter), has at
least ``need`` distinct words (length filter), and, met at its i-th rarest word, can still reach ``need`` with the words from
there on (positional filter).  Blocks that hold a prefix word are written down by their template words; they meet the
postings of the templates' prefixes in an equi-join on the word, the filters are its conditions, and what passes is counted
exactly.  All templates over the threshold give their labels.

Beside the templates' labels stand the base labels: places where the words of a phrase follow each other.

Defined cases: null and empty texts have no words and no labels; labels are empty strings where there are none; rows with a
null id are scanned like all others; rows are returned as often as they come; other columns of the input, whatever their
names, are not returned; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan as ts
from .runtime import durable, ship_code, table

THRESHOLD, BLOCK = 80, 64  # percent, words
BROADCAST_POSTINGS = 100_000  # rows of the templates' prefixes; more are joined by a shuffle
#: Phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Common one-line license statements and their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("gnu affero general public license version 3", "agpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("licensed under cc by 4 0 attribution international", "cc-by"),
    ("licensed under cc by sa 4 0 sharealike international", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def _hashes(text: str) -> np.ndarray:
    return ts.words(text.encode(), "alnum", True)[2]


def document_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of texts that hold each word of the (small, fixed) vocabulary."""
    keys = {int(_hashes(w)[0]): i for i, w in enumerate(vocabulary)}
    known = np.array(sorted(keys), dtype=np.uint64)

    def run(it):
        found: Counter = Counter()
        for b in it:
            for text in b.column(0).to_pylist():
                if text:
                    h = _hashes(text)
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    found.update(np.unique(h[known[at] == h]).tolist())
        yield pa.RecordBatch.from_pydict({"word": pa.array([keys[h] for h in found], pa.int32()), "n": pa.array(list(found.values()), pa.int64())})

    rows = docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row per vocabulary word
    counts = {r["word"]: r["n"] for r in rows}
    return {w: counts.get(i, 0) for i, w in enumerate(vocabulary)}


class Blocks:
    """Base places of a text, and its blocks that hold a word of some template's prefix."""

    def __init__(self, order: dict[str, int], prefix: set[int], least: int):
        """``order``: place of each template word in the global order; ``least``: words that a block needs for any template."""
        rank = {int(_hashes(w)[0]): k for w, k in order.items()}
        self.known = np.array(sorted(rank), dtype=np.uint64)
        self.ranks = np.array([rank[int(h)] for h in self.known], dtype=np.int64)
        self.prefix = np.zeros(len(order), dtype=bool)
        self.prefix[list(prefix)] = True
        self.least = least
        self.phrases = [(_hashes(p), label) for p, label in PHRASES]

    def base(self, h: np.ndarray) -> tuple[int, int | None, int | None, str]:
        labels, places = set(), []
        for words, label in self.phrases:
            m = len(words)
            hit = np.flatnonzero(h[: max(0, len(h) - m + 1)] == words[0])
            for k in range(1, m):
                hit = hit[h[hit + k] == words[k]]
            if len(hit):
                labels.add(label)
                places.append(hit)
        every = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        return len(every), *((int(every.min()), int(every.max())) if len(every) else (None, None)), ",".join(sorted(labels))

    def of(self, h: np.ndarray) -> list[dict]:
        """start, number of distinct words and template words (by their order, ascending) of each block."""
        n, half = len(h), BLOCK // 2
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        mine = self.known[at] == h
        rank = np.where(mine, self.ranks[at], 0)
        rare = np.flatnonzero(mine & self.prefix[rank])
        last = max(-(-(n - half) // half) - 1, 0)
        k = rare // half  # a place lies in two blocks
        out = []
        for s in (np.unique(np.minimum(np.concatenate([k, np.maximum(k - 1, 0)]), last)) * half).tolist():
            inner = slice(s, s + BLOCK)
            held = np.unique(rank[inner][mine[inner]])
            if len(held) >= self.least:
                out.append({"start": s, "words": len(np.unique(h[inner])), "held": held.tolist()})
        return out


_SCANNED = "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, blocks array<struct<start:int,words:int,held:array<int>>>"
_SCANNED_ARROW = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string())]
    + [("blocks", pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("held", pa.list_(pa.int32()))])))]
)


def template_rows(templates, order: dict[str, int], threshold: int) -> list[tuple[int, str, int, list[int]]]:
    """template, label, words that a block must hold, and the template's words by the global order."""
    out = []
    for k, (text, label) in enumerate(templates):
        held = sorted({order[w] for w in words_of(text)})
        out.append((k, label, -(-threshold * len(held) // 100), held))
    return out


def scan(docs: DataFrame, templates=TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (1 at a base phrase, else the best
    containment); ``templates``: (text, label)."""
    spark = docs.sparkSession
    ship_code(spark)
    frequency = document_counts(docs, sorted({w for text, _ in templates for w in words_of(text)}))
    order = {w: k for k, w in enumerate(sorted(frequency, key=lambda w: (frequency[w], w)))}
    rows = template_rows(templates, order, threshold)
    prefix = {w for *_, need, held in rows for w in held[: len(held) - need + 1]}
    least = min((need for *_, need, _ in rows), default=1)

    def run(it):
        blocks, row = Blocks(order, prefix, least), TaskContext.get().partitionId() << 33
        for b in it:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = _hashes(text or "")
                out.append((row, doc, len(h), *blocks.base(h), blocks.of(h) if len(h) else []))
                row += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SCANNED_ARROW.types, strict=True)], schema=_SCANNED_ARROW)

    scanned = durable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCANNED))
    held = scanned.select("row", F.explode("blocks").alias("b")).select("row", F.col("b.start").alias("start"), F.col("b.words").alias("words"), F.col("b.held").alias("held"))
    met = held.select("*", F.posexplode("held").alias("j", "word"))
    listed = spark.createDataFrame(rows, "template int, label string, need int, whole array<int>")
    first = F.slice("whole", 1, F.size("whole") - F.col("need") + 1)
    postings = listed.select("template", "label", "need", "whole", F.posexplode(first).alias("i", "word"))
    if sum(len(held) - need + 1 for *_, need, held in rows) <= BROADCAST_POSTINGS:
        postings = F.broadcast(postings)
    could = (F.col("words") >= F.col("need")) & (F.least(F.size("whole") - F.col("i"), F.size("held") - F.col("j")) >= F.col("need"))
    both = F.size(F.array_intersect("held", "whole"))
    found = met.join(postings, "word").where(could).where(both >= F.col("need")).groupBy("row").agg(F.collect_set("label").alias("found"), F.max(both / F.size("whole")).alias("best"))
    out = scanned.drop("blocks").join(found, "row", "left")
    base = F.when(F.col("base_labels") != "", F.split("base_labels", ",")).otherwise(F.array().cast("array<string>"))
    labels = F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
OP5_SQL = f"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
template AS MATERIALIZED (SELECT t, label, unnest(list_distinct(ws)) AS word, len(list_distinct(ws)) AS n FROM (VALUES {", ".join(f"({k}, '{label}', {_LIST(words_of(text))})" for k, (text, label) in enumerate(TEMPLATES))}) v(t, label, ws)),
place AS (SELECT doc_id, len(ws) AS n, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM w),
hit AS MATERIALIZED (SELECT * FROM place WHERE word IN (SELECT word FROM template)),
block AS (SELECT DISTINCT doc_id, k, word FROM (SELECT doc_id, word, n, unnest([i // {BLOCK // 2} - 1, i // {BLOCK // 2}]) AS k FROM hit) WHERE k >= 0 AND (k = 0 OR k * {BLOCK // 2} < n - {BLOCK // 2})),
met AS (SELECT doc_id, k, t, label, n, count(*) AS held FROM block JOIN template USING (word) GROUP BY ALL),
found AS (SELECT doc_id, label, held / n::DOUBLE AS share FROM met WHERE 100 * held >= {THRESHOLD} * n),
phrase AS (SELECT label, ws AS p FROM (VALUES {", ".join(f"('{label}', {_LIST(text.split())})" for text, label in PHRASES)}) v(label, ws)),
base AS MATERIALIZED (SELECT doc_id, label, unnest(list_filter(range(1, len(ws) + 1), lambda i: ws[i : i + len(p) - 1] = p)) - 1 AS pos FROM w, phrase),
b AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM found) GROUP BY doc_id),
best AS (SELECT doc_id, max(share) AS share FROM found GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)
"""
