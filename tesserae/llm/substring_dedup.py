"""Substring deduplication by level-wise doubling of repeated word windows.

Window lengths double from ``SHORTEST`` words at most up to ``min_words`` (13, 25, 50).  The first level looks for windows of
13 words that stand in several documents; only windows of 25 whose 13-word anchor does are left for the next level, and
only windows of 50 all of whose windows of 25 are left come to the last one; once no candidate is left, nothing more is
read.  The last level compares the windows of ``min_words`` words that are left, by the runs that share an anchor where whole
runs are equal (see ``anchors``) and one by one otherwise, on 88 independent bits of hashes.  A word goes if a window of
``min_words`` words that covers it also starts in a document with a smaller id.

Defined cases: null texts have no words, and nothing is removed from them; texts with fewer words than the window keep
all; rows with a null id take no part (nothing is removed, and they are no one's earlier copy); rows that share an id
are one document, none is the other's earlier copy; an empty table gives an empty result.  Other columns stay as they
are; names that begin with two underscores and are used here (see ``anchors``) raise.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import anchors as an
from . import textscan as ts
from .runtime import shielded, ship_code, table

MIN_WORDS, SHORTEST = 50, 16
HOT_RUNS = 1 << 30  # the second level deals single windows by their own hash, so no anchor is too common for it


def lengths(min_words: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths, each twice the one before (or one less), up to ``min_words``; the first is at most ``shortest``."""
    out = [min_words]
    while out[0] > max(shortest, 2):
        out.insert(0, -(-out[0] // 2))
    return out


def _extend(part: int, length: int, first: bool):
    """Posts the anchors, windows of ``part`` words, of the windows of ``length`` words that the level before has left."""

    def make(partitions: int):
        def post(it):
            poster = an.Poster(partitions, meet=True)

            def row(doc, fp, text, left=None):
                for a, b, h in _candidates(text, part, length, None if first else left):
                    g, _, at, count = an.anchors_of(h, ts.windows(h, part), length, part)
                    poster.add(doc, fp, g, np.zeros(len(g), dtype=np.uint64), at + a, count)

            yield from an.batches(it, poster, row)

        return post

    return make


def _candidates(text: str, part: int, length: int, left):
    """First window, end and word hashes of each stretch of windows of ``length`` words all of whose parts are left."""
    _, _, h = ts.words(text.encode())
    n = len(h) - length + 1
    if n <= 0:
        return
    if left is None:
        whole = [(0, n)]
    else:
        alive = np.concatenate([[0], np.cumsum(~an.windows_left(left, len(h) - part + 1))])
        inner = length - part + 1
        whole = an.stretches(alive[inner:] == alive[:-inner])
    for x, y in whole:
        for a, b in an.segments(y - x):
            yield x + a, x + b, h[x + a : x + b + length - 1]


def _level1(length: int, part: int, first: bool):
    def make(partitions: int):
        def post(it):
            poster = an.Poster(partitions)

            def row(doc, fp, text, left=None):
                for a, b, h in _candidates(text, part, length, None if first else left):
                    g, run, at, count = an.anchors_of(h, ts.windows(h, part), length, part)
                    poster.add(doc, fp, g, run, at + a, count)

            yield from an.batches(it, poster, row)

        return post

    return make


def _level2(length: int):
    part = length // 2

    def make(partitions: int):
        def post(it):
            poster = an.Poster(partitions)

            def row(doc, fp, text, asks):
                if asks is None:
                    return
                _, _, h = ts.words(text.encode())
                parts = ts.windows(h, part)
                whole = ts.join_windows(parts[: len(h) - length + 1], parts[part : part + len(h) - length + 1])
                s = np.concatenate([np.frombuffer(a["blob"], an.ASK) for a in asks])
                count = s["n"].astype(np.int64)
                at = np.repeat(s["at"].astype(np.int64), count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                one = np.ones(len(at), dtype=np.int64)
                poster.add(doc, fp, whole[at], ts.second_hash(parts, part, length)[at], at, one)

            yield from an.batches(it, poster, row)

        return post

    return make


def with_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    if min_words < 4 or min_words % 2:
        raise ValueError("min_words must be even, and 4 at least")
    ship_code(docs.sparkSession)
    chain = lengths(min_words)
    before = [_extend(a, b, k == 0) for k, (a, b) in enumerate(zip(chain[:-2], chain[1:-1], strict=True))]
    return an.repeated_spans(docs, F.col("doc_id"), F.col("text"), _level1(min_words, min_words // 2, not before), _level2(min_words), lambda n: an.settler(HOT_RUNS, n), HOT_RUNS, before)


def _cut(text: str, blobs, length: int) -> tuple[list[str], int, int]:
    data = text.encode()
    starts, ends, _ = ts.words(data)
    gone = an.covered_items(blobs, len(starts), length)
    kept = [data[a:b].decode() for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist(), strict=True)] if gone.any() else None
    return kept, len(starts), int(gone.sum())


def digest(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by one space."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    space = bytes.maketrans(b"\t\n\v\f\r", b"     ")

    def run(it):
        for b in it:
            out = []
            for doc, text, blobs in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                text = text or ""
                kept, n, removed = _cut(text, blobs, min_words)
                joined = b" ".join(text.encode().translate(space).split()) if kept is None else " ".join(kept).encode()
                out.append((doc, n, removed, hashlib.sha256(joined).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow) if out else pa.RecordBatch.from_pylist([], arrow)

    return with_spans(docs.select("doc_id", "text"), min_words).select("__doc", "__text", "__spans").mapInArrow(run, schema)


def remove(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the covered words cut out of ``text`` (texts without any stay byte for byte; in the others the kept
    words are joined by one space) and ``n_chars``, where there is such a column, counted anew."""
    safe, back = shielded(docs, "doc_id", "text", "n_chars")

    @F.pandas_udf(T.StringType())
    def kept(texts, spans):
        return texts.combine(spans, lambda t, s: t if s is None or t is None or (k := _cut(t, s, min_words)[0]) is None else " ".join(k))

    out = with_spans(safe, min_words)
    new = F.when(F.col("__spans").isNull(), F.col("__text")).otherwise(kept("__text", "__spans"))
    out = out.withColumn("text", new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return back(out)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
