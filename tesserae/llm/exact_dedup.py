"""Exact deduplication against a history of digests in minimal perfect hash tables.

Two texts are equal when they are identical without the characters of ``[\\x20\\x09-\\x0D]``; a text goes by the SHA-256 of what
is left.  The distinct digests of the history are dealt by their own bits to shards, and each shard is one row of an index: a
minimal perfect hash (levels of bits, as many slots as digests), and in the slot of a digest the whole digest and the locator
of its winner.  A digest from outside the history falls on a slot as well, so a lookup counts only if all 32 bytes agree.
Arrivals whose digest is in the history are repeats of it; the others make groups of their own.

Skew: arrivals are summed to one row per digest before anything is dealt, so copies of a text, however many, are a row per
task; shards are even as digests are.  Rows meet their verdict in a join by digest that Spark may split.

Defined cases: a null text is an empty one, and all texts without other characters are equal; of equal texts the one with the
most code points stays, then the smallest doc_id, where a null id comes after all others; of repeated rows of one id and length
one stays, that of the history before an arrival.  No column but doc_id and text is read by ``judge``, and ``keep_one`` returns
the columns of its input, whatever their names.  Texts of any length are hashed whole.  An empty table has an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import durable, ship_code, shuffle_partitions, table, unused
from .textscan import mix

U = np.uint64
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Digests of a shard, on average: about 5 MB of slots.
SHARD = 1 << 16
#: Bits of a level for each digest that comes to it.
GAMMA = 2
MOST_LEVELS = 512
_BEST = ["short", "anon", "id", "row"]  # least first: negated length, whether the id is null, the id, the place of the row
_VERDICT = pa.schema([("digest", pa.binary()), ("short", pa.int64()), ("anon", pa.int64()), ("id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("known", pa.bool_())])
_VERDICT_SQL = "digest binary, short long, anon long, id long, row long, n long, known boolean"
_INDEX = pa.schema([("shard", pa.int32()), ("sizes", pa.binary()), ("bits", pa.binary()), ("digests", pa.binary()), ("places", pa.binary())])
_INDEX_SQL = "shard int, sizes binary, bits binary, digests binary, places binary"


# --- the minimal perfect hash of one shard ------------------------------------------------------------------------------
def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bits of a level that digests (four words each) fall on."""
    salt = U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix(keys[:, level % 4] + salt) % U(size)).astype(np.int64)


def fit(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the levels in bits, and their bits: a digest alone on its bit sets it, the others go on to the next level."""
    sizes, bits, left = [], [], keys
    while len(left):
        if len(sizes) == MOST_LEVELS:
            raise ValueError("digests are repeated")
        size = -(-GAMMA * len(left) // 64) * 64
        at = _at(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little"))
        left = left[~alone[at]]
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, np.uint8)


def slots(keys: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Slot of each digest: the number of set bits before its own; -1 for those that no level has."""
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
    out, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes.tolist()):
        at = base + _at(keys[todo], level, size)
        byte, bit = bits[at >> 3], (at & 7).astype(np.uint8)
        hit = (byte >> bit & 1).astype(bool)
        below = byte & ((np.uint8(1) << bit) - np.uint8(1))
        out[todo[hit]] = (before[at >> 3] + np.bitwise_count(below))[hit]
        todo, base = todo[~hit], base + size
    return out


def _words(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), U).reshape(-1, 4)


def _build(key: tuple, group: pa.Table) -> pa.Table:
    words = _words(group["digest"])
    sizes, bits = fit(words)
    order = np.argsort(slots(words, sizes, bits))
    places = np.stack([group[c].to_numpy() for c in (*_BEST, "n")], axis=1)[order]
    return pa.table([[key[0].as_py()], [sizes.tobytes()], [bits.tobytes()], [words[order].tobytes()], [places.tobytes()]], schema=_INDEX)


def _look_up(_key: tuple, index: pa.Table, fresh: pa.Table) -> pa.Table:
    """The slots of one shard with what the arrivals change in them, and the arrivals that are in no slot."""
    new, own = _words(fresh["digest"]), np.stack([fresh[c].to_numpy() for c in (*_BEST, "n")], axis=1) if fresh.num_rows else np.zeros((0, 5), np.int64)
    held, places, known = np.zeros((0, 4), U), np.zeros((0, 5), np.int64), np.zeros(len(new), bool)
    if index.num_rows:
        sizes, bits, digests, raw = (index[c][0].as_py() for c in ("sizes", "bits", "digests", "places"))
        held, places = np.frombuffer(digests, U).reshape(-1, 4), np.frombuffer(raw, np.int64).reshape(-1, 5).copy()
        at = slots(new, np.frombuffer(sizes, np.int64), np.frombuffer(bits, np.uint8))
        known = (at >= 0) & (held[at] == new).all(axis=1)  # all 32 bytes
        at, mine = at[known], own[known]
        better, tied = np.zeros(len(at), bool), np.ones(len(at), bool)
        for c in range(3):  # an arrival that ties with the history gives way
            better |= tied & (mine[:, c] < places[at, c])
            tied &= mine[:, c] == places[at, c]
        places[at, 4] += mine[:, 4]
        places[at[better], :4] = mine[better, :4]
    words, every = np.concatenate([held, new[~known]]), np.concatenate([places, own[~known]])
    raw = words.tobytes()
    return pa.table([[raw[k : k + 32] for k in range(0, len(raw), 32)], *every.T, np.arange(len(words)) < len(held)], schema=_VERDICT)


# --- tables -------------------------------------------------------------------------------------------------------------
def digest_of(text: Column) -> Column:
    """SHA-256 of a text without white space, 32 bytes."""
    bare = F.coalesce(text, F.lit(""))
    for c in SPACES:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    return F.unhex(F.sha2(bare, 256))


def length_of(text: Column) -> Column:
    """Code points of the original text."""
    return F.coalesce(F.char_length(text), F.lit(0)).cast("long")


def groups(rows: DataFrame) -> DataFrame:
    """A row per digest: its best row and its number of rows."""
    best = F.min(F.struct(*_BEST)).alias("best")
    return rows.groupBy("digest").agg(best, F.count("*").alias("n")).select("digest", *[F.col(f"best.{c}").alias(c) for c in _BEST], "n")


@dataclass(frozen=True)
class History:
    """An index of distinct digests: ``rows``, one for each of ``shards`` shards that hold any."""

    rows: DataFrame
    shards: int


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def build(old: DataFrame, shards: int) -> History:
    """The index of grouped rows (``groups``); it can be written as Parquet and read for later arrivals."""
    return History(old.select("*", _shard(shards)).groupBy("shard").applyInArrow(_build, _INDEX_SQL), shards)


def look_up(history: History, fresh: DataFrame) -> DataFrame:
    """Grouped arrivals against the index: a row per digest of either, with its best row, its number of rows, and whether it is
    ``known`` to the history."""
    new = fresh.select("*", _shard(history.shards))
    return history.rows.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(_look_up, _VERDICT_SQL)


def verdicts(rows: DataFrame, old: Column) -> DataFrame:
    """A row per digest of ``rows`` (digest, short, anon, id, row): those where ``old`` holds are the history."""
    n = rows.count()  # of a written table
    shards = max(4 * shuffle_partitions(rows.sparkSession), -(-n // SHARD))
    past = F.coalesce(old, F.lit(False))
    return look_up(build(groups(rows.where(past)), shards), groups(rows.where(~past)))


def _rows(docs: DataFrame) -> DataFrame:
    """What is needed of each row, written once: texts are read and hashed no second time."""
    ship_code(docs.sparkSession)
    return durable(docs.select(digest_of(F.col("text")).alias("digest"), (-length_of(F.col("text"))).alias("short"), F.col("doc_id").isNull().cast("long").alias("anon"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.monotonically_increasing_id().alias("row")))


def earlier_half(rows: DataFrame) -> Column:
    """The rows up to the middle id (approximately), as if they had come in earlier runs; a scalar from a mergeable sketch."""
    middle = rows.where("anon = 0").agg(F.percentile_approx("id", 0.5, 1000)).first()[0]
    return F.lit(False) if middle is None else (F.col("anon") == 0) & (F.col("id") <= middle)


def judge(docs: DataFrame, old: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; ``old`` (of anon, id) tells the history, else the lower half
    of the ids is taken."""
    rows = _rows(docs)
    found = verdicts(rows, earlier_half(rows) if old is None else old)
    id_of = lambda anon, c: F.when(F.col(anon) == 0, F.col(c))
    told = found.select("digest", id_of("anon", "id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    return rows.join(told, "digest").select(id_of("anon", "id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, old: Column | None = None) -> DataFrame:
    """The row that stays of each group of equal texts, with all columns of ``docs``."""
    rows = _rows(docs)
    found = verdicts(rows, earlier_half(rows) if old is None else old)
    own, mark = unused(docs, "digest"), unused(docs, "short")
    best = found.select(F.col("digest").alias(own), F.col("short").alias(mark), F.when(F.col("anon") == 0, F.col("id")).alias(unused(docs, "keep")))
    met = docs.withColumn(own, digest_of(F.col("text"))).join(best, own)
    stays = (-length_of(F.col("text")) == F.col(mark)) & F.col("doc_id").eqNullSafe(F.col(unused(docs, "keep")))
    return met.where(stays).dropDuplicates([own]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s FROM documents)
SELECT doc_id, first_value(doc_id) OVER o AS keep_id, count(*) OVER (PARTITION BY s) AS group_size, row_number() OVER o = 1 AS kept, s AS text_sha256
FROM d WINDOW o AS (PARTITION BY s ORDER BY n DESC, doc_id)
"""
