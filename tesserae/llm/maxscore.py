"""Exact top-k search by integer inner product with MaxScore over shards.

A vector is a document whose terms are its dimensions; a shard keeps one list of values per dimension with the least and
largest value.  For a query, the contribution of a dimension lies between two bounds, so against its lower bound each
dimension can add at most its *gain*.  With the k-th best score so far as the threshold, the dimensions of least gain
whose gains together do not lift a vector from the lower bound over the threshold are non-essential.  The lists of the
essential ones are traversed for a block of the shard; the others are probed, largest gain first, for those vectors alone
that the gains still to come leave competitive.  The best k of all shards are merged by a limited window.

Shards hold about ``SHARD`` vectors; queries, the smaller side, travel to them in blocks of ``BLOCK`` and pass one after the other
by the shard that a task holds.  Where there are fewer shards than tasks, each is there in several copies.
With several shards each block meets one of them first, and the k-th best score there is the threshold with which the block
goes to all shards, so that most vectors elsewhere fall behind at once.  The query set is stated; copies of it are all that
grows with the number of shards.

Sums of products have to fit a long, so the wider vectors are, the smaller their components have to be (``largest``; 2**27 at
most after scaling); others are scored by Python integers, against all.  Scores are ranked exactly and returned as the nearest
long.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; other columns, whatever their names, are not read; rows with a null id take no part; of rows that share an id
the least vector counts; shorter vectors are filled up with zeros; equal scores go to the smaller id; with fewer than k
other vectors all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import durable, ship_code, shuffle_partitions, table

K, SCALE, SHARD, BLOCK, PIECE = 10, 1024, 16_384, 512, 1024
NO_FLOOR = -(1 << 63)
_PACKED = pa.schema([("at", pa.int32()), ("ids", pa.binary()), ("dims", pa.int32()), ("values", pa.binary()), ("floors", pa.binary())])
_PACKED_SQL = "at int, ids binary, dims int, values binary, floors binary"


def _pack(group: pa.Table) -> pa.Table:
    vectors = group.column("v").combine_chunks().to_pylist()
    dims = max(map(len, vectors), default=0)
    ids = np.array(group.column("id").to_pylist(), dtype=np.int64)
    x = np.zeros((len(vectors), dims), dtype=np.float64)
    for i, v in enumerate(vectors):
        x[i, : len(v)] = np.floor(SCALE * np.array(v, dtype=np.float64))
    order = np.argsort(ids, kind="stable")
    floors = np.array(group.column("floor").to_pylist(), dtype=np.int64)[order]
    return pa.Table.from_pylist([{"at": group.column("at")[0].as_py(), "ids": ids[order].tobytes(), "dims": dims, "values": x[order].tobytes(), "floors": floors.tobytes()}], schema=_PACKED)


class Shard:
    def __init__(self, ids: np.ndarray, values: np.ndarray):
        """``ids`` ascending; ``values`` one row per vector."""
        self.ids = ids
        self.lists = np.ascontiguousarray(values.T).astype(np.int64)
        self.low, self.high = (self.lists.min(axis=1), self.lists.max(axis=1)) if len(ids) else (np.zeros(0), np.zeros(0))

    def top(self, own: int, q: np.ndarray, k: int, at_least: int = NO_FLOOR) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best vectors with a score of ``at_least``, ties to the smaller id."""
        q = q.astype(np.int64)
        ends = np.stack([q * self.low, q * self.high])
        floor, gain = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
        dims = np.argsort(-gain, kind="stable")
        rest = np.concatenate([np.cumsum(gain[dims][::-1])[::-1], [0]])  # gains from the i-th dimension on
        base = int(floor.sum())
        best_at, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        threshold = None if at_least == NO_FLOOR else at_least - 1  # scores are whole numbers: a larger one is needed
        if threshold is not None and base + int(rest[0]) <= threshold:
            return best_at, best  # no vector of the shard can get there
        for a in range(0, len(self.ids), PIECE):
            b = min(a + PIECE, len(self.ids))
            here = np.arange(a, b)
            here = here[self.ids[a:b] != own]
            score = np.full(len(here), base, dtype=np.int64)
            # essential: without them a vector stays at most at the threshold
            cut = len(dims) if threshold is None else int(np.searchsorted(-(rest + base), -threshold, side="left"))
            cut = min(cut, len(dims))
            for d in dims[:cut]:
                score += q[d] * self.lists[d, here] - floor[d]
            for i in range(cut, len(dims)):
                if (i - cut) % 4 == 0:
                    alive = score + rest[i] > threshold
                    here, score = here[alive], score[alive]
                    if not len(here):
                        break
                d = dims[i]
                score += q[d] * self.lists[d, here] - floor[d]
            best_at, best = np.concatenate([best_at, here]), np.concatenate([best, score])
            order = np.lexsort((best_at, -best))[:k]  # places ascend with ids
            best_at, best = best_at[order], best[order]
            if len(best) == k:
                threshold = max(int(best[-1]), at_least - 1)  # later places lose ties: a larger score is needed
        return best_at, best


def largest(dims: int) -> int:
    """Components with which no sum over the dimensions, of scores and of what is still to come, leaves a long: a score is
    below dims * m * m, and gains are below twice that."""
    return min(1 << 27, math.isqrt((1 << 61) // max(dims, 1)))


def _usual(x: np.ndarray) -> np.ndarray:
    return (np.abs(x) <= largest(x.shape[1])).all(axis=1)


def _whole(x: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers."""
    return np.array([[int(y) for y in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def _sortable(x: int) -> bytes:
    """Bytes that sort as whole numbers of any size do: sign, length, magnitude."""
    size = (abs(x).bit_length() + 7) // 8
    key = size.to_bytes(2, "big") + abs(x).to_bytes(size, "big")
    return b"\x01" + key if x >= 0 else b"\x00" + bytes(255 - b for b in key)


class _Held:
    """One packed shard: its usual vectors by width, and the others as Python integers, made once for all queries it meets."""

    def __init__(self, ids: bytes, dims: int, values: bytes):
        self.ids, self.dims = np.frombuffer(ids, np.int64), dims
        self.values = np.frombuffer(values, np.float64).reshape(len(self.ids), dims)
        self.made: dict[int, tuple] = {}

    def wide(self, width: int) -> tuple:
        """Shard of the usual vectors, places of the others, and (lazily) exact values of all and of the others."""
        if width not in self.made:
            x = np.pad(self.values, ((0, 0), (0, width - self.dims)))
            usual = _usual(x)
            self.made = {width: (Shard(self.ids[usual], x[usual].astype(np.int32)) if usual.any() else None, np.flatnonzero(~usual), functools.cache(lambda: _whole(x)), _whole(x[~usual]))}
        return self.made[width]


def _search(k: int):
    """Sorted by shard, each shard before the query blocks that it meets: one shard is held at a time."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("exact", pa.binary())])

    def run(it):
        place, held = None, None
        for batch in it:
            for at, copy, asks, ids, dims, values, floors in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if not asks:
                    place, held = (at, copy), _Held(ids, dims, values)
                    continue
                if place != (at, copy):
                    continue  # no vector is in this shard
                qids, width = np.frombuffer(ids, np.int64), max(dims, held.dims)
                queries = np.pad(np.frombuffer(values, np.float64).reshape(len(qids), dims), ((0, 0), (0, width - dims)))
                shard, large, all_exact, large_exact = held.wide(width)
                out = []
                for own, q, easy, floor in zip(qids.tolist(), queries, _usual(queries).tolist(), np.frombuffer(floors, np.int64).tolist(), strict=True):
                    best = []
                    if easy and shard is not None:
                        near, score = shard.top(own, q.astype(np.int32), k, floor)
                        best = list(zip((-score).tolist(), shard.ids[near].tolist(), strict=True))
                    rest = large if easy else np.arange(len(held.ids))
                    if len(rest):
                        scores = (large_exact if easy else all_exact()) @ _whole(q[None])[0]
                        best += [(-x, i) for x, i in zip(scores.tolist(), held.ids[rest].tolist(), strict=True) if i != own]
                    out += [(own, i, -x) for x, i in sorted(best)[:k]]
                cols = [list(c) for c in zip(*out, strict=True)] or [[], [], []]
                order = [_sortable(x) for x in cols[2]]
                near = [min(max(x, -(1 << 63)), (1 << 63) - 1) for x in cols[2]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (cols[0], cols[1], near)), pa.array(order, pa.binary())], schema=schema)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` (vec_id, embedding) where ``is_query`` (of ``id``) holds."""
    spark = vectors.sparkSession
    ship_code(spark)
    infinite = float("inf")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (x.cast("double") < infinite) & (x.cast("double") > -infinite)
    usable = F.forall("embedding", finite)
    scaled = F.transform("embedding", lambda x: x.cast("double"))  # SCALE and floor come later: a long may not hold them
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(usable).groupBy(F.col("vec_id").cast("long").alias("id")).agg(F.min("embedding").alias("embedding")).select("id", scaled.alias("v"))
    rows = durable(rows)
    n, m = rows.count(), rows.where(is_query).count()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-m // BLOCK))
    pack = lambda df, parts: df.withColumn("at", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).groupBy("at").applyInArrow(_pack, _PACKED_SQL)
    held = pack(rows.withColumn("floor", F.lit(NO_FLOOR)), shards)
    if shards > 1:
        held = durable(held)  # met twice
    tasks = shuffle_partitions(spark)
    copies = min(-(-tasks // shards), blocks)  # of a shard: one, once there are as many shards as tasks

    def search(queries: DataFrame, to) -> DataFrame:
        """Hits of packed queries in the shards ``to`` of each block.  A shard is sent once a copy, whatever it meets."""
        columns = ["ids", "dims", "values", "floors"]
        own = held.select("at", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(False).alias("asks"), *columns)
        asked = pack(queries, blocks).select(to.alias("at"), F.pmod(F.xxhash64("ids"), F.lit(copies)).cast("int").alias("copy"), F.lit(True).alias("asks"), *columns)
        met = own.unionByName(asked).repartition(max(shards, tasks), "at", "copy").sortWithinPartitions("at", "copy", "asks")
        return met.mapInArrow(_search(k), "query_id long, vec_id long, score long, exact binary")

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("exact"), "vec_id"))
    queries = rows.where(is_query).withColumn("floor", F.lit(NO_FLOOR))
    if shards > 1:
        first = search(queries, F.pmod(F.col("at"), F.lit(shards)).cast("int"))
        kth = first.withColumn("rank", rank).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
        queries = queries.join(kth, "id", "left").select("id", "v", F.coalesce("kth", F.lit(NO_FLOOR)).alias("floor"))
    found = search(queries, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, min(embedding) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), x AS (SELECT vec_id, list_transform(e, lambda y: floor(1024 * y::DOUBLE)) AS q FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM x a JOIN x b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
