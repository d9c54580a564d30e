"""Ranked lexical search over impact-ordered postings, a score at a time.

Documents are indexed block by block (one Arrow batch of documents) where they lie: the tokens of whole texts are counted, and
the postings of the terms that are asked for are written as packed arrays, without a shuffle.  Document frequencies, the number
of documents and of tokens are sums over all blocks.  In a block the postings of a term are grouped by their exact impact; a
query takes the groups of its terms from the highest impact down.  What the groups that are left can add to one document is at
most the sum of the next impact of each term.  It stops only when that sum is below the k-th best score (of this block so far,
or of earlier blocks of the task): then no unseen document can enter, and the documents that could still reach the k-th score
get their complete scores from the block's postings in document order.  Tasks keep k documents per query, and these are merged
in two rounds.

Queries are sent to the tasks in groups of at most ``QUERY_BYTES`` of text (or one longer query); more of them take more passes.

Defined cases: texts without terms, null ones too, are no documents and never listed; queries without terms have no rows; rows
that share an id are documents of their own, each listed, and likewise repeated queries; equal scores go by ascending id, null
ids last.  Other columns are not read.  Texts of any length are counted whole.  Empty tables have an empty result.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import durable, remove_folder, shared_folder, ship_code, table

K = 20
QUERY_BYTES = 8 << 20
#: Postings of a query's first round; each further round takes twice as many before the bounds are looked at.
FIRST_ROUND = 256
#: A query stops when no more documents than so many times k could reach the k-th score.
COMPLETE = 16
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # of UTF-8
_BLOCK = pa.schema([("docs", pa.int64()), ("tokens", pa.int64()), ("seen", pa.list_(pa.int32())), ("df", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("ids", "anon", "sizes", "term", "doc", "tf"))])
_BLOCK_SQL = "docs long, tokens long, seen array<int>, df array<long>, ids binary, anon binary, sizes binary, term binary, doc binary, tf binary"
_HIT = pa.schema([("query", pa.int32()), ("score", pa.int64()), ("anon", pa.bool_()), ("id", pa.int64())])
_HIT_SQL = "query int, score long, anon boolean, id long"


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and what is not ASCII; A-Z alone are lower-cased."""
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _index(vocabulary):
    """Packs batches of (doc_id, text)."""

    def run(it):
        place = vocabulary.value
        for batch in it:
            ids, sizes, doc, term, tf = [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = Counter(terms(text))
                if not counts:
                    continue
                asked = [(place[w], n) for w, n in counts.items() if w in place]
                term += [t for t, _ in asked]
                tf += [n for _, n in asked]
                doc += [len(ids)] * len(asked)
                ids.append(key)
                sizes.append(sum(counts.values()))
            term, doc, tf = np.array(term, np.int32), np.array(doc, np.int32), np.array(tf, np.int64)
            seen, df = np.unique(term, return_counts=True)
            packed = (np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids], bool), np.array(sizes, np.int64), term, doc, tf)
            yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([sum(sizes)]), pa.array([seen.tolist()], _BLOCK.types[2]), pa.array([df.tolist()], _BLOCK.types[3]), *(pa.array([x.tobytes()]) for x in packed)], schema=_BLOCK)

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(sizes: np.ndarray, n_docs: int, n_tokens: int) -> np.ndarray:
    """m of each document; whole numbers of any size in between."""
    own, back = np.unique(sizes, return_inverse=True)
    return np.array([75 + 25 * x * n_docs // n_tokens for x in own.tolist()], np.int64)[back]


class Block:
    """Postings of some documents, in groups of one term and one impact, and in the order of documents."""

    def __init__(self, sizes, term, doc, tf, n_docs: int, n_tokens: int):
        gain = 1_000_000_000 * tf // (1000 * tf + 12 * norms(sizes, n_docs, n_tokens)[doc])
        self.n, self.added = len(sizes), 0
        self.start = np.searchsorted(doc, np.arange(self.n + 1))  # postings come in the order of documents
        self.term, self.gain = term, gain
        order = np.lexsort((-gain, term))
        self.doc = doc[order]
        t, g = term[order], gain[order]
        first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (g[1:] != g[:-1])])) if len(t) else np.zeros(0, np.int64)
        self.first, self.end = first, np.append(first[1:], len(t))
        self.group_term, self.group_gain = t[first], g[first]

    def complete(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Whole scores of documents that have postings."""
        size = self.start[docs + 1] - self.start[docs]
        at = np.repeat(self.start[docs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.add.reduceat(weights[self.term[at]] * self.gain[at], np.cumsum(size) - size) if len(docs) else np.zeros(0, np.int64)

    def top(self, asked: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the k best, with their scores: all that have the k-th score or ``floor`` at least.

        ``asked``: terms of the query, ascending; ``weights``: of all terms, times their number in the query, else 0.
        """
        lo, hi = np.searchsorted(self.group_term, asked, "left"), np.searchsorted(self.group_term, asked, "right")
        count = hi - lo
        group = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        owner = np.repeat(np.arange(len(asked)), count)
        impact = self.group_gain[group] * weights[self.group_term[group]]
        order = np.argsort(-impact, kind="stable")
        group, owner, impact = group[order], owner[order], impact[order]
        size = self.end[group] - self.first[group]
        upto = np.cumsum(size)
        score, done, room = np.zeros(self.n, np.int64), 0, FIRST_ROUND
        while done < len(group):
            last = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + room, "right")))
            s = size[done:last]
            at = np.repeat(self.first[group[done:last]] - (np.cumsum(s) - s), s) + np.arange(s.sum())
            np.add.at(score, self.doc[at], np.repeat(impact[done:last], s))
            self.added += len(at)
            done, room = last, 2 * room
            if done == len(group):
                break
            _, nxt = np.unique(owner[done:], return_index=True)  # the first group that each term still has
            rest = int(impact[done:][nxt].sum())
            bar = max(floor, int(np.partition(score, self.n - k)[self.n - k]) if self.n >= k else 0)
            if rest < bar:
                may = np.flatnonzero(score + rest >= bar)
                if len(may) <= COMPLETE * k:
                    may = may[score[may] > 0]
                    return may, self.complete(may, weights)
        found = np.flatnonzero(score)
        return found, score[found]


def _search(queries, k: int, n_docs: int, n_tokens: int):
    """The k best documents of a task's blocks for each query."""

    def run(it):
        asked, weights, width = queries.value
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in asked]
        of_term = np.zeros(width, np.int64)
        for batch in it:
            for raw in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                ids, anon, sizes, term, doc, tf = (np.frombuffer(x, t) for x, t in zip(raw, (np.int64, bool, np.int64, np.int32, np.int32, np.int64), strict=True))
                block = Block(sizes, term, doc, tf, n_docs, n_tokens)
                for q, own in enumerate(asked):
                    of_term[own] = weights[q]
                    score, null, key = best[q]
                    at, more = block.top(own, of_term, k, int(score[k - 1]) if len(score) >= k else 0)
                    of_term[own] = 0
                    good = more > 0
                    at = at[good]
                    score, null, key = np.concatenate([score, more[good]]), np.concatenate([null, anon[at]]), np.concatenate([key, ids[at]])
                    order = np.lexsort((key, null, -score))[:k]
                    best[q] = score[order], null[order], key[order]
        for q, (score, null, key) in enumerate(best):
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), q, np.int32)), pa.array(score), pa.array(null), pa.array(key)], schema=_HIT)

    return run


def _ranked(hits: DataFrame, by: list, k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "anon", "id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _pass(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """The k best documents of some queries (item_id, text)."""
    spark = docs.sparkSession
    counts = [Counter(terms(text)) for _, text in items]
    place = {w: i for i, w in enumerate(sorted(set().union(*counts)))}
    folder = f"{shared_folder(spark)}/impacts-{uuid.uuid4().hex}"
    words = spark.sparkContext.broadcast(place)
    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_index(words), _BLOCK_SQL).write.parquet(folder)
    blocks = spark.read.parquet(folder)
    n_docs, n_tokens, n_blocks = (int(x or 0) for x in blocks.agg(F.sum("docs"), F.sum("tokens"), F.count("*")).first())
    df = dict(blocks.select(F.explode(F.arrays_zip("seen", "df")).alias("x")).groupBy("x.seen").agg(F.sum("x.df")).collect())  # one row per term asked for
    asked = [np.array(sorted(place[w] for w in c), np.int32) for c in counts]
    gains = [np.array([n * weight(n_docs, df.get(t, 0)) for t, n in sorted((place[w], n) for w, n in c.items())], np.int64) for c in counts]
    sent = spark.sparkContext.broadcast((asked, gains, max(1, len(place))))
    hits = blocks.select("ids", "anon", "sizes", "term", "doc", "tf").mapInArrow(_search(sent, k, n_docs, n_tokens), _HIT_SQL)
    salt = F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(n_blocks))))
    some = _ranked(hits.withColumn("salt", salt), ["query", "salt"], k).drop("rank", "salt")
    names = spark.createDataFrame([(q, key) for q, (key, _) in enumerate(items)], "query int, item_id long")
    out = durable(_ranked(some, ["query"], k).join(F.broadcast(names), "query").select("item_id", "rank", F.when(~F.col("anon"), F.col("id")).alias("doc_id"), "score"))
    remove_folder(spark, folder)
    words.destroy()
    sent.destroy()
    return out


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    ship_code(spark)
    asked = durable(items.select(F.col("item_id").cast("long").alias("item_id"), "text", F.monotonically_increasing_id().alias("row")))
    n, size = asked.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    passes = max(1, -(-(n * 16 + (size or 0)) // QUERY_BYTES))
    found = None
    for p in range(passes if n else 0):
        some = [(r[0], r[1]) for r in asked.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == p).select("item_id", "text").collect()]
        if some:
            one = _pass(docs, some, k)
            found = one if found is None else found.union(one)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH q AS MATERIALIZED (SELECT item_id, w, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS w FROM benchmark) GROUP BY ALL),
d AS MATERIALIZED (SELECT doc_id, {_TERMS} AS ws FROM documents),
s AS MATERIALIZED (SELECT count(*) FILTER (WHERE len(ws) > 0) AS n, sum(len(ws))::BIGINT AS l FROM d),
p AS MATERIALIZED (SELECT doc_id, len(ws) AS n, w, count(*) AS tf FROM (SELECT doc_id, ws, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM q) GROUP BY ALL),
f AS MATERIALIZED (SELECT w, CAST(floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS g FROM p, s GROUP BY w, s.n),
x AS (SELECT item_id, doc_id, CAST(sum(c * g * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * p.n * s.n) // s.l)))) AS BIGINT) AS score
  FROM q JOIN p USING (w) JOIN f USING (w), s GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT * FROM r WHERE rank <= {K}
"""
