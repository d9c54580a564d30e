"""MinHash near-deduplication by a signature-coordinate inverted join.

Every document has ``COORDINATES`` MinHash values of its set of word shingles.  Documents with equal sets form a class
and are represented by one of them.  Each representative is posted under its coordinate-value pairs; two sets of the
wanted similarity collide in at least ``MATCHES`` of the coordinates (all but 4.6 pairs in a million at exactly
0.75).  Collisions are counted with two savings: a *prefix* - pairs are ordered by global frequency, and only the
``COORDINATES - MATCHES + 1`` rarest of a representative are merged, since two lists with so many collisions meet
there - and *skips* - values that nobody shares and representatives with too few shared values never enter a merge, and
of a merged list only pairs not yet known to be linked are looked at.

A list is merged against its most central member first, which links most near copies at the cost of the list's length.
The other members are compared among themselves only in lists that still join unlinked parts: signatures in packed blocks,
which write down few pairs; where near pairs would be many, the families of such lists are compared on their full sets
inside the blocks, and only links that join parts come out.  So every pair that meets in a list is either compared or
already linked, and no group's pairs become rows.  Pairs above the match threshold are confirmed on the full sets.

Defined cases: texts without words (or null) have size 0 and are linked with nothing; texts shorter than a shingle are
one shingle; rows with a null id are returned with their size, a null component and ``kept``; rows that share an id are
one document (also those without words among them: their component is the id's); other columns, whatever their names, are
not read; an empty table gives an empty result.

Hot keys: counts and hubs are aggregates with a map-side part; the joins on a token or a hub have one row on one side, so
that adaptive execution splits the other side where a key is hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .components import components
from .runtime import durable, shielded, ship_code, table

U = np.uint64
SHINGLE, THRESHOLD = 5, 75  # words; percent
COORDINATES, MATCHES = 64, 32
PREFIX = COORDINATES - MATCHES + 1
BLOCK, DENSE_BLOCK = 1024, 256  # members compared at once: signatures, full sets
NEAR_EACH, NEAR_MORE = 8, 256  # near pairs of a block that are written down, by member and beside; beyond: full sets in place


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; the whole sequence where it is shorter than one."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    _, _, h = ts.words(text.encode(), lower=True)
    if 0 < len(h) < size:
        return ts.windows(h, len(h))
    return np.unique(ts.windows(h, size))


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, mixed to 32 bits each."""
    k = np.arange(1, COORDINATES + 1, dtype=np.uint64)
    salt, factor = ts.mix(k * ts._A)[:, None], (ts.mix(k * ts._B) | U(1))[:, None]
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(shingles), 2048):
        least = np.minimum(least, ((shingles[None, a : a + 2048] ^ salt) * factor).min(axis=1))
    return ts.mix(least).astype(np.uint32)


_SIGNED = "doc long, n long, set1 long, set2 long, sig binary"


def _sign(size: int):
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()), ("sig", pa.binary())])

    def run(it):
        for b in it:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingle_set(text, size)
                if len(s):
                    key = (int(ts.mix(s).sum(dtype=np.uint64).astype(np.int64)), int(ts.mix(s ^ ts._A).sum(dtype=np.uint64).astype(np.int64)))
                    out.append((doc, len(s), *key, signature(s).tobytes() if doc is not None else None))
                else:
                    out.append((doc, 0, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)

    return run


@F.pandas_udf(T.ArrayType(T.LongType()))
def _tokens(sigs):
    """Coordinate-value pairs as longs."""
    import pandas as pd

    at = np.arange(COORDINATES, dtype=np.int64) << 32
    return pd.Series([at | np.frombuffer(s, np.uint32).astype(np.int64) for s in sigs])


@F.pandas_udf(T.IntegerType())
def _collisions(a, b):
    import pandas as pd

    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint32).reshape(-1, COORDINATES) for s in (a, b))
    return pd.Series((x == y).sum(axis=1).astype(np.int32))


def _confirm(threshold: int, size: int):
    """Keeps the pairs whose full sets are similar enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(it):
        known: dict[int, np.ndarray] = {}
        for batch in it:
            ca, cb, ta, tb = (batch.column(k) for k in range(4))
            keep_a, keep_b = [], []
            for a, b, x, y in zip(ca.to_pylist(), cb.to_pylist(), ta.to_pylist(), tb.to_pylist(), strict=True):
                if a not in known:
                    if len(known) > 64:
                        known.clear()
                    known[a] = shingle_set(x, size)
                p, q = known[a], shingle_set(y, size)
                both = int(np.isin(q, p, assume_unique=True).sum()) if len(p) and len(q) else 0
                if 100 * both >= threshold * (len(p) + len(q) - both) and both:
                    keep_a.append(a)
                    keep_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.int64()), pa.array(keep_b, pa.int64())], schema=schema)

    return run


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (columns doc_id and text are read)."""
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text"))
    signed = durable(texts.mapInArrow(_sign(shingle), _SIGNED))
    sets = signed.where("doc is not null and n > 0")
    classes = durable(sets.groupBy("set1", "set2").agg(F.min("doc").alias("rep"), F.first("sig").alias("sig")))

    tokens = classes.select("rep", F.explode(_tokens("sig")).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("freq")).where("freq > 1")
    ranked = tokens.join(shared, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("held"), F.sum("freq").alias("central"))
    merged = durable(ranked.where(F.size("held") >= MATCHES).select("rep", "central", F.explode(F.slice("held", 1, F.size("held") - (MATCHES - 1))).alias("x")).select("rep", "central", F.col("x.token").alias("token")))
    # only lists with two members can give a pair
    members = merged.select("rep").distinct()
    sigs = durable(classes.join(members, "rep").select("rep", "sig"))
    full = durable(texts.where("doc is not null").join(members.withColumnRenamed("rep", "doc"), "doc").join(
        # a repeated id may have other texts: keep the one of the class
        classes.select(F.col("rep").alias("doc"), "set1", "set2"), "doc").mapInArrow(_same_set(shingle), "rep long, body string").dropDuplicates(["rep"]))

    # ids whose rows differ, rows without words included; a set's sum of hashes is none of 0 rows
    several_texts = durable(signed.where("doc is not null").groupBy("doc").agg(F.count_distinct(F.coalesce("set1", F.lit(0)), F.coalesce("set2", F.lit(0))).alias("n")).where("n > 1").select("doc"))
    alias_links = sets.join(several_texts, "doc").join(classes.select("set1", "set2", "rep"), ["set1", "set2"]).select(F.col("doc").alias("a"), F.col("rep").alias("b")).where("a <> b")
    links = alias_links.distinct()
    verify = lambda pairs: _texts(pairs, full).mapInArrow(_confirm(threshold, shingle), "a long, b long")

    # 1. every list against its most central member
    hubs = merged.groupBy("token").agg(F.min(F.struct(-F.col("central"), "rep")).alias("x"), F.count("*").alias("size")).where("size > 1").select("token", F.col("x.rep").alias("hub"), "size")
    lists = durable(merged.select("token", "rep").join(hubs, "token"))
    pairs = lists.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    near = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").where(_collisions("sa", "sb") >= MATCHES).select("a", "b")
    links = durable(links.unionByName(verify(near)))
    labels = components(links)

    # 2. the other members of a list among themselves, where they are not linked yet
    now = lists.where("rep <> hub and size > 2").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("token", "rep", "size", F.coalesce("component", "rep").alias("component"))
    still = now.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
    rest = durable(now.join(still, "token"))
    packed = _in_blocks(rest.join(sigs, "rep"), "token", BLOCK, F.struct("rep", "component", "sig"))
    found = durable(packed.mapInArrow(_near_pairs, "token long, a long, b long"))
    links = links.unionByName(verify(found.where("a is not null").select("a", "b").distinct()))

    # 3. lists with too many near pairs to write down: their families, in blocks, on the full sets
    dense = rest.join(found.where("a is null").select("token").distinct(), "token").select("token", "rep", "component")
    if not dense.isEmpty():
        first = dense.groupBy("token").agg(F.min("rep").alias("a"))
        family = components(dense.join(first, "token").select("a", F.col("rep").alias("b")).where("a <> b").distinct())
        family = family.select(F.col("component").alias("token"), F.col("node").alias("rep")).join(dense.select("rep", "component").distinct(), "rep")
        sizes = family.groupBy("token").agg(F.count("*").alias("size"))
        packed = _in_blocks(family.join(sizes, "token").join(full, "rep"), "token", DENSE_BLOCK, F.struct("rep", "component", "body"))
        links = links.unionByName(packed.mapInArrow(_link_block(threshold, shingle), "a long, b long"))
    labels = components(links)

    of_class = classes.select("set1", "set2", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("set1", "set2", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc", "n", "set1", "set2").join(of_class, ["set1", "set2"], "left")
    shared = several_texts.join(labels.withColumnRenamed("node", "doc"), "doc").select("doc", F.col("component").alias("of_doc"))
    out = out.join(shared, "doc", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("of_doc", "component_id", "doc"))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def _texts(pairs: DataFrame, full: DataFrame) -> DataFrame:
    return pairs.join(full.select(F.col("rep").alias("b"), F.col("body").alias("tb")), "b").join(full.select(F.col("rep").alias("a"), F.col("body").alias("ta")), "a").select("a", "b", "ta", "tb")


def _in_blocks(rows: DataFrame, key: str, block: int, packed) -> DataFrame:
    """One row for each pair of blocks of a key's rows (``size`` of them): key, whether it is one block, and both packed."""
    n = F.ceil(F.col("size") / block).cast("int")
    mine = F.pmod(F.xxhash64("rep"), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("__n") - 1))
    dealt = rows.withColumns({"__n": n, "__mine": mine}).withColumn("__other", other)
    i, j = F.least("__mine", "__other"), F.greatest("__mine", "__other")
    return dealt.groupBy(key, i.alias("i"), j.alias("j")).agg(F.collect_list(packed).alias("members")).select(key, "members")


def _near_pairs(it):
    """Pairs of different components that collide often enough; a row without a pair where there are too many."""
    schema = pa.schema([("token", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
    for batch in it:
        out = []
        for token, members in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            m = members.values
            rep, part = (m.field(k).to_numpy() for k in (0, 1))
            if (part == part[0]).all():
                continue
            sig = np.frombuffer(b"".join(m.field(2).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            most, mine = NEAR_EACH * len(rep) + NEAR_MORE, []
            for i in range(len(rep) - 1):
                hit = np.flatnonzero(part[i + 1 :] != part[i]) + i + 1
                hit = hit[(sig[hit] == sig[i]).sum(axis=1) >= MATCHES]
                mine += [(token, min(int(rep[i]), int(r)), max(int(rep[i]), int(r))) for r in rep[hit]]
                if len(mine) > most:
                    mine = [(token, None, None)]
                    break
            out += mine
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], schema=schema)


def _link_block(threshold: int, size: int):
    """Links between members of different components that join parts not yet joined in the block."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(it):
        for batch in it:
            out = []
            for members in batch.column(1):
                m = members.values
                rep, part = (m.field(k).to_pylist() for k in (0, 1))
                sets = [shingle_set(t, size) for t in m.field(2).to_pylist()]
                length = np.array([len(x) for x in sets])
                keys, column = np.unique(np.concatenate(sets), return_inverse=True)
                row = np.repeat(np.arange(len(sets)), length)
                order = np.argsort(column, kind="stable")
                holders = row[order]
                begin = np.searchsorted(column[order], np.arange(len(keys) + 1))
                first = np.concatenate([[0], np.cumsum(length)])
                parent = {p: p for p in part}

                def root(p, parent=parent):
                    while parent[p] != p:
                        parent[p] = p = parent[parent[p]]
                    return p

                for i in range(len(sets)):
                    mine = column[first[i] : first[i + 1]]
                    both = np.bincount(np.concatenate([holders[begin[c] : begin[c + 1]] for c in mine]), minlength=len(sets))
                    for j in np.flatnonzero(100 * both >= threshold * (length + length[i] - both)).tolist():
                        if j > i and (x := root(part[i])) != (y := root(part[j])):
                            parent[max(x, y)] = min(x, y)
                            out.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(2)], schema=schema)

    return run


def _same_set(size: int):
    schema = pa.schema([("rep", pa.int64()), ("body", pa.string())])

    def run(it):
        for b in it:
            ids, bodies = [], []
            for doc, text, s1, s2 in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                s = shingle_set(text, size)
                if int(ts.mix(s).sum(dtype=np.uint64).astype(np.int64)) == s1 and int(ts.mix(s ^ ts._A).sum(dtype=np.uint64).astype(np.int64)) == s2:
                    ids.append(doc)
                    bodies.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.string())], schema=schema)

    return run


def keep_one(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the near copies: the document with the smallest id of each component stays (and rows without id)."""
    safe, back = shielded(docs, "doc_id", "text")
    gone = near_duplicates(safe, threshold, shingle).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return back(safe.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
