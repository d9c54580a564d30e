"""Repeated windows across documents, level by level, without one shuffled row per window.

A window of ``length`` items holds ``length - part + 1`` windows of ``part`` items; the leftmost least hash among
them is its anchor.  Equal windows have equal anchors, so it is enough to post the anchors (about one in fourteen
places for 50/25).  Each anchor is posted with the hash of the run of windows that it answers for:

* same anchor and same run in a document with a smaller id: all windows of the run are covered;
* same anchor but another run: one occurrence of each distinct run goes on to the second level, window by window.

Postings are packed per chunk of text and per shuffle partition.  Inside a chunk only the occurrences in the smallest
document of equal runs are posted, the others are settled at once; thus a run that stands in a third of all documents
costs at most one posting per chunk, and no group is ever gathered in one task.

What is found goes back packed by the partition of the documents and is gathered there to a row for each document, its
windows as stretches: rows for each document and partition of anchors would grow with both numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .runtime import durable, partitions_for, release_memory

U = np.uint64
CHUNK = 1 << 19  # postings held by a mapper
PART_BYTES = 64 << 20  # of the input for each partition of postings, which is unpacked in memory
SPAN = np.dtype([("at", "<u4"), ("n", "<u4")])
ASK = np.dtype([("g", "<u8"), ("at", "<u4"), ("n", "<u2")])
COVER, RUN, HOT = 0, 1, 2
POSTED = "part int, kind int, doc long, fp int, blob binary"
POSTED_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("doc", pa.int64()), ("fp", pa.int32()), ("blob", pa.binary())])
POST, FRAGMENT = 10, 11
PACKED = 20  # and a kind from above: packed by the partition of the documents, to be gathered there


def anchors_of(values: np.ndarray, parts: np.ndarray, length: int, part: int):
    """Anchor hash, run hash, first window and number of windows of each run.  At most SEGMENT items at once."""
    width = length - part + 1
    if not 0 < part < length or width > 255:
        raise ValueError(f"windows of {length} with parts of {part}: a run must hold 1 to 255 windows")
    place = ts.sliding_anchor(parts, width)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    count = np.diff(np.concatenate([first, [len(place)]]))
    p, end = place[first], first + count - 1 + length
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    size = ts.SEGMENT + 4096
    np.cumsum(values * ts._powers(size)[: len(values)], out=total[1:])
    shape = (count.astype(np.uint64) << U(8)) | (p - first).astype(np.uint64)
    run = ts.mix((total[end] - total[first]) * ts._powers(size, True)[first] + ts.mix(shape))
    return parts[p], run, first, count


def segments(n_windows: int) -> Iterator[tuple[int, int]]:
    step = ts.SEGMENT - 4096
    for a in range(0, n_windows, step):
        yield a, min(a + step, n_windows)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column whose rows are consecutive slices (in bytes) of ``data``."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _rows(part, kind, doc, fp, blob: pa.Array) -> pa.RecordBatch:
    n = len(blob)
    fill = lambda x, t: pa.array(np.broadcast_to(np.asarray(x, dtype=t), n))
    return pa.RecordBatch.from_arrays([fill(part, np.int32), fill(kind, np.int32), fill(doc, np.int64), fill(fp, np.int32), blob], schema=POSTED_ARROW)


def by_document(kind: int, doc: np.ndarray, fp: np.ndarray, items: np.ndarray, partitions: int = 1) -> Iterator[pa.RecordBatch]:
    """One row for each document, its items packed."""
    if not len(doc):
        return
    order = np.lexsort((fp, doc))
    doc, fp, items = doc[order], fp[order], items[order]
    at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])]))
    size = np.diff(np.concatenate([at, [len(doc)]])) * items.dtype.itemsize
    yield _rows(doc[at] % partitions, kind, doc[at], fp[at], _binary(items, size))


def cover(doc: np.ndarray, fp: np.ndarray, at: np.ndarray, n: np.ndarray, partitions: int = 1) -> Iterator[pa.RecordBatch]:
    """One row for each document: the windows found in it, as their longest stretches."""
    if not len(doc):
        return
    order = np.lexsort((at, fp, doc))
    doc, fp, at, n = doc[order], fp[order], at[order].astype(np.int64), n[order].astype(np.int64)
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])])
    base = (np.cumsum(first) - 1) << 33
    end = np.maximum.accumulate(base + at + n)
    begin = np.flatnonzero(first | np.concatenate([[True], (base + at)[1:] > end[:-1]]))
    spans = np.empty(len(begin), dtype=SPAN)
    spans["at"] = at[begin]
    spans["n"] = end[np.concatenate([begin[1:], [len(at)]]) - 1] - base[begin] - at[begin]
    yield from by_document(COVER, doc[begin], fp[begin], spans, partitions)


def to_documents(kind: int, doc: np.ndarray, fp: np.ndarray, g: np.ndarray | None, at: np.ndarray, count: np.ndarray, partitions: int) -> Iterator[pa.RecordBatch]:
    """A row for each partition of the documents: a document in many partitions of anchors would be a row in each."""
    to = doc % partitions
    order = np.lexsort((fp, doc, to))
    to = to[order]
    cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]])) if len(order) else []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        k = order[a:b]
        start = np.flatnonzero(np.concatenate([[True], (doc[k][1:] != doc[k][:-1]) | (fp[k][1:] != fp[k][:-1])]))
        nothing = np.zeros(b - a, dtype=np.uint64)
        blob = _pack(doc[k][start], fp[k][start], np.diff(np.concatenate([start, [b - a]])), nothing if g is None else g[k], nothing, at[k], count[k].astype(np.uint8))
        yield _rows([to[a]], PACKED + kind, 0, 0, pa.array([blob], pa.binary()))


class Poster:
    """Collects the postings of a chunk of documents and packs them by partition."""

    def __init__(self, partitions: int, meet: bool = False):
        """``meet``: anchors alone, without runs; then the run of a posting tells whether it was met again in its chunk."""
        self.partitions, self.meet, self.held, self.docs = partitions, meet, 0, []

    def add(self, doc: int, fp: int, g: np.ndarray, run: np.ndarray, at: np.ndarray, count: np.ndarray) -> None:
        self.docs.append((doc, fp, g, run, at.astype(np.uint32), count.astype(np.uint8)))
        self.held += len(g)

    def full(self) -> bool:
        return self.held >= CHUNK

    def flush(self) -> Iterator[pa.RecordBatch]:
        docs, self.docs, self.held = sorted(self.docs, key=lambda x: x[:2]), [], 0
        if not docs:
            return
        g, run, at, count = (np.concatenate([d[k] for d in docs]) for k in (2, 3, 4, 5))
        ids, fps = np.array([d[0] for d in docs], dtype=np.int64), np.array([d[1] for d in docs], dtype=np.int32)
        of = np.repeat(np.arange(len(docs), dtype=np.uint32), [len(d[2]) for d in docs])
        both = ts.mix(g ^ (run * ts._A))
        order = np.argsort(both, kind="stable")
        both = both[order]
        start = np.maximum.accumulate(np.where(np.concatenate([[True], both[1:] != both[:-1]]), np.arange(len(order)), 0))
        settled = np.zeros(len(order), dtype=bool)
        settled[order] = ids[of[order]] > ids[of[order[start]]]
        if self.meet:
            run = np.zeros(len(run), dtype=np.uint64)
            run[order[start[settled[order]]]] = 1
        del both, start, order
        if settled.any():
            yield from cover(ids[of[settled]], fps[of[settled]], at[settled], count[settled], self.partitions)
        keep = np.flatnonzero(~settled)
        # an anchor is a least hash, so its bits are not even: mix them anew
        bucket = (((ts.mix(g[keep] ^ ts._B) >> U(32)) * U(self.partitions)) >> U(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keep, bucket = keep[order], bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(keep) else []
        parts, blobs = [], []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            k = keep[a:b]
            d, n = np.unique(of[k], return_counts=True)
            gk, rk = g[k], run[k]
            parts.append(bucket[a])
            blobs.append(_pack(ids[d], fps[d], n, gk, rk, at[k], count[k]))
            if len(blobs) == 64:
                yield _rows(parts, POST, 0, 0, pa.array(blobs, pa.binary()))
                parts, blobs = [], []
        if blobs:
            yield _rows(parts, POST, 0, 0, pa.array(blobs, pa.binary()))


def _planes(x: np.ndarray) -> list[np.ndarray]:
    """Lower and upper halves of 32-bit numbers apart: the upper ones, mostly zero, then compress to nothing."""
    return [x.astype(np.uint16), (x >> 16).astype(np.uint16)]


def _pack(ids, fps, n, g, run, at, count) -> bytes:
    """Documents (ascending: gaps between ids) with their numbers of postings, then the postings."""
    gaps = np.diff(ids, prepend=ids[:1])
    wide = bool(gaps.max() >> 32)
    head = np.array([len(ids), len(g), wide], dtype=np.uint32), ids[:1]
    parts = [*head, *([gaps] if wide else _planes(gaps)), fps, *_planes(n), g.astype(np.uint32), (g >> U(32)).astype(np.uint16), run.astype(np.uint32), (run >> U(32)).astype(np.uint8), *_planes(at), count]
    return b"".join(x.tobytes() for x in parts)


def _unpack(blobs: list[bytes]):
    cols = [[] for _ in range(6)]
    for blob in blobs:
        nd, n, wide = np.frombuffer(blob, np.uint32, 3)
        o = 12

        def take(t, k, blob=blob):
            nonlocal o
            out = np.frombuffer(blob, t, k, o)
            o += out.nbytes
            return out

        def planes(k, take=take):
            low = take(np.uint16, k).astype(np.uint32)
            return low | (take(np.uint16, k).astype(np.uint32) << 16)

        first = take(np.int64, 1)
        ids = first + np.cumsum(take(np.int64, nd) if wide else planes(nd).astype(np.int64))
        fps, rep = take(np.int32, nd), planes(nd)
        g = take(np.uint32, n).astype(np.uint64) | (take(np.uint16, n).astype(np.uint64) << U(32))
        run = take(np.uint32, n).astype(np.uint64) | (take(np.uint8, n).astype(np.uint64) << U(32))
        for c, x in zip(cols, (np.repeat(ids, rep), np.repeat(fps, rep), g, run, planes(n), take(np.uint8, n)), strict=True):
            c.append(x)
    return [np.concatenate(c) for c in cols]


def settle(blobs: list[bytes], hot_runs: int, partitions: int) -> Iterator[pa.RecordBatch]:
    """Covered runs, and one occurrence of each of several runs at one anchor, of a partition's postings."""
    if not blobs:
        return
    doc, fp, g, run, at, count = _unpack(blobs)
    blobs.clear()
    order = np.lexsort((doc, run, g))
    doc, fp, g, run, at, count = (x[order] for x in (doc, fp, g, run, at, count))
    new_g = np.concatenate([[True], g[1:] != g[:-1]])
    new_run = new_g | np.concatenate([[True], run[1:] != run[:-1]])
    of_g, of_run = np.cumsum(new_g) - 1, np.cumsum(new_run) - 1
    at_g, at_run = np.flatnonzero(new_g), np.flatnonzero(new_run)
    covered = doc > doc[at_run][of_run]
    runs = np.bincount(of_g[at_run], minlength=len(at_g))
    several = (runs > 1) & (np.minimum.reduceat(doc, at_g) < np.maximum.reduceat(doc, at_g))
    yield from to_documents(COVER, doc[covered], fp[covered], None, at[covered], count[covered], partitions)
    for kind, those in ((RUN, runs <= hot_runs), (HOT, runs > hot_runs)):
        ask = ~covered & (several & those)[of_g]
        yield from to_documents(kind, doc[ask], fp[ask], g[ask], at[ask], count[ask], partitions)


def meeter(partitions: int):
    """The windows of all anchors that stand in several documents, the first of them included."""

    def reduce(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        yield from sort_kinds(it, held)
        if blobs := held.pop(POST, None):
            doc, fp, g, met, at, count = _unpack(blobs)
            blobs.clear()
            order = np.argsort(g, kind="stable")
            new = np.concatenate([[True], g[order][1:] != g[order][:-1]])
            first, of = np.flatnonzero(new), np.cumsum(new) - 1
            several = (np.minimum.reduceat(doc[order], first) < np.maximum.reduceat(doc[order], first)) | (np.maximum.reduceat(met[order], first) > 0)
            keep = order[several[of]]
            yield from to_documents(COVER, doc[keep], fp[keep], None, at[keep], count[keep], partitions)
        release_memory()

    return reduce


def gather(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document and kind of what was sent to its partition."""
    held: dict[int, list[bytes]] = {}
    yield from sort_kinds(it, held)
    for packed in sorted(held):
        doc, fp, g, _, at, count = _unpack(held.pop(packed))
        if packed == PACKED + COVER:
            yield from cover(doc, fp, at, count)
        else:
            items = np.empty(len(doc), dtype=ASK)
            items["g"], items["at"], items["n"] = g, at, count
            yield from by_document(packed - PACKED, doc, fp, items)
        del doc, fp, g, at, count
    release_memory()


def deal(posted: DataFrame, partitions: int, reducer: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Every packed row to its partition, and the reducer over each partition."""
    return posted.repartitionById(partitions, F.col("part")).mapInArrow(reducer, POSTED)


def sort_kinds(it: Iterator[pa.RecordBatch], held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Passes what is settled; holds the packed postings by kind."""
    for b in it:
        kinds = b.column("kind").to_numpy(zero_copy_only=False)
        for k in np.unique(kinds):
            if k < POST:
                yield b.filter(pa.array(kinds == k))
            else:
                held.setdefault(int(k), []).extend(b.column("blob").filter(pa.array(kinds == k)).to_pylist())


def settler(hot_runs: int, partitions: int):
    def reduce(it):
        held: dict[int, list[bytes]] = {}
        yield from sort_kinds(it, held)
        yield from settle(held.get(POST, []), hot_runs, partitions)
        release_memory()

    return reduce


def repeated_spans(docs: DataFrame, doc_id: Column, text: Column, post_level1, post_level2, reduce_level2, hot_runs: int, levels_before=()) -> DataFrame:
    """``docs`` as ``__doc``, ``__text``, ``__fp`` and its other columns, with ``__spans``: packed (first item, number)
    of the windows that also start in a document with a smaller id.

    ``post_level1(partitions)`` and ``post_level2(partitions)`` give the Arrow mappers, ``reduce_level2(partitions)`` the
    reducer of the second level.  Rows without an id take no part and get no spans.  The second level and the answer read ``docs``
    dealt by the same keys, so that Spark moves the texts once.

    ``levels_before``: mappers of shorter windows, each given what is left of the one before (packed windows, null: none; the
    first: all); with them, ``post_level1`` too is given what is left.  Once nothing is left, no text is read again.
    """
    if taken := {c for c in docs.columns if c.lower() in ("__doc", "__text", "__fp", "__spans", "__asks", "__left")}:
        raise ValueError(f"columns of these names are in use here: {sorted(taken)}")
    n = partitions_for(docs, PART_BYTES)
    keyed = docs.withColumns({"__doc": doc_id.cast("long"), "__text": text, "__fp": F.hash(text)})
    grouped = lambda df, *what: df.groupBy(F.col("doc").alias("__doc"), F.col("fp").alias("__fp")).agg(*what)
    texts = keyed.where("__doc is not null and __text is not null").select("__doc", "__fp", "__text")
    rows = texts
    for post in levels_before:
        left = durable(deal(deal(rows.mapInArrow(post(n), POSTED), n, meeter(n)), n, gather))
        if left.isEmpty():
            return keyed.withColumn("__spans", F.lit(None).cast("array<binary>"))
        rows = texts.join(grouped(left, F.collect_list("blob").alias("__left")), ["__doc", "__fp"]).select("__doc", "__fp", "__text", "__left")
    answers = durable(deal(deal(rows.mapInArrow(post_level1(n), POSTED), n, settler(hot_runs, n)), n, gather))
    asked = grouped(answers.where(F.col("kind") != COVER), F.collect_list(F.struct("kind", "blob")).alias("__asks"))
    wanted = keyed.join(asked, ["__doc", "__fp"], "left").select("__doc", "__fp", F.when(F.col("__asks").isNotNull(), F.col("__text")).alias("__text"), "__asks")
    found = deal(deal(wanted.mapInArrow(post_level2(n), POSTED), n, reduce_level2(n)), n, gather)
    spans = grouped(answers.where(F.col("kind") == COVER).unionByName(found), F.collect_list("blob").alias("__spans"))
    return keyed.join(spans, ["__doc", "__fp"], "left")


def windows_left(blobs: list[bytes], n_windows: int) -> np.ndarray:
    """Mask of the windows in packed spans."""
    return covered_items(blobs, n_windows, 1)


def stretches(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    """First place and end of each run of places that are set."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    yield from zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)


def covered_items(blobs: list[bytes] | None, n_items: int, length: int) -> np.ndarray:
    """Mask of the items inside a covered window."""
    depth = np.zeros(n_items + 1, dtype=np.int32)
    for blob in () if blobs is None else blobs:
        s = np.frombuffer(blob, SPAN)
        np.add.at(depth, s["at"], 1)
        np.add.at(depth, s["at"] + s["n"] + np.uint32(length - 1), -1)
    return np.cumsum(depth[:-1]) > 0


def batches(it: Iterator[pa.RecordBatch], poster: Poster, one_row) -> Iterator[pa.RecordBatch]:
    for b in it:
        for row in zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True):
            one_row(*row)
            if poster.full():
                yield from poster.flush()
    release_memory()
    yield from poster.flush()
    release_memory()
