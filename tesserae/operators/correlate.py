"""Phase correlation: of volumes held as flat arrays, and of stored ones by reference."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as k
from ..sources.volumes import read_volume
from .tasks import placed_tasks

_OFFSET = "key string, dz int, dy int, dx int"
_SCHEMA = pa.schema([("key", pa.string()), ("dz", pa.int32()), ("dy", pa.int32()), ("dx", pa.int32())])


def offsets(tasks: DataFrame, shape: tuple[int, int, int], precision: str = "float64") -> DataFrame:
    """key, dz, dy, dx for ``tasks(key, src, dst, axis, shift_px)``; axis 0 is a drift over the whole volume.

    Every row is worked on where it lies; nothing is grouped or shuffled for it.
    """

    def run(it):
        for b in it:
            keys, src, dst, axis, shift = (b.column(c).to_pylist() for c in ("key", "src", "dst", "axis", "shift_px"))
            out = []
            for key, x, y, a, s in zip(keys, src, dst, axis, shift, strict=True):
                x, y = (np.asarray(v, dtype=precision).reshape(shape) for v in (x, y))
                out.append((key, *(k.pair_offset(x, y, a, s, precision) if a else k.translation(x, y, precision))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA) if out else pa.RecordBatch.from_pylist([], _SCHEMA)

    return tasks.select("key", "src", "dst", "axis", "shift_px").mapInArrow(run, _OFFSET)


_VOXEL = pa.schema([("key", pa.string()), ("z", pa.int32()), ("y", pa.int32()), ("x", pa.int32()), ("v", pa.float64())])


def responses(tasks: DataFrame, shape: tuple[int, int, int], precision: str = "float64") -> DataFrame:
    """key, z, y, x, v: the response surface of ``tasks(key, src, dst)``, with no displacement in the middle."""
    n = shape[0] * shape[1] * shape[2]
    at = [pa.array(x, pa.int32()) for x in np.unravel_index(np.arange(n), shape)]

    def run(it):
        for b in it:
            for key, src, dst in zip(*(b.column(c).to_pylist() for c in ("key", "src", "dst")), strict=True):
                v = k.response_surface(*(np.asarray(x, dtype=precision).reshape(shape) for x in (src, dst)), precision)
                yield pa.RecordBatch.from_arrays([pa.array([key] * n), *at, pa.array(v.ravel().astype(float))], schema=_VOXEL)

    return tasks.select("key", "src", "dst").mapInArrow(run, "key string, z int, y int, x int, v double")


def strips(images: DataFrame, shape: tuple[int, int, int], axis: int, shift: int) -> DataFrame:
    """vec_id, side, z, y, x, v of both strips of each image (vec_id, img), as a parent and as a child of a neighbour."""

    places = {side: np.stack(np.unravel_index(np.arange(k.trim(np.zeros(shape), axis, side, shift).size), k.trim(np.zeros(shape), axis, side, shift).shape)).astype(np.int32) for side in ("parent", "child")}

    def run(it):
        for b in it:
            keys = b.column("vec_id").to_numpy(zero_copy_only=False)
            img = np.array(b.column("img").to_pylist(), dtype=np.float64).reshape(-1, *shape)
            for side, at in places.items() if len(keys) else ():
                part = k.trim(img, axis + 1, side, shift).reshape(len(keys), -1)
                n = part.shape[1]
                cols = [np.repeat(keys, n), np.full(part.size, side), *(np.tile(x, len(keys)) for x in at), part.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["vec_id", "side", "z", "y", "x", "v"])

    return images.select(F.col("vec_id").cast("long").alias("vec_id"), "img").mapInArrow(run, "vec_id long, side string, z int, y int, x int, v double")


_FOUND = "key string, kind string, what string, dz int, dy int, dx int"


class _Recent:
    """The last few results of a function, by its arguments."""

    def __init__(self, make, keep: int):
        self.make, self.keep, self.held = make, keep, {}

    def __call__(self, *args):
        if args in self.held:
            self.held[args] = self.held.pop(args)
        else:
            while len(self.held) >= self.keep:
                del self.held[next(iter(self.held))]
            self.held[args] = self.make(*args)
        return self.held[args]


def correlate_stored(tasks: DataFrame, paths: dict[str, str], nz: int, crop, realign_crop, shift_px: int, precision: str = "float32", span: int = 32, keep: int = 4, blocks: DataFrame | None = None, read=read_volume, at_most: int | None = None) -> DataFrame:
    """key, kind, what, dz, dy, dx of tasks by reference: voxels are read where they are needed and never shuffled.

    With ``blocks(name, block)`` (``tasks.tile_blocks``) tasks are dealt by blocks of neighbouring tiles and ``span``
    timepoints, else by tile; they are worked on in the order of time, so a volume and its spectra serve all tasks of their
    block.  ``keep`` of each are held: with as many as a block's tiles, and those around it, at two timepoints, a volume is
    read once for each block that it belongs to or borders on.  ``paths``: the file of each file key; ``at_most``: so many tasks.
    """
    from ..sources.config import free_axis

    def run(it):
        volume = _Recent(lambda file, pos, t: read(paths[file], pos, t, nz), keep)

        def strip(file, pos, t, region, axis, side):
            cut = volume(file, pos, t)[tuple(slice(*s) for s in region)]
            return k.trim(cut, axis or None, side, shift_px)

        spectrum = _Recent(lambda *ref: (k.spectrum(part := strip(*ref), precision), part.shape), keep)
        for pdf in it:
            out = []
            for r in pdf.itertuples():
                if r.kind not in ("pair", "time"):
                    raise TypeError(f"unknown task {r.kind!r}")
                region = free_axis(crop, r.axis) if r.kind == "pair" else realign_crop if r.realign else crop
                sides = ("parent", "child") if r.kind == "pair" else ("", "")
                (f0, shape), (f1, other) = (spectrum(*ref, region, r.axis, side) for ref, side in zip(((r.src_file, r.src_pos, r.src_local_t), (r.dst_file, r.dst_pos, r.dst_local_t)), sides, strict=True))
                if shape != other:
                    raise ValueError(f"{r.what}: sizes differ: {shape} and {other}")
                off = list(k.peak(k.correlation(f0, f1, shape)))
                if r.kind == "pair":
                    off[r.axis] += shift_px
                out.append((r.key, r.kind, r.what, *off))
            yield pd.DataFrame(out, columns=["key", "kind", "what", "dz", "dy", "dx"])

    if blocks is None:
        where = [F.col("src_file"), F.col("src_pos"), F.floor(F.col("src_local_t") / span)]
        dealt = tasks.repartition(*where).sortWithinPartitions("src_file", "src_pos", "src_local_t", "kind_rank", "axis", "b")
    else:
        dealt = placed_tasks(tasks, blocks, span).repartition("block", "span").sortWithinPartitions("block", "span", "t", "kind_rank", "a", "axis", "b")
    if at_most:
        dealt = dealt.coalesce(at_most)
    refs = [f"{p}_{c}" for p in ("src", "dst") for c in ("file", "pos", "local_t")]
    return dealt.select("key", "kind", "what", "axis", "realign", *refs).mapInPandas(run, _FOUND)
