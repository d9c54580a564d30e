"""Blending tiles onto a chunked canvas."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels as k
from ..sources import files
from ..sources.volumes import BATCH_BYTES, read_region
from .coords import ZYX

_CHUNK = ["t", "cz", "cy", "cx"]
_COMPOSED = [*_CHUNK, "shape", "data", "read_s", "compose_s"]


def ramp(n):
    """SQL form of a rising ramp of ``n`` weights from 0.01 to 0.99."""
    i = F.sequence(F.lit(0), n - 1)
    return F.transform(i, lambda j: F.lit(0.01) + j * F.lit(0.98) / F.greatest(n - 1, F.lit(1)))


def edge_lengths(placed: DataFrame, pairs_at: DataFrame, sizes: tuple[int, int, int]) -> DataFrame:
    """t, name, axis, lower, length of every applying edge: the separation of the two tiles, truncated."""
    at = placed.where("placed").select("t", "name", *ZYX)
    a = at.select("t", F.col("name").alias("a"), *[F.col(c).alias(f"a{c}") for c in ZYX])
    b = at.select("t", F.col("name").alias("b"), *[F.col(c).alias(f"b{c}") for c in ZYX])
    d = F.when(F.col("axis") == 1, F.col("by") - F.col("ay")).otherwise(F.col("bx") - F.col("ax")).cast("int")
    size = F.when(F.col("axis") == 1, F.lit(sizes[1])).otherwise(F.lit(sizes[2]))
    both = pairs_at.join(a, ["t", "a"]).join(b, ["t", "b"]).withColumn("length", d).where((F.col("length") > 0) & (F.col("length") < size))
    one = lambda n, lower: both.select("t", F.col(n).alias("name"), "axis", F.lit(lower).alias("lower"), "length", "a", "b")
    return one("a", True).union(one("b", False))


def weight_lines(edges: DataFrame) -> DataFrame:
    """Distinct (axis, lower, length) with their ramps in the order of pixels: few, and joined back where needed."""
    keys = edges.select("axis", "lower", "length").distinct()
    rising = ramp(F.col("length"))
    return keys.withColumn("weights", F.when(F.col("lower"), F.reverse(rising)).otherwise(rising))


def weighted_average(samples: DataFrame, keys: list[str]) -> DataFrame:
    """sum(w * v) / (EPS + sum(w)) by voxel, the relational form of blending."""
    return samples.groupBy(*keys).agg((F.sum(F.col("w") * F.col("v")) / (F.lit(k.EPS) + F.sum("w"))).alias("value"))


def weighted(voxels: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """t, z, y, x on the canvas, v and w for ``voxels(t, name, z_lo, y_lo, x_lo, z, y, x, v, edges)``: the weight of a voxel is
    the product of its weights along y and x, where the last edge on it counts."""

    def along(axis: int, at: str):
        fade = lambda e: F.when(e["lower"], F.lit(shape[axis] - 1) - F.col(at)).otherwise(F.col(at))
        own = lambda e: F.lit(k.RAMP[0]) + fade(e) * (F.lit(k.RAMP[1] - k.RAMP[0]) / F.greatest(e["length"] - 1, F.lit(1)))
        return F.aggregate("edges", F.lit(1.0), lambda w, e: F.when((e["axis"] == axis) & (fade(e) < e["length"]), own(e)).otherwise(w))

    # weights first: beside new columns of the same names, those of the tile would be taken for the canvas' ones
    weighed = voxels.withColumn("w", along(1, "y") * along(2, "x"))
    return weighed.select("t", *[(F.col(f"{c}_lo") + F.col(c)).cast("int").alias(c) for c in ZYX], "v", "w")


def chunk_refs(boxed: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """``boxed`` with a row for each chunk (cz, cy, cx) that a box overlaps."""
    out = boxed
    for c, n in zip(ZYX, chunk, strict=True):
        out = out.withColumn(f"c{c}", F.explode(F.sequence(F.floor(F.greatest(F.col(f"{c}_lo"), F.lit(0)) / n).cast("int"), F.floor((F.col(f"{c}_hi") - 1) / n).cast("int"))))
    return out


def compose_chunks(boxed: DataFrame, volumes: DataFrame, edges: DataFrame, geometry: dict, chunk: tuple[int, int, int], dtype: str, shape: tuple[int, int, int], read=read_region, at_most: int | None = None) -> DataFrame:
    """t, cz, cy, cx, shape, data of every chunk that a tile overlaps, and the seconds it took to read and to compose it.

    A chunk gathers references of the tiles that overlap it (few, by geometry), reads of each volume the part inside it
    alone, and is composed on its own: no voxel is shuffled.  Tasks are ranges of timepoints and chunks and go through them
    in their order.  ``boxed``: boxes, or rows of ``chunk_refs``; ``volumes(t, name, path, pos, local_t)``; ``shape``: the
    tiles' size; ``read(path, pos, local_t, region)``; ``at_most``: so many tasks.
    """
    size = [geometry["shape"][i + 1] for i in range(3)]
    out = boxed if "cz" in boxed.columns else chunk_refs(boxed, chunk)
    ramps = edges.groupBy("t", "name").agg(F.sort_array(F.collect_list(F.struct("a", "b", "axis", "lower", "length"))).alias("edges"))
    joined = out.join(volumes, ["t", "name"]).join(ramps, ["t", "name"], "left")

    def one(pdf: pd.DataFrame) -> tuple:
        began = time.perf_counter()
        at = [int(pdf[f"c{c}"].iloc[0]) for c in ZYX]
        region = [(i * n, min((i + 1) * n, m)) for i, n, m in zip(at, chunk, size, strict=True)]
        vols, boxes, weights = {}, {}, {}
        for r in pdf.itertuples():
            lo = [int(getattr(r, f"{c}_lo")) for c in ZYX]
            inner = [(max(a - o, 0), min(b - o, n)) for (a, b), o, n in zip(region, lo, shape, strict=True)]
            if any(a >= b for a, b in inner):
                continue
            vols[r.name] = read(r.path, int(r.pos), int(r.local_t), inner)
            boxes[r.name] = tuple(o + a for o, (a, _) in zip(lo, inner, strict=True)), tuple(o + b for o, (_, b) in zip(lo, inner, strict=True))
            mine = [] if r.edges is None else [(e["axis"], e["lower"], e["length"]) for e in r.edges]
            weights[r.name] = k.blend_weights(mine, shape[1], shape[2])[tuple(slice(*x) for x in inner[1:])]
        known = time.perf_counter()
        data = k.compose(vols, boxes, weights, region, dtype)
        return int(pdf["t"].iloc[0]), *at, list(data.shape), data.tobytes(), known - began, time.perf_counter() - known

    def run(it):
        rows, size = [], 0
        for pdf in whole_groups(it, _CHUNK):
            rows.append(one(pdf))
            size += len(rows[-1][5])
            if size >= BATCH_BYTES:
                yield pd.DataFrame(rows, columns=_COMPOSED)
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=_COMPOSED)

    # by number: references are few bytes, and put together by those they would all be one task's work
    n = int(joined.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = joined.repartitionByRange(n, *_CHUNK).sortWithinPartitions(*_CHUNK)
    dealt = dealt.coalesce(at_most) if at_most else dealt
    return dealt.mapInPandas(run, "t int, cz int, cy int, cx int, shape array<int>, data binary, read_s double, compose_s double")


def whole_groups(frames, by: list[str]):
    """Groups of a sorted stream of frames, those too that a frame's end cuts."""
    held = None
    for pdf in frames:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if len(pdf):
            new = (pdf[by].ne(pdf[by].shift())).any(axis=1).to_numpy()
            first = np.flatnonzero(new)
            yield from (pdf.iloc[a:b] for a, b in zip(first, first[1:], strict=False))
            held = pdf.iloc[first[-1] :]
    if held is not None:
        yield held


def write_chunks(chunks: DataFrame, path: str, span: int | None = None) -> None:
    """Adds chunks of frames (t, frame).  A task's chunks are there as soon as it ends, and stay if the job fails later.

    A timepoint has a folder of its own, which ``clear`` can remove.  With ``span`` so many timepoints share one: where they
    have few chunks, folders and files would outweigh them.
    """
    dealt = chunks.withColumn("span", F.floor(F.col("t") / span)) if span else chunks
    dealt.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("span" if span else "t", "frame").parquet(path)


def frame_name(key: str, chunk: tuple[int, int, int]) -> str:
    """Chunks of other coordinates or of another grid are in another frame."""
    return f"{key}-{'x'.join(map(str, chunk))}"


def written(spark: SparkSession, path: str) -> DataFrame:
    """t, frame, cz, cy, cx of the chunks that are there; data is not read."""
    schema = "cz int, cy int, cx int, t int, frame string"
    return (spark.read.schema(schema).parquet(path) if files.exists(path) else spark.createDataFrame([], schema)).select("t", "frame", "cz", "cy", "cx").distinct()


def clear(path: str, keep: dict[int, str | None]) -> None:
    """Removes all frames of these timepoints but the one that is to be kept."""
    for t, frame in keep.items():
        for name in files.names(f"{path}/t={t}"):
            if name.startswith("frame=") and name != f"frame={frame}":
                files.remove(f"{path}/t={t}/{name}")
