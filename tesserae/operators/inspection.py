"""Exports for looking at one pair or one tile's drift."""

from __future__ import annotations

import csv
import json
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..functions import kernels as k
from ..sources.volumes import read_volume


def pair(parent: np.ndarray, child: np.ndarray, axis: int, nominal: int, measured, out: str | Path, response: bool = True, precision: str = "float32") -> dict:
    """Two-layer stacks at the measured and the nominal offset, the overlap strips, the response and an info file."""
    out = Path(out)
    out.mkdir(parents=True, exist_ok=True)
    at = [0, 0, 0]
    at[axis] = nominal
    np.save(out / "measured.npy", k.place_two(parent, child, measured))
    np.save(out / "nominal.npy", k.place_two(parent, child, at))
    strips = k.overlap(parent, child, axis, nominal)
    np.save(out / "overlap.npy", np.stack(strips))
    if response:
        np.save(out / "response.npy", k.response_surface(*strips, precision))
    info = {"axis": axis, "nominal": at, "measured": list(map(int, measured))}
    (out / "info.json").write_text(json.dumps(info))
    return info


def drift_table(steps: list[tuple[int, tuple[int, int, int], bool]]) -> list[dict]:
    """Per step and running offsets, with magnitudes to two places."""
    rows, total = [], np.zeros(3, dtype=int)
    for t, off, realign in steps:
        total = total + off
        rows.append({"t": t, **dict(zip(("dz", "dy", "dx"), map(int, off), strict=True)), **dict(zip(("cum_z", "cum_y", "cum_x"), map(int, total), strict=True)), "magnitude": round(float(np.linalg.norm(off)), 2), "realign": realign})
    return rows


def projections(frames: DataFrame, nz: int, size: int | None, low, span, dtype: str) -> DataFrame:
    """t, kind, shape, data for ``frames(t, path, pos, local_t, cum_z, cum_y, cum_x)``: each frame's raw projection along z and,
    moved by its running offset onto a canvas that holds all frames, those along z and y.  A task holds one frame.

    ``size``: centred lateral crop; None: nothing is cropped and the planes of the moved frame come instead, kind ``aligned``
    with their ``z``.
    """
    low, span = np.asarray(low), np.asarray(span)
    schema = pa.schema([("t", pa.int32()), ("kind", pa.string()), ("z", pa.int32()), ("shape", pa.list_(pa.int32())), ("data", pa.binary())])

    def run(it):
        for b in it:
            for r in b.to_pylist():
                v = read_volume(r["path"], r["pos"], r["local_t"], nz)
                v = v if size is None else k.crop_middle(v, size)
                moved = np.zeros(np.array(v.shape) + span, v.dtype)
                at = np.array([r[f"cum_{c}"] for c in "zyx"]) - low
                moved[tuple(slice(a, a + n) for a, n in zip(at, v.shape, strict=True))] = v
                found = [("raw_xy", None, k.project(v, 0))]
                found += [("aligned", z, p) for z, p in enumerate(moved)] if size is None else [("aligned_xy", None, k.project(moved, 0)), ("aligned_zx", None, k.project(moved, 1))]
                yield pa.RecordBatch.from_pylist([{"t": r["t"], "kind": kind, "z": z, "shape": list(p.shape), "data": p.astype(dtype).tobytes()} for kind, z, p in found], schema)

    return frames.select("t", "path", "pos", "local_t", "cum_z", "cum_y", "cum_x").mapInArrow(run, "t int, kind string, z int, shape array<int>, data binary")


def drift(spark: SparkSession, refs: list[tuple[int, str, int, int]], steps, nz: int, out: str | Path, size: int = 256, full: bool = False, dtype: str = "uint16") -> list[dict]:
    """Aligned and raw projections of a tile through time, and the table of its offsets.

    ``refs``: (t, path, pos, local_t) of the frame before the first step and of each step's.  Frames are worked on by Spark's
    tasks; projections of cropped frames are few pixels and are gathered to arrays, while with ``full`` the planes of all moved
    frames are written by Spark to ``out``/aligned.
    """
    out = Path(out)
    out.mkdir(parents=True, exist_ok=True)
    rows = drift_table(steps)
    shifts = [(0, 0, 0), *((r["cum_z"], r["cum_y"], r["cum_x"]) for r in rows)]
    low = np.minimum(np.min(shifts, axis=0), 0)
    span = np.maximum(np.max(shifts, axis=0), 0) - low
    frames = spark.createDataFrame([(*ref, *map(int, s)) for ref, s in zip(refs, shifts, strict=True)], "t int, path string, pos int, local_t int, cum_z int, cum_y int, cum_x int")
    found = projections(frames.repartition(max(1, min(len(refs), spark.sparkContext.defaultParallelism)), "t"), nz, None if full else size, low, span, dtype)
    if full:
        found.where("kind = 'aligned'").drop("kind").write.mode("overwrite").partitionBy("t").parquet(str(out / "aligned"))
    else:
        by: dict[str, list] = {}
        for r in found.orderBy("t").collect():  # of at most size x size pixels each
            by.setdefault(r["kind"], []).append(np.frombuffer(r["data"], dtype).reshape(r["shape"]))
        for kind, images in by.items():
            np.save(out / f"{kind}.npy", np.stack(images))
    with (out / "offsets.csv").open("w", newline="") as f:
        writer = csv.DictWriter(f, ["t", "dz", "dy", "dx", "cum_z", "cum_y", "cum_x", "magnitude", "realign"])
        writer.writeheader()
        writer.writerows(rows)
    (out / "info.json").write_text(json.dumps({"n": len(refs), "full": full}))
    return rows
