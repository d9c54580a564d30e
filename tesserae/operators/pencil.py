"""Phase correlation of volumes that no worker holds: a transform by planes, then by pencils across them.

A volume comes as planes, a row each.  Planes are transformed where they lie and cut into blocks of rows; a shuffle brings
the same block of all planes of both volumes together, where the transform across planes, the normalised cross power and the
transform back across planes are done; a second shuffle puts planes together again for the transform back and their largest
value.  A task holds one plane, or one block of all planes of a pair (``rows`` of each plane), never a volume.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Responses that differ by rounding alone are ties, of which the first place counts.
DECIMALS = 9
_PART = pa.schema([("key", pa.string()), ("block", pa.int32()), ("side", pa.int32()), ("z", pa.int32()), ("data", pa.binary())])
_BACK = pa.schema([("key", pa.string()), ("block", pa.int32()), ("z", pa.int32()), ("data", pa.binary())])
_BEST = pa.schema([("key", pa.string()), ("z", pa.int32()), ("best", pa.float64()), ("place", pa.int64())])


def offsets(planes: DataFrame, shape: tuple[int, int, int], rows: int = 64) -> DataFrame:
    """key, dz, dy, dx for ``planes(key, side, z, voxels)``: side 0 and 1 of a pair of volumes, voxels an array in C order.

    If the second volume is the first one rolled by s, the offset is -s.  A plane that is missing or of another size raises.
    """
    nz, ny, nx = shape
    half, blocks = nx // 2 + 1, -(-ny // rows)
    height = lambda b: min(rows, ny - b * rows)

    def forward(it):
        for batch in it:
            out = []
            for key, side, z, voxels in zip(*(batch.column(c).to_pylist() for c in ("key", "side", "z", "voxels")), strict=True):
                if len(voxels) != ny * nx:
                    raise ValueError(f"{key}: plane {z} has {len(voxels)} voxels instead of {ny * nx}")
                f = np.fft.rfft2(np.array(voxels, dtype=np.float64).reshape(ny, nx))
                out += [(key, b, side, z, f[b * rows : (b + 1) * rows].tobytes()) for b in range(blocks)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PART.types, strict=True)], schema=_PART) if out else pa.RecordBatch.from_pylist([], _PART)

    def across(group: pa.Table) -> pa.Table:
        key, b = group["key"][0].as_py(), group["block"][0].as_py()
        f = np.full((2, nz, height(b), half), np.nan, dtype=np.complex128)
        for side, z, data in zip(*(group[c].to_pylist() for c in ("side", "z", "data")), strict=True):
            f[side, z] = np.frombuffer(data, np.complex128).reshape(-1, half)
        if group.num_rows != 2 * nz or np.isnan(f).any():
            raise ValueError(f"{key}: {group.num_rows} planes instead of {2 * nz}, or one twice")
        f = np.fft.fft(f, axis=1)
        cross = f[0] * np.conj(f[1])
        with np.errstate(divide="ignore", invalid="ignore"):
            cross /= np.abs(cross)
        back = np.fft.ifft(cross, axis=0)
        return pa.table([[key] * nz, [b] * nz, list(range(nz)), [p.tobytes() for p in back]], schema=_BACK)

    def best(group: pa.Table) -> pa.Table:
        f = np.zeros((ny, half), dtype=np.complex128)
        for b, data in zip(group["block"].to_pylist(), group["data"].to_pylist(), strict=True):
            f[b * rows : (b + 1) * rows] = np.frombuffer(data, np.complex128).reshape(-1, half)
        response = np.round(np.fft.irfft2(f, s=(ny, nx)), DECIMALS).ravel()
        at = int(np.argmax(response))
        return pa.table([[group["key"][0].as_py()], [group["z"][0].as_py()], [response[at]], [at]], schema=_BEST)

    sql = lambda s: ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'string' if f.type == pa.string() else 'double' if f.type == pa.float64() else 'long' if f.type == pa.int64() else 'int'}" for f in s)
    parts = planes.select(F.col("key").cast("string").alias("key"), "side", "z", "voxels").mapInArrow(forward, sql(_PART))
    back = parts.groupBy("key", "block").applyInArrow(across, sql(_BACK))
    peaks = back.groupBy("key", "z").applyInArrow(best, sql(_BEST))
    # of equal values the first in C order, that is of the least plane
    top = peaks.groupBy("key").agg(F.max_by(F.struct("z", "place"), F.struct("best", (-F.col("z")).alias("back"))).alias("x")).select("key", "x.z", "x.place")
    around = lambda p, n: (F.pmod(p + n // 2, F.lit(n)) - n // 2).cast("int")
    return top.select("key", around(F.col("z"), nz).alias("dz"), around(F.floor(F.col("place") / nx), ny).alias("dy"), around(F.col("place") % nx, nx).alias("dx"))
