"""A Python data source for raw volume stacks, with push-down of filters and of what is asked for.

``spark.read.format("volumes").load("folder")`` reads every stack ``X`` of a folder that has a header ``X.json``; a list of
paths, separated by commas, names stacks or folders.  A stack holds frames in the order time, position, plane (or position,
plane without a time axis), and its header their numbers, ``nt``, ``nz``, ``ny``, ``nx``, ``position_names``, ``dtype``, and
``absent`` (time, position) pairs that were never taken; a vendor's file has its own.  Rows are ``file, pos, local_t, shape, stored, data``.

Filters on file, pos and local_t (equality, membership, comparisons, beginnings of names) are worked out before anything is
read: stacks that do not match are not opened, and of the others only the matching volumes are read, by their byte ranges.
A schema without ``data`` reads headers alone.  A task reads volumes of about ``partition_bytes`` (64 MB), of one or of many
stacks.  Paths may be of any file system that pyarrow knows (local, file://, hdfs://, s3://).
"""

from __future__ import annotations

import json
import operator
import uuid
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith

from . import files

SCHEMA = "file string, pos int, local_t int, shape array<int>, stored string, data binary"
_ARROW = {"file": pa.string(), "pos": pa.int32(), "local_t": pa.int32(), "shape": pa.list_(pa.int32()), "stored": pa.string(), "data": pa.binary()}
BATCH_BYTES = 8 << 20
VENDOR = ".nd2"


def read_header(path: str) -> dict:
    if path.endswith(VENDOR) and not files.exists(f"{path}.json"):
        from .headers import read_nd2

        return asdict(read_nd2(path))
    return json.loads(files.read_text(f"{path}.json"))


class Stack:
    """Random access to the volumes of one stack."""

    def __init__(self, path: str, header: dict | None = None):
        h = read_header(path) if header is None else header
        self.positions, self.nz, self.ny, self.nx = len(h["position_names"]), h["nz"], h["ny"], h["nx"]
        self.dtype = np.dtype(h.get("dtype", "uint16"))
        system, at = files.at(path)
        self.file = system.open_input_file(at)

    def __enter__(self) -> Stack:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def _read(self, frame: int, row: int, n: int) -> bytes:
        """``n`` rows of pixels, from a row of a frame on."""
        size = self.nx * self.dtype.itemsize
        data = self.file.read_at(n * size, (frame * self.ny + row) * size)
        if len(data) != n * size:
            raise ValueError(f"the stack ends inside frame {frame}")
        return data

    def volume(self, pos: int, t: int, depth: int) -> bytes:
        return self._read((t * self.positions + pos) * self.nz, 0, depth * self.ny)

    def region(self, pos: int, t: int, region) -> np.ndarray:
        """The part inside ``region`` ((lo, hi) per axis): of each plane only the rows that it takes."""
        (z0, z1), (y0, y1), (x0, x1) = region
        first = (t * self.positions + pos) * self.nz
        planes = [np.frombuffer(self._read(first + z, y0, y1 - y0), self.dtype).reshape(-1, self.nx)[:, x0:x1] for z in range(z0, z1)]
        return np.stack(planes) if planes else np.zeros((0, y1 - y0, x1 - x0), self.dtype)


class VendorStack(Stack):
    """The same of a vendor's file, whose frames come through its library, if that is installed."""

    def __init__(self, path: str, header: dict | None = None):
        import nd2

        self.file = nd2.ND2File(path)
        n = self.file.sizes
        self.positions, self.nz, self.ny, self.nx, self.dtype = n.get("P", 1), n["Z"], n["Y"], n["X"], np.dtype(self.file.dtype)

    def _read(self, frame: int, row: int, n: int) -> bytes:
        """Rows of one frame, or whole frames from it on."""
        frames = [np.asarray(self.file.read_frame(frame + k)) for k in range(-(-(row + n) // self.ny))]
        return np.ascontiguousarray(np.concatenate(frames)[row : row + n], dtype=self.dtype).tobytes()


def open_stack(path: str, header: dict | None = None) -> Stack:
    return VendorStack(path, header) if path.endswith(VENDOR) else Stack(path, header)


def read_volume(path: str, pos: int, t: int, nz: int | None = None) -> np.ndarray:
    """``nz`` consecutive frames of a position and timepoint."""
    with open_stack(path) as s:
        depth = s.nz if nz is None else min(nz, s.nz)
        return np.frombuffer(s.volume(pos, t, depth), s.dtype).reshape(depth, s.ny, s.nx)


def read_region(path: str, pos: int, t: int, region) -> np.ndarray:
    with open_stack(path) as s:
        return s.region(pos, t, region)


# --- the source ---------------------------------------------------------------------------------------------------------
_COMPARE = {EqualTo: operator.eq, EqualNullSafe: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le, StringStartsWith: str.startswith, In: lambda x, values: x in values}


class Piece(InputPartition):
    """Runs of volumes of some stacks: (path, header, times, positions, first, count), counted by time and then position."""

    def __init__(self, runs: list[tuple]):
        super().__init__(None)
        self.runs = runs

    def volumes(self) -> Iterator[tuple[str, dict, int, int]]:
        for path, header, times, positions, first, count in self.runs:
            absent = {tuple(x) for x in header.get("absent", ())}
            for k in range(first, first + count):
                t, pos = times[k // len(positions)], positions[k % len(positions)]
                if (t, pos) not in absent:
                    yield path, header, pos, t


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.paths = [p for p in options["path"].split(",") if p]
        self.nz = int(options["nz"]) if "nz" in options else None
        self.size = int(options.get("partition_bytes", 64 << 20))
        self.columns, self.asked = columns, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what compares one of file, pos, local_t; the rest is left to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("file", "pos", "local_t") and type(f) in _COMPARE and getattr(f, "value", None) is not None:
                self.asked.append((column, type(f), f.value))
            elif not (column in _ARROW and isinstance(f, IsNotNull)):  # no column has nulls
                yield f

    def _wanted(self, column: str, value) -> bool:
        return all(_COMPARE[kind](value, other) for c, kind, other in self.asked if c == column)

    def _stacks(self) -> Iterator[str]:
        for path in self.paths:
            if not files.is_folder(path):
                yield path
                continue
            found = files.names(path)
            yield from (f"{path.rstrip('/')}/{n}" for n in found if f"{n}.json" in found or n.endswith(VENDOR))

    def partitions(self) -> list[Piece]:
        out, runs, room = [], [], self.size
        for path in self._stacks():
            if not self._wanted("file", path):
                continue
            h = read_header(path)
            times = [t for t in range(h["nt"]) if self._wanted("local_t", t)]
            positions = [p for p in range(len(h["position_names"])) if self._wanted("pos", p)]
            each = max(1, (h["nz"] if self.nz is None else min(self.nz, h["nz"])) * h["ny"] * h["nx"] * np.dtype(h.get("dtype", "uint16")).itemsize)
            at, n = 0, len(times) * len(positions)
            while at < n:
                count = min(n - at, max(1, room // each))
                row = at // len(positions)
                runs.append((path, h, times[row : (at + count - 1) // len(positions) + 1], positions, at % len(positions), count))
                at, room = at + count, room - count * each
                if room < each:
                    out.append(Piece(runs))
                    runs, room = [], self.size
        return out + [Piece(runs)] if runs else out or [Piece([])]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, _ARROW[c]) for c in self.columns])
        rows, size, stack, opened = [], 0, None, None
        try:
            for path, h, pos, t in piece.volumes():
                depth = h["nz"] if self.nz is None else min(self.nz, h["nz"])
                row = {"file": path, "pos": pos, "local_t": t, "shape": [depth, h["ny"], h["nx"]], "stored": h.get("dtype", "uint16")}
                if "data" in self.columns:
                    if opened != path:
                        if stack:
                            stack.file.close()
                        stack, opened = open_stack(path, h), path
                    row["data"] = stack.volume(pos, t, depth)
                    size += len(row["data"])
                rows.append(row)
                if size >= BATCH_BYTES or len(rows) == 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        finally:
            if stack:
                stack.file.close()


class Volumes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "volumes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        if strange := [f.name for f in schema.fields if f.name not in _ARROW]:
            raise ValueError(f"a volume has no {', '.join(strange)}")
        return Reader(self.options, [f.name for f in schema.fields])


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets Spark push filters into Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Volumes)


# --- writing ------------------------------------------------------------------------------------------------------------
def write_stacks(volumes: DataFrame, folder: str, positions: int, shape: tuple[int, int, int], dtype: str = "uint16") -> DataFrame:
    """Writes ``volumes(file, pos, local_t, data)`` as stacks of a folder, one for each file name; returns file and n_volumes.

    A stack is one task's work and is moved to its place when it is whole, its header last: a task that runs again, or twice
    at once, puts the same bytes there.  Volumes that are not given are filled with zeros and told as absent.
    """
    size = int(np.prod(shape)) * np.dtype(dtype).itemsize

    def write(table: pa.Table) -> pa.Table:
        name = table["file"][0].as_py()
        held = {(t, p): d for t, p, d in zip(*(table[c].to_pylist() for c in ("local_t", "pos", "data")), strict=True)}
        nt = max(t for t, _ in held) + 1
        places = [(t, p) for t in range(nt) for p in range(positions)]
        if bad := [k for k, d in held.items() if len(d) != size or k not in set(places)]:
            raise ValueError(f"{name}: no volume of {size} bytes at {bad[:3]}")
        header = {"nt": nt, **dict(zip(("nz", "ny", "nx"), shape, strict=True)), "dtype": dtype, "position_names": [str(p) for p in range(positions)], "absent": [k for k in places if k not in held]}
        system, at = files.at(folder)
        system.create_dir(at, recursive=True)
        for end, parts in (("", (held.get(k, bytes(size)) for k in places)), (".json", (json.dumps(header).encode(),))):
            own = f"{at}/.{name}{end}.{uuid.uuid4().hex}"
            with system.open_output_stream(own) as f:
                for part in parts:
                    f.write(part)
            system.move(own, f"{at}/{name}{end}")
        return pa.table({"file": [name], "n_volumes": [len(held)]})

    return volumes.select("file", F.col("pos").cast("int").alias("pos"), F.col("local_t").cast("int").alias("local_t"), "data").groupBy("file").applyInArrow(write, "file string, n_volumes long")

