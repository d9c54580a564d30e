"""File headers: identity stamps, a memoised scan, alias resolution."""

from __future__ import annotations

import hashlib
import json
import warnings
from collections.abc import Callable
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Header:
    path: str
    nt: int
    nz: int
    ny: int
    nx: int
    position_names: tuple[str, ...]
    stage_um: tuple[tuple[float, float], ...]
    voxel_x_um: float

    def position_of(self, names) -> int | None:
        """Place of the position that goes by one of the names, None if there is none; two of them are an error."""
        wanted = dict.fromkeys(names)
        places = {p: k for k, p in enumerate(self.position_names) if p in wanted}
        if sum(p in wanted for p in self.position_names) > 1:
            raise ValueError(f"{self.path}: the names {', '.join(wanted)} stand for several positions: {', '.join(places)}")
        return next(iter(places.values()), None)


@dataclass(frozen=True)
class Stamp:
    path: str
    size: int
    mtime: int

    @classmethod
    def of(cls, path: str) -> Stamp:
        s = Path(path).stat()
        return cls(str(path), s.st_size, int(s.st_mtime))

    @property
    def key(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def read_sidecar(path: str) -> Header:
    """The header of ``X`` from ``X.json``: the form in which headers come without a vendor library."""
    return _header(json.loads(Path(f"{path}.json").read_text()) | {"path": str(path)})


def read_nd2(path: str) -> Header:
    """The header of a vendor file, if its library is installed."""
    import nd2

    with nd2.ND2File(path) as f:
        sizes = f.sizes
        points = f.experiment[1].parameters.points if len(f.experiment) > 1 else f.experiment[0].parameters.points
        return Header(str(path), sizes.get("T", 1), sizes["Z"], sizes["Y"], sizes["X"], tuple(p.name for p in points), tuple((p.stagePositionUm.x, p.stagePositionUm.y) for p in points), f.voxel_size().x)


def _header(d: dict) -> Header:
    return Header(d["path"], d["nt"], d["nz"], d["ny"], d["nx"], tuple(d["position_names"]), tuple(tuple(map(float, p)) for p in d["stage_um"]), float(d["voxel_x_um"]))


def load_headers(paths, cache: str | Path | None = None, read: Callable[[str], Header] = read_sidecar) -> list[Header]:
    """Headers in order; the cache holds if all stamps are the same in the same order, a broken one is read anew."""
    stamps = [asdict(Stamp.of(p)) for p in paths]
    file = Path(cache) if cache else None
    if file and file.exists():
        try:
            held = json.loads(file.read_text())
            if held["stamps"] == stamps:
                return [_header(d) for d in held["headers"]]
        except (ValueError, KeyError, TypeError) as e:
            warnings.warn(f"{file}: unreadable cache ({e}); headers are read again", RuntimeWarning, stacklevel=2)
    found = [read(str(p)) for p in paths]
    if file:
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps({"stamps": stamps, "headers": [asdict(h) for h in found]}))
    return found


def header_rows(spark: SparkSession, headers: list[Header], keys: list[str]) -> DataFrame:
    """file_i, path, nt, nz, ny, nx, voxel_x_um, file_key and the positions as an array."""
    rows = [(i, h.path, h.nt, h.nz, h.ny, h.nx, h.voxel_x_um, k, [(n, *p) for n, p in zip(h.position_names, h.stage_um, strict=True)]) for i, (h, k) in enumerate(zip(headers, keys, strict=True))]
    return spark.createDataFrame(rows, "file_i int, path string, nt int, nz int, ny int, nx int, voxel_x_um double, file_key string, positions array<struct<name:string,x_um:double,y_um:double>>")


def stamp_rows(spark: SparkSession, pattern: str) -> DataFrame:
    """path, length and modification time of files, without their content."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length", "modificationTime")
