"""The YAML description of an acquisition, and its rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

Bounds = tuple[int | None, int | None]
FULL: tuple[Bounds, Bounds, Bounds] = ((None, None),) * 3
VERBS = ("drop", "unanchor", "anchor", "realign")


@dataclass(frozen=True)
class Position:
    start: tuple[int, int]
    end: int | None = None  # exclusive
    aliases: tuple[str, ...] = ()
    reference_in_files: tuple[int, ...] = ()

    def last_file(self, n: int) -> int:
        return (n if self.end is None else self.end) - 1

    def alive_in_file(self, f: int, n: int) -> bool:
        return self.start[0] <= f <= self.last_file(n)


@dataclass(frozen=True)
class Override:
    at: tuple[int, ...] = ()
    reason: str | None = None
    drop: tuple[str, ...] = ()
    unanchor: tuple[str, ...] = ()
    anchor: tuple[str, ...] = ()
    realign: tuple[str, ...] = ()

    @property
    def names(self) -> set[str]:
        return {n for v in VERBS for n in getattr(self, v)}


@dataclass(frozen=True)
class Config:
    files: tuple[str, ...]
    positions: dict[str, Position]
    grid_spacing: float
    grid_spacing_error: float
    overrides: tuple[Override, ...] = ()
    flip_x: bool = False
    flip_y: bool = False
    shift_px: int | None = None
    slices: tuple[Bounds, Bounds, Bounds] = FULL
    realignment_slices: tuple[Bounds, Bounds, Bounds] = field(default=FULL)

    @property
    def n_files(self) -> int:
        return len(self.files)

    def references_for_file(self, f: int) -> set[str]:
        return {n for n, p in self.positions.items() if f in p.reference_in_files}

    def names_at(self, verb: str, t: int) -> set[str]:
        """Names that the blocks for ``t`` give under a verb."""
        return {n for o in self.overrides if t in o.at for n in getattr(o, verb)}

    # --- rows -------------------------------------------------------------------------------------------
    def position_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(n, *p.start, p.end, list(p.aliases), list(p.reference_in_files)) for n, p in self.positions.items()]
        return spark.createDataFrame(rows, "name string, start_file int, start_t int, end_file int, aliases array<string>, reference_in_files array<int>")

    def reference_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(n, f) for n, p in self.positions.items() for f in p.reference_in_files], "name string, file_i int")

    def override_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, v, n, o.reason) for i, o in enumerate(self.overrides) for t in o.at for v in VERBS for n in getattr(o, v)]
        return spark.createDataFrame(rows, "block_i int, t int, verb string, name string, reason string")


def bounds(data) -> tuple[Bounds, Bounds, Bounds]:
    """Per axis [start, stop]; a missing axis is full."""
    get = lambda axis: tuple((*(data or {}).get(axis, ()), None, None)[:2])
    return get("z"), get("y"), get("x")


def clamp_z(slices: tuple[Bounds, Bounds, Bounds], nz: int) -> tuple[Bounds, Bounds, Bounds]:
    (lo, hi), y, x = slices
    return (lo, nz if hi is None else min(hi, nz)), y, x


def free_axis(slices: tuple[Bounds, Bounds, Bounds], axis: int) -> tuple[Bounds, Bounds, Bounds]:
    return tuple((None, None) if i == axis else b for i, b in enumerate(slices))


def _times(data) -> tuple[int, ...]:
    return () if data is None else tuple(data) if isinstance(data, (list, tuple)) else (int(data),)


def parse(text: str) -> Config:
    """Null means absent for lists; a missing required field raises KeyError, an unknown one TypeError."""
    data = dict(yaml.safe_load(text) or {})
    names = lambda d, *keys: {k: tuple(d.get(k) or ()) for k in keys}

    def position(d) -> Position:
        d = dict(d or {})
        start = d.pop("start")
        out = Position((int(start[0]), int(start[1])), d.pop("end", None), **names(d, "aliases", "reference_in_files"))
        if extra := d.keys() - {"aliases", "reference_in_files"}:
            raise TypeError(f"unknown fields of a position: {sorted(extra)}")
        return out

    def override(d) -> Override:
        if extra := d.keys() - {"at", "reason", *VERBS}:
            raise TypeError(f"unknown fields of an override: {sorted(extra)}")
        return Override(_times(d.get("at")), d.get("reason"), **names(d, *VERBS))

    known = {"files", "positions", "grid_spacing", "grid_spacing_error", "overrides", "flip_x", "flip_y", "shift_px", "slices", "realignment_slices"}
    if extra := data.keys() - known:
        raise TypeError(f"unknown fields: {sorted(extra)}")
    return Config(
        files=tuple(map(str, data["files"] or ())),
        positions={str(n): position(d) for n, d in (data["positions"] or {}).items()},
        grid_spacing=float(data["grid_spacing"]),
        grid_spacing_error=float(data["grid_spacing_error"]),
        overrides=tuple(override(d) for d in data.get("overrides") or ()),
        flip_x=bool(data.get("flip_x") or False),
        flip_y=bool(data.get("flip_y") or False),
        shift_px=data.get("shift_px"),
        slices=bounds(data.get("slices")),
        realignment_slices=bounds(data.get("realignment_slices")),
    )


def load(path: str | Path) -> Config:
    return parse(Path(path).read_text())


@dataclass(frozen=True)
class Workspace:
    """Where the artefacts of a configuration lie: a folder beside it, named like it."""

    config: Path

    @classmethod
    def of(cls, path: str | Path) -> Workspace:
        return cls(Path(path))

    root = property(lambda self: self.config.parent / self.config.stem)
    metadata = property(lambda self: self.root / "metadata.json")
    offsets = property(lambda self: self.root / "offsets.jsonl")
    canvas = property(lambda self: self.root / "canvas")

    def create(self) -> Workspace:
        self.root.mkdir(parents=True, exist_ok=True)
        return self
