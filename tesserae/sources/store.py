"""Append-only logs of results, tolerant of torn lines, and the geometry of a canvas, which is not.

A log ``X`` is a file of JSON lines that other tools may have written, if there is one, and the folder ``X.parts`` that Spark's
writer appends to: a task's lines are there as a whole or not at all, whatever breaks, and none is there twice.  Lines carry the
time of their append, in microseconds; those of the file have none and come before all others.
"""

from __future__ import annotations

import json
import time
import warnings
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.coords import durable
from ..operators.tasks import last_wins
from . import files

_OFFSET = "key string, kind string, task struct<kind:string,what:string>, offset struct<dz:int,dy:int,dx:int>, at long, _bad string"
_BLEND = "t int, key string, bbox array<array<int>>, at long, _bad string"
OFFSETS = "key string, kind string, what string, dz int, dy int, dx int"
BLENDS = "t int, key string, bbox array<array<int>>"


class CanvasMismatch(RuntimeError):
    pass


def _places(path) -> list[str]:
    return [p for p in (str(path), f"{path}.parts") if files.exists(p)]


def _log(spark: SparkSession, path, schema: str, needed: str, key: str, *columns) -> tuple[DataFrame, int] | None:
    """The last line of each key, written down in the one pass that also counts lines and broken ones; the number of lines.

    None for a log that is not there.
    """
    places = _places(path)
    if not places:
        return None
    raw = spark.read.schema("value string").text(places).where("trim(value) <> ''")
    x = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = raw.select(x.alias("x"), order.alias("place")).select("x.*", "place")
    good = F.coalesce(F.col("_bad").isNull() & F.expr(needed), F.lit(False))
    seen = Observation()
    lines = rows.observe(seen, F.count(F.lit(1)).alias("lines"), F.count(F.when(~good, 1)).alias("skipped")).where(good)
    last = last_wins(lines.select(*columns, F.coalesce("at", F.lit(0)).alias("at"), "place"), key, ["at", "place"]).drop("at", "place")
    last = durable(last)
    if seen.get["skipped"]:
        warnings.warn(f"{path}: skipped {seen.get['skipped']} unreadable line(s)", RuntimeWarning, stacklevel=3)
    return last, seen.get["lines"]


def _offset_log(spark: SparkSession, path) -> tuple[DataFrame, int] | None:
    needed = "key is not null and offset.dz is not null and offset.dy is not null and offset.dx is not null"
    return _log(spark, path, _OFFSET, needed, "key", "key", "kind", F.col("task.what").alias("what"), "offset.*")


def read_offsets(spark: SparkSession, path) -> DataFrame:
    """key, kind, what, dz, dy, dx; the last line of a key counts.  A missing log is empty."""
    found = _offset_log(spark, path)
    return spark.createDataFrame([], OFFSETS) if found is None else found[0]


def _append(lines: DataFrame, path) -> int:
    """Adds a line for each row by Spark's writer; returns their number."""
    seen = Observation()
    dated = lines.withColumn("at", F.lit(time.time_ns() // 1000)).observe(seen, F.count(F.lit(1)).alias("n"))
    dated.write.mode("append").json(f"{path}.parts")
    return seen.get["n"]


def append_offsets(found: DataFrame, path) -> int:
    """Appends result rows (key, kind, what, dz, dy, dx), a line each, by the tasks that made them; returns their number."""
    return _append(found.select("key", "kind", F.struct("kind", "what").alias("task"), F.struct("dz", "dy", "dx").alias("offset")), path)


def patiently(work, attempts: int = 4, wait: float = 2.0):
    """Runs ``work`` again after an error, up to ``attempts`` times, with pauses that double; the last error is raised."""
    for left in reversed(range(max(attempts, 1))):
        try:
            return work()
        except (CanvasMismatch, KeyboardInterrupt):
            raise
        except Exception as e:  # storage fails in many ways
            if not left:
                raise
            warnings.warn(f"{type(e).__name__}: {str(e)[:200]}; once more in {wait:g} s", RuntimeWarning, stacklevel=2)
            time.sleep(wait)
            wait *= 2


def compact(spark: SparkSession, path) -> tuple[int, int]:
    """Leaves the last line of each key alone; lines before and after.

    They are appended before the old files go, so whatever breaks off in between, the log says the same.
    """
    old = [str(path)] + [f"{path}.parts/{n}" for n in files.names(f"{path}.parts")]
    found = _offset_log(spark, path)
    if found is None:
        return 0, 0
    after = append_offsets(found[0], path)
    for p in old:
        files.remove(p)
    return found[1], after


def read_blend_log(spark: SparkSession, path) -> DataFrame:
    """t, key, bbox of written timepoints; the last line counts."""
    found = _log(spark, path, _BLEND, "t is not null and key is not null", "t", "t", "key", "bbox")
    return spark.createDataFrame([], BLENDS) if found is None else found[0]


def mark(spark: SparkSession, path, rows) -> None:
    """Appends (t, key, bbox) of timepoints whose chunks are all written; an empty key takes an earlier mark back."""
    _append(spark.createDataFrame(list(rows), BLENDS).coalesce(1), path)


def remove_log(path) -> None:
    for p in _places(path):
        files.remove(p)


def blend_keys(placed: DataFrame, origin, dtype: str) -> DataFrame:
    """t, key: digest of the frame and of all coordinates of a timepoint, not of the canvas' size."""
    one = F.concat(F.lit('["'), F.col("name"), F.lit('",['), F.concat_ws(",", *[F.col(c).cast("int").cast("string") for c in ("z", "y", "x")]), F.lit("]]"))
    rows = placed.where("placed").groupBy("t").agg(F.array_join(F.sort_array(F.collect_list(one)), ",").alias("all"))
    text = F.concat(F.lit('{"coords":['), F.col("all"), F.lit(f'],"dtype":"{dtype}","origin":{json.dumps(list(origin), separators=(",", ":"))}}}'))
    return rows.select("t", F.substring(F.sha2(text, 256), 1, 16).alias("key"))


def unfinished(keys: DataFrame, log: DataFrame) -> DataFrame:
    """Timepoints that are not written with their present key."""
    return keys.join(log.select("t", "key"), ["t", "key"], "left_anti")


def geometry_path(output) -> Path | str:
    place = f"{output}.geometry.json"
    return place if "://" in place else Path(place)


def save_geometry(output, geometry: dict) -> None:
    files.write_text(geometry_path(output), json.dumps(geometry))


def load_geometry(output) -> dict | None:
    """None if there is none; a malformed one is an error."""
    file = geometry_path(output)
    if not files.exists(file):
        return None
    try:
        g = json.loads(files.read_text(file))
        ok = len(g["origin"]) == 3 and len(g["shape"]) == 4 and isinstance(g["dtype"], str)
    except (ValueError, KeyError, TypeError) as e:
        raise CanvasMismatch(f"{file}: not a geometry ({e})") from e
    if not ok:
        raise CanvasMismatch(f"{file}: not a geometry")
    return g


def resolve_geometry(output, needed: dict, misfits: list[str]) -> tuple[dict, bool]:
    """The frame to use and whether it is new; a stored frame stays, and all that does not fit it is one error."""
    held = load_geometry(output)
    asked = {"number type": needed["dtype"], "number of timepoints": needed["shape"][0]}
    has = asked if held is None else {"number type": held["dtype"], "number of timepoints": held["shape"][0]}
    faults = [f"{what} {has[what]} is stored, {want} is wanted" for what, want in asked.items() if has[what] != want]
    if held is not None and misfits:
        faults.append(f"{len(misfits)} boxes lie outside, the first are " + ", ".join(misfits[:5]))
    if faults:
        raise CanvasMismatch(f"{output}: its frame was fixed when it was made: " + "; ".join(faults))
    return held or needed, held is None
