"""An acquisition from a YAML file and its headers: the same operators, fed by a configuration."""

from __future__ import annotations

import resource
import time
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import topology as tp
from ..operators import canvas, coords, correlate, graph, layout, tasks, validate
from ..sources import config as cf
from ..sources import headers as hd
from ..sources import store
from ..sources.ship import ship_code


#: Tiles that a task of correlation works on together; it holds volumes of four times as many, its own and those around them at
#: two timepoints.
BLOCK = 4


class MissingOffsets(RuntimeError):
    def __init__(self, what: list[str], hint: str = ""):
        shown = "; ".join(what[:10]) + ("; ..." if len(what) > 10 else "")
        super().__init__(f"not computed yet ({len(what)}): {shown}. {hint}".rstrip(". "))
        self.what = what


class Project:
    def __init__(self, spark: SparkSession, path: str | Path, precision: str = "float32", read=hd.read_sidecar, cache: bool = True):
        ship_code(spark)
        self.spark, self.precision, self.work = spark, precision, cf.Workspace.of(path)
        self.cfg = validate.validate(cf.load(path))
        here = Path(path).parent
        files = [str(here / f) if not Path(f).is_absolute() else f for f in self.cfg.files]
        self.headers = hd.load_headers(files, self.work.metadata if cache else None, read)
        if len({(h.ny, h.nx) for h in self.headers}) != 1:
            raise ValueError("tile size differs across files")
        self.nts = [h.nt for h in self.headers]
        self.nt, self.nz, self.ny, self.nx = sum(self.nts), min(h.nz for h in self.headers), self.headers[0].ny, self.headers[0].nx
        self.shape = (self.nz, self.ny, self.nx)
        validate.validate(self.cfg, self.nts)
        self.keys = [hd.Stamp.of(h.path).key for h in self.headers]
        self.shift = self.cfg.shift_px if self.cfg.shift_px is not None else int(self.cfg.grid_spacing / self.headers[0].voxel_x_um)
        self._tile_file = self._match()

    def _match(self) -> list[tuple[str, int, int]]:
        """(name, file, position) of every tile in every file it lives in; one that is not there is an error."""
        rows = []
        for name, p in self.cfg.positions.items():
            for f, h in enumerate(self.headers):
                if p.alive_in_file(f, len(self.headers)):
                    at = h.position_of((name, *p.aliases))
                    if at is None:
                        raise ValueError(f"'{name}' should be alive in file {f} but no position there has its name")
                    rows.append((name, f, at))
        return rows

    @cached_property
    def files(self) -> DataFrame:
        return hd.header_rows(self.spark, self.headers, self.keys)

    @cached_property
    def times(self) -> DataFrame:
        return layout.timeline(self.files)

    @cached_property
    def tile_file(self) -> DataFrame:
        return self.spark.createDataFrame(self._tile_file, "name string, file_i int, pos_i int")

    @cached_property
    def points(self) -> DataFrame:
        rows = [(f, n, *self.headers[f].stage_um[p]) for n, f, p in self._tile_file]
        return self.spark.createDataFrame(rows, "file_i int, name string, x_um double, y_um double")

    @cached_property
    def overrides(self) -> DataFrame:
        return self.cfg.override_rows(self.spark).select("t", "verb", "name")

    @cached_property
    def state(self) -> DataFrame:
        tiles = layout.lifetimes(self.cfg.position_rows(self.spark), self.files)
        return layout.tile_state(tiles, self.times, self.cfg.reference_rows(self.spark), self.overrides)

    @cached_property
    def pairs(self) -> DataFrame:
        return layout.neighbour_pairs(self.points, self.cfg.grid_spacing, self.cfg.grid_spacing_error, self.cfg.flip_x, self.cfg.flip_y)

    @cached_property
    def pairs_at(self) -> DataFrame:
        return layout.pair_state(self.pairs, self.state)

    @cached_property
    def tops(self) -> DataFrame:
        return graph.topologies(self.state, self.pairs_at)

    @cached_property
    def placements(self) -> DataFrame:
        return graph.placements(self.tops)

    @cached_property
    def plan(self) -> DataFrame:
        refs = tasks.volumes(self.state, self.times, self.tile_file, self.files, self.nz)
        crop, again = (cf.clamp_z(s, self.nz) for s in (self.cfg.slices, self.cfg.realignment_slices))
        times = tasks.time_tasks(self.state, refs, self.overrides, tasks.crop_json(*crop), tasks.crop_json(*again), self.precision)
        pairs = tasks.pair_tasks(self.pairs_at, refs, {a: tasks.crop_json(*crop, free_axis=a) for a in (1, 2)}, self.shift, self.precision)
        return tasks.plan(times, pairs)

    def routings(self, t0: int = 0, t1: int | None = None) -> dict[int, tp.Routing]:
        """Routings on the driver, for text output; they are of the configuration's size."""
        at = self.tops.where((F.col("t") >= t0) & (F.col("t") < (self.nt if t1 is None else t1)))
        of = {}
        for r in at.select("t", "topology").join(self.placements, "topology").toLocalIterator():
            steps = [tp.Step(s["tile"], s["kind"], s["via"], s["axis"]) for s in r["steps"]]
            of[r["t"]] = tp.Routing(steps, [tuple(e) for e in r["redundant"]], list(r["unplaced"]), [tuple(g) for g in r["over_anchored"]])
        return of

    def graph_problems(self) -> list[str]:
        """Timepoints without tiles, parts without an anchor, anchors without a place before: only what is found is gathered."""
        living = self.state.select("t", "name")
        empty = self.times.select("t").join(living, "t", "left_anti").withColumn("name", F.lit("all tiles"))
        bare = graph.unanchored(graph.components(self.tops), self.state).select(F.regexp_replace("tiles", ",", "+").alias("name"), "ts")
        born = self.state.where("anchor and t > 0").select("t", "name").join(living.select((F.col("t") + 1).alias("t"), "name"), ["t", "name"], "left_anti")
        found = {"empty": graph.ranges(empty, "name"), "unanchored": bare, "newborn-anchor": graph.ranges(born, "name")}
        return [f"{code}: {validate.GRAPH_RULES[code].format(r['name'], r['ts'])}" for code, rows in found.items() for r in rows.orderBy("name").collect()]

    def offsets(self) -> DataFrame:
        return store.read_offsets(self.spark, self.work.offsets)

    # --- work ----------------------------------------------------------------------------------------------
    def compute(self, t0: int = 0, t1: int | None = None, limit: int | None = None, slice_t: int = 64, attempts: int = 4, at_most: int | None = None, max_mb: float | None = None) -> int:
        """Correlates what is pending in [t0, t1) and appends to the log, in slices of timepoints, so that a crash loses one
        slice at most; returns how many tasks ran.  ``at_most`` Spark tasks work at once, and each holds volumes and spectra
        of ``max_mb`` (two of each at least)."""
        keep = 4 * BLOCK
        if max_mb is not None:
            voxels = self.nz * self.ny * self.nx
            keep = max(2, int(max_mb * 1e6 // (voxels * (2 + (8 if self.precision == "float32" else 16) / 2))))  # half a spectrum
        todo = tasks.between(self.plan, t0, self.nt if t1 is None else t1)
        paths = {k: h.path for h, k in zip(self.headers, self.keys, strict=True)}
        waiting = tasks.pending(todo, self.offsets())
        if limit is not None:
            waiting = waiting.orderBy(*tasks.ORDER).limit(limit)
        waiting = waiting.dropDuplicates(["key"]).persist()
        blocks = coords.durable(tasks.tile_blocks(self.points, self.cfg.grid_spacing, BLOCK))
        try:
            slices = [r["s"] for r in waiting.select(F.floor(F.col("t") / slice_t).alias("s")).distinct().orderBy("s").collect()]
            n = 0
            for s in slices:  # nothing is read for slices without tasks
                part = waiting.where(F.floor(F.col("t") / slice_t) == s)
                found = correlate.correlate_stored(part, paths, self.nz, *(cf.clamp_z(x, self.nz) for x in (self.cfg.slices, self.cfg.realignment_slices)), self.shift, self.precision, keep=keep, blocks=blocks, at_most=at_most)
                n += store.patiently(lambda found=found: store.append_offsets(found, self.work.offsets), attempts)
            return n
        finally:
            waiting.unpersist()

    def coordinates(self, t0: int = 0, t1: int | None = None) -> DataFrame:
        """Placed tiles up to t1; offsets that are wanting raise: drifts always, pairs from t0 on."""
        t1 = self.nt if t1 is None else t1
        steps = graph.steps(self.tops.where(F.col("t") < t1), self.placements)
        known = self.plan.join(self.offsets().select("key", "dz", "dy", "dx"), "key", "left")
        nodes = coords.nodes_of(steps, known.select("t", "kind", "a", "b", "axis", "dz", "dy", "dx"))
        placed = coords.path_sum(nodes)
        lost = [f"{r['kind']} {r['name']} t={r['t']}" for r in coords.missing(nodes, placed, t0).orderBy("t", "name").collect()]
        if lost:
            raise MissingOffsets(lost, f"compute the offsets of {t0}..{t1} first (drifts also need every step from t=0)")
        return placed.where((F.col("t") >= t0) & F.col("placed"))

    def blend(self, output: str | Path | None = None, t0: int = 0, t1: int | None = None, dtype: str = "uint16", pad=(0, 0, 0), chunk=(32, 512, 512), skeleton: bool = False, force: bool = False, at_once: int = 1, attempts: int = 4, log: bool = True, at_most: int | None = None) -> int:
        """Writes the chunks of timepoints that are not written with their present coordinates; returns their number.

        One job writes ``at_once`` timepoints, 0: all of them, which are then marked in the log.  Chunks lie in the frame of
        their timepoint's key, and a job composes only chunks that are not in their frame; so of a job that broke off, what
        its ended tasks wrote counts.  Frames of earlier keys go after the mark.  Without ``log`` all timepoints are written
        and none is marked.  ``at_most`` tasks write at once.  ``timings`` has a row for each job: seconds in all, and of its tasks' reading and composing.
        """
        output = Path(output) if output else self.work.canvas
        marks = f"{output}.log.jsonl"
        self.timings: list[dict] = []
        placed = self.coordinates(t0, t1)
        if skeleton:
            placed = coords.restrict(placed, graph.skeleton(self.tops, self.placements))
        placed = placed.persist()
        try:
            needed = coords.required(coords.extent(placed, self.shape, 0, self.nt), self.nt, pad).first()
            want = {"origin": [needed[c] for c in ("oz", "oy", "ox")], "shape": [self.nt, *(needed[c] for c in ("nz", "ny", "nx"))], "dtype": dtype}
            row = lambda g: self.spark.createDataFrame([(*g["origin"], *g["shape"])], "oz int, oy int, ox int, nt int, nz int, ny int, nx int")
            held = store.load_geometry(output) or want
            bad = [f"t={r['t']} {r['name']}" for r in coords.violations(coords.boxes(placed, row(held), self.shape), row(held)).limit(50).collect()]
            geometry, new = store.resolve_geometry(output, want, bad)
            if new:
                store.save_geometry(output, geometry)
            keys = store.blend_keys(placed, geometry["origin"], dtype)
            again = force or not log
            todo = keys if again else store.unfinished(keys, store.read_blend_log(self.spark, marks))
            todo = sorted((r["t"], r["key"]) for r in todo.collect())  # a row per timepoint
            if again and todo:  # chunks that are there don't count, nor do marks, until they are made anew
                if log:
                    store.mark(self.spark, marks, [(t, "", None) for t, _ in todo])
                canvas.clear(str(output), {t: None for t, _ in todo})
            refs = tasks.volumes(self.state, self.times, self.tile_file, self.files, self.nz)
            named = self.spark.createDataFrame([(h.path, k) for h, k in zip(self.headers, self.keys, strict=True)], "path string, file string")
            volumes = coords.durable(refs.join(named, "file").select("t", "name", "path", "pos", "local_t"))
            boxed = coords.durable(coords.boxes(placed, row(geometry), self.shape))
            edges = coords.durable(canvas.edge_lengths(placed, self.pairs_at, self.shape))
            step = at_once or max(1, len(todo))
            for k in range(0, len(todo), step):
                some, began, seen = todo[k : k + step], time.monotonic(), Observation()
                frames = {t: canvas.frame_name(key, chunk) for t, key in some}
                at = self.spark.createDataFrame(list(frames.items()), "t int, frame string")
                open_ = canvas.chunk_refs(boxed, chunk).join(at, "t").join(canvas.written(self.spark, str(output)), ["t", "frame", "cz", "cy", "cx"], "left_anti").drop("frame")
                chunks = canvas.compose_chunks(open_, volumes, edges, geometry, chunk, dtype, self.shape, **({"at_most": at_most} if at_most else {})).join(F.broadcast(at), "t")  # a short row per timepoint of the job
                chunks = chunks.observe(seen, F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum("read_s"), F.lit(0.0)).alias("read_s"), F.coalesce(F.sum("compose_s"), F.lit(0.0)).alias("compose_s")).drop("read_s", "compose_s")
                store.patiently(lambda chunks=chunks: canvas.write_chunks(chunks, str(output)), attempts)
                if log:
                    boxes = {r["t"]: [[r[f"{c}_lo"], r[f"{c}_hi"]] for c in coords.ZYX] for r in coords.bbox(boxed.join(at, "t", "left_semi")).collect()}
                    store.mark(self.spark, marks, [(t, key, boxes.get(t)) for t, key in some])
                canvas.clear(str(output), frames)
                self.timings.append({"t": [t for t, _ in some], "seconds": time.monotonic() - began, "driver_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, **seen.get})
            return len(todo)
        finally:
            placed.unpersist()
