"""The operators as named queries over the virtual acquisition."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import canvas, coords, correlate, drift, graph, layout, pencil, scan, tasks, validate
from ..sources import store, volumes
from ..sources.shared import shared_folder
from .acquisition import ERROR, SHAPE, SPACING, VOLUME, Acquisition

Query = Callable[[SparkSession, str], DataFrame]
CHUNK = (4, 32, 32)
ALL: dict[str, Query] = {}


def query(f):
    ALL[f.__name__] = lambda spark, sf_dir: f(Acquisition(spark, sf_dir))
    return f


@query
def timeline_prefix_sum(a):
    return layout.with_file_start(a.files).select("file_i", "nt", "file_start")


@query
def locate_asof(a):
    points = a.table("orders").crossJoin(F.broadcast(a.files.agg(F.sum("nt").alias("n")))).select((F.col("o_orderkey") % F.col("n")).cast("int").alias("t")).distinct()
    return layout.locate(a.files, points)


@query
def tile_lifetime(a):
    return a.tiles


@query
def tile_index(a):
    return layout.ranked(a.tiles.select("name"), "name", "i")


@query
def alive_mask(a):
    return a.state.select("t", "name")


@query
def anchor_mask_overrides(a):
    return a.state.where("anchor").select("t", "name", "file_i")


@query
def override_lookup(a):
    return a.overrides.groupBy("t", "verb").agg(F.concat_ws(",", F.sort_array(F.collect_set("name"))).alias("names"))


@query
def tile_files(a):
    return a.tile_file


@query
def frame_index(a):
    return a.refs.select("t", "name", "file", "pos", "local_t")


@query
def neighbour_pairs(a):
    return a.pairs


@query
def neighbour_pairs_flipped(a):
    return layout.neighbour_pairs(a.points, SPACING, ERROR, True, True)


@query
def pair_alive(a):
    return a.pairs_at


@query
def layout_stats(a):
    return layout.layout_stats(a.files)


@query
def default_shift(a):
    return a.files.select("file_i", layout.default_shift(SPACING, F.col("voxel_x_um")).alias("shift_px"))


@query
def timeline_report(a):
    return layout.timeline_report(a.files, a.state)


@query
def plan_time_tasks(a):
    return a.time_tasks.select("t", F.col("a").alias("name"), "realign", "key", "what")


@query
def plan_pair_tasks(a):
    return a.pair_tasks.select("t", "a", "b", "axis", "key", "what")


@query
def plan_between(a):
    return tasks.between(a.plan, 100, 200).groupBy("t", "kind").agg(F.count("*").alias("n"))


@query
def plan_order_limit(a):
    return tasks.first_pending(a.plan, a.done, 500).select("t", "kind", "what")


@query
def volume_uses(a):
    return tasks.volume_uses(a.plan)


@query
def spectrum_uses(a):
    return tasks.spectrum_uses(a.plan)


@query
def content_keys(a):
    return a.files.select("file_i", "file_key")


@query
def pending_tasks(a):
    return tasks.pending(a.plan, a.done).select("key", "t", "kind")


@query
def show_tasks(a):
    """The tasks of one timepoint with their offsets, where there are any."""
    part = lambda k: (F.conv(F.substring("key", k, 1), 16, 10).cast("int") - 8)
    return tasks.show(a.plan, a.done.select("key", part(5).alias("dz"), part(6).alias("dy"), part(7).alias("dx")), 100)


@query
def status_summary(a):
    return tasks.status(a.plan, a.done)


def _log(a):
    seq = [c for c in ("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    return a.table("lineitem").select(F.col("l_orderkey").alias("key"), *seq), seq


@query
def memo_last_wins(a):
    log, seq = _log(a)
    last = tasks.last_wins(log, "key", seq)
    d = lambda c, m: (F.col(c) % m - m // 2).cast("long")
    return last.select("key", d("l_partkey", 5).alias("dz"), d("l_suppkey", 21).alias("dy"), d("l_linenumber", 21).alias("dx"))


@query
def memo_compact_count(a):
    log, seq = _log(a)
    return log.agg(F.count("*").alias("n_lines"), F.count_distinct("key").alias("n_keys")).withColumn("n_superseded", F.col("n_lines") - F.col("n_keys"))


@query
def offset_log(a):
    """The result log after three appends, each of what is then the last row of its keys."""
    log, seq = _log(a)
    path = f"{shared_folder(a.spark)}/offsets-{uuid.uuid4().hex}.jsonl"
    d = lambda c, m: (F.col(c) % m - m // 2).cast("int")
    line = F.col("l_linenumber")
    for some in (line < 3, (line >= 3) & (line < 5), line >= 5):
        last = tasks.last_wins(log.where(some), "key", seq)
        store.append_offsets(last.select(F.col("key").cast("string").alias("key"), F.lit("time").alias("kind"), F.concat(F.lit("line "), line.cast("string")).alias("what"), d("l_partkey", 5).alias("dz"), d("l_suppkey", 21).alias("dy"), d("l_linenumber", 21).alias("dx")), path)
    return store.read_offsets(a.spark, path)


@query
def blend_keys(a):
    """Digest of the frame and the coordinates of each timepoint."""
    return store.blend_keys(a.placed, (0, -8, -8), "uint16")


def _vectors(a):
    """Vectors as volumes of ``VOLUME``; one of another size raises."""
    n = VOLUME[0] * VOLUME[1] * VOLUME[2]
    misfit = F.raise_error(F.concat(F.lit(f"no volume of {n} voxels: vector "), F.col("vec_id").cast("string")))
    return a.table("embeddings").select("vec_id", F.when(F.size("embedding") == n, F.col("embedding")).otherwise(misfit).alias("embedding"))


def _vector_tasks(a, axis: int, shift: int):
    e = _vectors(a)
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("dst"))
    return e.join(nxt, "vec_id").select(F.col("vec_id").cast("string").alias("key"), F.col("embedding").alias("src"), "dst", F.lit(axis).alias("axis"), F.lit(shift).alias("shift_px"))


def _found(df):
    return df.select(F.col("key").cast("long").alias("vec_id"), "dz", "dy", "dx")


@query
def phase_correlation_time(a):
    return _found(correlate.offsets(_vector_tasks(a, 0, 0), VOLUME))


@query
def phase_correlation_pair_shift(a):
    return _found(correlate.offsets(_vector_tasks(a, 2, 2), VOLUME))


def _voxels(a):
    return _vectors(a).select("vec_id", F.posexplode("embedding").alias("i", "v")).select("vec_id", F.floor(F.col("i") / 16).cast("int").alias("z"), (F.floor(F.col("i") / 4) % 4).cast("int").alias("y"), (F.col("i") % 4).alias("x"), F.col("v").cast("double").alias("v"))


@query
def response_surfaces(a):
    found = correlate.responses(_vector_tasks(a, 0, 0), VOLUME)
    return found.select(F.col("key").cast("long").alias("vec_id"), "z", "y", "x", (F.round("v", 6) + 0.0).alias("v"))


class _Itself(dict):
    """A stack's key is its path."""

    def __missing__(self, key):
        return key


@query
def stored_offsets(a):
    """Drifts between stored volumes of one position, by reference: headers tell the tasks, workers read the voxels."""
    volumes.register(a.spark)
    later = a.spark.read.format("volumes").schema("file string, pos int, local_t int").load(a.stacks).where("local_t >= 1")
    before = F.col("local_t") - 1
    block = F.element_at(F.split(F.element_at(F.split("file", "/"), -1), "_"), -1).cast("long")
    key = (block * 64 + before * 8 + F.col("pos")).cast("string")
    there = later.union(later.select("file", "pos", before)).distinct()  # an absent volume is no reference
    both = later.join(there.select("file", "pos", (F.col("local_t") + 1).alias("local_t")), ["file", "pos", "local_t"], "left_semi")
    work = both.select(key.alias("key"), F.lit("time").alias("kind"), F.lit(0).alias("kind_rank"), F.concat(F.lit("time "), "file").alias("what"), F.lit(0).alias("axis"), F.lit(False).alias("realign"), F.lit("").alias("b"), *[c.alias(f"{p}_{n}") for p, t in (("src", before), ("dst", F.col("local_t"))) for n, c in (("file", F.col("file")), ("pos", F.col("pos")), ("local_t", t))])
    full = ((None, None),) * 3
    return _found(correlate.correlate_stored(work, _Itself(), VOLUME[0], full, full, 0, "float64"))


@query
def phase_correlation_pencils(a):
    """The same by planes and pencils, for volumes that no worker holds."""
    e = _vectors(a)
    n = VOLUME[1] * VOLUME[2]
    planes = F.transform(F.sequence(F.lit(0), F.lit(VOLUME[0] - 1)), lambda z: F.slice("embedding", z * n + 1, F.lit(n)).cast("array<double>"))
    ids = e.select("vec_id")
    side = lambda k: e.join(ids.select((F.col("vec_id") + (1 if k else -1)).alias("vec_id")), "vec_id", "left_semi").select((F.col("vec_id") - k).alias("key"), F.lit(k).alias("side"), F.posexplode(planes).alias("z", "voxels"))
    return _found(pencil.offsets(side(0).union(side(1)), VOLUME, rows=2))


@query
def task_blocks(a):
    """Blocks of four tiles and eight timepoints that read each volume."""
    return tasks.volume_readers(tasks.placed_tasks(a.plan, tasks.tile_blocks(a.points, SPACING, 4), 8))


@query
def overlap_trim(a):
    return correlate.strips(_vectors(a).select("vec_id", F.col("embedding").alias("img")), VOLUME, 2, 1)


@query
def max_projection(a):
    return drift.max_projection(_voxels(a), ["vec_id", "y", "x"])


@query
def centre_crop(a):
    return drift.centre_crop(_voxels(a), 4, 4, 2)


@query
def connected_components(a):
    return graph.components_of(a.row_state, a.row_pairs)


@query
def over_anchored(a):
    return graph.over_anchored(graph.components_of(a.state, a.row_pairs), graph.started(a.state))


@query
def unanchored_components(a):
    return graph.unanchored(graph.components_of(a.row_state, a.row_pairs), a.row_state)


@query
def placement_steps(a):
    return a.row_steps.select("t", "tile", "kind", "via", "axis")


@query
def step_labels(a):
    return graph.labelled(a.row_steps).select("t", "tile", "label")


@query
def placement_flags_cyclic(a):
    return graph.flags_of(a.state, a.pairs_at)


@query
def placement_by_joins(a):
    """Numbers of steps and of redundant pairs at each timepoint, by rounds of joins."""
    steps, redundant = graph.routed(a.state, a.pairs_at)
    spare = redundant.groupBy("t").agg(F.count("*").alias("n_redundant"))
    return steps.groupBy("t").agg(F.count("*").alias("n_steps"), F.count("via").alias("n_pairs")).join(spare, "t", "left").select("t", "n_steps", "n_pairs", F.coalesce("n_redundant", F.lit(0)).alias("n_redundant"))


@query
def topology_runs(a):
    signed = a.row_state.groupBy("t").agg(F.concat_ws(",", F.sort_array(F.collect_list(F.when(F.col("anchor"), F.col("name"))))).alias("sig"))
    return graph.topology_runs(signed)


@query
def range_format(a):
    return graph.ranges(a.overrides.where("verb = 'drop'"), "name")


@query
def skeleton_tiles(a):
    return a.row_skeleton


@query
def coordinates_path_sum(a):
    return a.placed.where("placed").select("t", "name", "z", "y", "x")


@query
def coordinates_missing(a):
    return coords.missing(a.row_nodes, a.placed, 100)


@query
def extent(a):
    return coords.extent(a.placed, SHAPE, 0, 1 << 30)


def _geometry(a, pad=(0, 8, 8)):
    return coords.required(coords.extent(a.placed, SHAPE, 0, 1 << 30), 0, pad)


@query
def canvas_required_pad(a):
    return _geometry(a)


def _boxes(a):
    return coords.boxes(a.placed, _geometry(a), SHAPE)


@query
def tile_boxes(a):
    return _boxes(a)


@query
def violations(a):
    small = _geometry(a, (0, -4, -4))
    return coords.violations(coords.boxes(a.placed, small, SHAPE), small)


@query
def slack(a):
    return coords.slack(_geometry(a, (1, 16, 16)), _geometry(a))


@query
def timepoint_bbox(a):
    return coords.bbox(_boxes(a))


@query
def snap_to_chunks(a):
    return coords.snap_to_chunks(coords.bbox(_boxes(a)), CHUNK, _geometry(a))


@query
def chunk_hits(a):
    return coords.chunk_hits(_boxes(a), CHUNK)


@query
def z_segments(a):
    return coords.z_segments(_boxes(a), 64)


@query
def blend_edges(a):
    wide = a.placed.select("t", "name", "placed", "z", "y", (F.col("x") - F.substring("name", 6, 1).cast("int") * 9).alias("x"))
    return canvas.edge_lengths(wide, a.row_pairs, SHAPE).select("t", "name", "axis", "lower", "length")


@query
def blend_weights_1d(a):
    lengths = a.table("part").select(F.col("p_size").cast("int").alias("length")).where("length > 0").distinct()
    both = lengths.select(F.lit(2).alias("axis"), F.lit(True).alias("lower"), "length").union(lengths.select(F.lit(2), F.lit(False), "length"))
    return canvas.weight_lines(both).select("lower", "length", F.posexplode("weights").alias("i", "w")).select("lower", "length", "i", F.round("w", 9).alias("w"))


@query
def blend_weighted_average(a):
    """Neighbouring vectors overlap by two planes; ramps weigh both."""
    s = canvas.weighted(_pair_of_vectors(a), VOLUME).withColumnRenamed("t", "tile_pair")
    return canvas.weighted_average(s, ["tile_pair", "z", "y", "x"]).withColumn("value", F.round("value", 6))


def _pair_of_vectors(a):
    """t (a pair), name, box, voxel and edges: the second vector lies two planes along x; both fade over that length."""
    v = _voxels(a)
    second = F.col("vec_id") % 2 == 1
    edge = F.array(F.struct(F.lit(2).alias("axis"), (~second).alias("lower"), F.lit(2).alias("length")))
    return v.select(F.floor(F.col("vec_id") / 2).alias("t"), F.col("vec_id").cast("string").alias("name"), F.lit(0).alias("z_lo"), F.lit(0).alias("y_lo"), F.when(second, 2).otherwise(0).alias("x_lo"), "z", "y", "x", "v", edge.alias("edges"))


@query
def stored_volume_steps(a):
    """Sum of a stored volume and of its changes against the one before at its position; the scan of the later ones begins at
    local time 1, and nothing earlier is read for it."""
    volumes.register(a.spark)
    scan = lambda: a.spark.read.format("volumes").load(a.stacks)
    before = scan().select("file", "pos", (F.col("local_t") + 1).alias("local_t"), F.col("data").alias("old"))
    both = scan().where("local_t >= 1").select("file", "pos", "local_t", "data").join(before, ["file", "pos", "local_t"])
    found = both.mapInArrow(_changes, "file string, pos int, local_t int, total long, change long")
    return found.withColumn("file", F.element_at(F.split("file", "/"), -1))


def _changes(it):
    import numpy as np
    import pyarrow as pa

    for b in it:
        new, old = ([np.frombuffer(d, np.uint16).astype(np.int64) for d in b.column(c).to_pylist()] for c in ("data", "old"))
        own = [pa.array([int(x.sum()) for x in new], pa.int64()), pa.array([int(np.abs(x - y).sum()) for x, y in zip(new, old, strict=True)], pa.int64())]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("file", "pos", "local_t")), *own], names=["file", "pos", "local_t", "total", "change"])


@query
def blend_chunks(a):
    """Sum and count of composed voxels by chunk of two planes, as the canvas holds them; voxels come from stored stacks."""
    boxed, volumes_, edges = _two_vectors(a)
    return canvas.compose_chunks(boxed, volumes_, edges, *_TWO).mapInPandas(_chunk_sums, _SUMS)


@query
def canvas_resumed(a):
    """The same from a canvas that was written in two goes: the second composes what is not there yet."""
    boxed, volumes_, edges = _two_vectors(a)
    path = f"{shared_folder(a.spark)}/canvas-{uuid.uuid4().hex}"
    refs = canvas.chunk_refs(boxed, _TWO[1]).withColumn("frame", F.lit(canvas.frame_name("k", _TWO[1])))
    for part in (refs.where((F.col("cz") + F.col("t")) % 3 == 0), refs):
        open_ = part.join(canvas.written(a.spark, path), ["t", "frame", "cz", "cy", "cx"], "left_anti").drop("frame")
        chunks = canvas.compose_chunks(open_, volumes_, edges, *_TWO).withColumn("frame", F.lit(canvas.frame_name("k", _TWO[1])))
        canvas.write_chunks(chunks.drop("read_s", "compose_s"), path, _SPAN)
    return a.spark.read.parquet(path).select("t", "cz", "cx", "data").mapInPandas(_chunk_sums, _SUMS)


_TWO = ({"shape": [0, 4, 4, 6]}, (2, 4, 3), "uint16", VOLUME)
_SPAN = 4096  # a pair of vectors is a timepoint of four chunks
_SUMS = "t long, cz int, cx int, n_voxels int, total long"


def _two_vectors(a):
    """Boxes, volumes and edges of pairs of vectors: the second lies two planes along x."""
    v = F.col("vec_id")
    two = _vectors(a).select(F.floor(v / 2).cast("int").alias("t"), v.cast("string").alias("name"), (v % 2).cast("int").alias("second"), F.concat(F.lit(f"{a.stacks}/block_"), F.floor(v / 64).cast("string")).alias("path"), (v % 8).cast("int").alias("pos"), (F.floor(v / 8) % 8).cast("int").alias("local_t"))
    lo = {"z": F.lit(0), "y": F.lit(0), "x": F.col("second") * 2}
    boxed = two.select("t", "name", *[e for c, n in zip(coords.ZYX, VOLUME, strict=True) for e in (lo[c].alias(f"{c}_lo"), (lo[c] + n).alias(f"{c}_hi"))])
    edges = two.select("t", "name", F.lit(2).alias("axis"), (F.col("second") == 0).alias("lower"), F.lit(2).alias("length"), F.lit("a").alias("a"), F.lit("b").alias("b"))
    return boxed, two.select("t", "name", "path", "pos", "local_t"), edges


def _chunk_sums(it):
    import numpy as np

    for pdf in it:
        voxels = [np.frombuffer(d, np.uint16) for d in pdf["data"]]
        yield pdf[["t", "cz", "cx"]].assign(n_voxels=[len(v) for v in voxels], total=[int(v.sum(dtype=np.int64)) for v in voxels])


@query
def pair_offset_signs(a):
    """Offsets as a routing uses them: along a pair as they are, against it negated."""
    steps = a.row_steps.where("kind = 'pair'")
    own = lambda m, k: F.pmod(F.col("t") * m + F.col("key"), F.lit(k)) - k // 2
    known = a.row_pairs.withColumn("key", F.col("a").cast("int")).select("t", F.lit("pair").alias("kind"), "a", "b", "axis", own(3, 5).cast("int").alias("dz"), own(5, 7).cast("int").alias("dy"), own(7, 9).cast("int").alias("dx"))
    return coords.nodes_of(steps, known).select("t", "name", "pname", "dz", "dy", "dx")


@query
def coordinates_restricted(a):
    """Coordinates of the skeleton's tiles alone."""
    return coords.restrict(a.placed, a.row_skeleton).where("placed").select("t", "name", "z", "y", "x")


@query
def routes(a):
    """Number of steps from the seed and the seed of each placed tile."""
    return graph.routes_of(a.row_steps)


@query
def blend_unfinished(a):
    """Timepoints whose stored key is not that of their present coordinates: every third one was written before a move."""
    keys = a.placed.where("placed").groupBy("t").agg(F.sum(F.col("x") * 3 + F.col("y")).cast("long").alias("k")).select("t", F.col("k").cast("string").alias("key"))
    log = keys.select("t", F.when(F.col("t") % 3 == 0, F.concat("key", F.lit("'"))).otherwise(F.col("key")).alias("key")).where("t % 5 <> 0")
    return store.unfinished(keys, log).select("t")


def _series(a):
    e = scan.previous(a.table("events").select("user_id", "event_id", "ts", "value"), "user_id", ["ts", "event_id"], "value", "before")
    return e.select("user_id", "event_id", "ts", (F.col("value") - F.col("before")).alias("step")).where("step is not null")


@query
def drift_outliers(a):
    return drift.outliers(_series(a).withColumn("mag", F.abs("step")), "user_id", "mag").select("user_id", "event_id", F.round("mag", 6).alias("mag"), F.round("med", 6).alias("med"))


@query
def cumulative_drift(a):
    return drift.cumulative(_series(a), "user_id", ["ts", "event_id"], ["step"]).select("user_id", "event_id", F.round("step", 2).alias("step"), "cum_step")


@query
def drift_magnitude(a):
    return a.row_nodes.where("kind = 'drift' and dz is not null").select("t", "name", F.round(drift.magnitude(F.col("dz"), F.col("dy"), F.col("dx")), 6).alias("magnitude"))


@query
def validation_problems(a):
    return validate.table_rules(a.positions, a.files, a.references, a.overrides)
