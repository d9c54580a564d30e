"""Timeline, tile lifetimes, neighbour pairs and masks, as long-form DataFrames.

A mask is a set of rows, never a matrix: ``tile_state(t, name, file_i, anchor)`` has a row where a tile is alive,
``pair_state(t, a, b, axis)`` where both ends of a pair are.  Ranges are half-open throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import coords


def with_file_start(files: DataFrame) -> DataFrame:
    """``files(file_i, nt, ...)`` with the exclusive prefix sum of ``nt``; the table has a row per file."""
    before = Window.orderBy("file_i").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("file_start", F.coalesce(F.sum("nt").over(before), F.lit(0)).cast("int"))


def timeline(files: DataFrame) -> DataFrame:
    """t, file_i, local_t: a row per global timepoint."""
    some = with_file_start(files).where("nt > 0")  # sequence(0, -1) would count down
    local = some.select("file_i", "file_start", F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("local_t"))
    return local.select((F.col("file_start") + F.col("local_t")).cast("int").alias("t"), F.col("file_i").cast("int").alias("file_i"), F.col("local_t").cast("int").alias("local_t"))


def locate(files: DataFrame, points: DataFrame) -> DataFrame:
    """t, file_i, local_t of each point: the last file that starts at or before it; a point outside raises."""
    found = points.select(F.col("t").cast("int").alias("t")).join(timeline(files), "t", "left")
    outside = F.raise_error(F.concat(F.lit("timepoint out of range: "), F.col("t").cast("string")))
    return found.select("t", F.when(F.col("file_i").isNull(), outside.cast("int")).otherwise(F.col("file_i")).alias("file_i"), "local_t")


def lifetimes(positions: DataFrame, files: DataFrame) -> DataFrame:
    """name, first_t, last_t for ``positions(name, start_file, start_t, end_file)``; a null end means the last file's end.

    A start or an end outside the files raises.
    """
    starts = with_file_start(files).select("file_i", "file_start", "nt")
    s, e = starts.alias("s"), starts.alias("e")
    total = files.agg(F.coalesce(F.sum("nt"), F.lit(0)).cast("int").alias("nt_all"))  # one row
    joined = positions.join(s, F.col("start_file") == F.col("s.file_i"), "left").join(e, F.col("end_file") - 1 == F.col("e.file_i"), "left").join(F.broadcast(total))
    outside = lambda what: F.raise_error(F.concat(F.col("name"), F.lit(f": {what} lies outside the files"))).cast("int")
    last = F.when(F.col("end_file").isNull(), F.col("nt_all")).when(F.col("e.file_start").isNull(), outside("end")).otherwise(F.col("e.file_start") + F.col("e.nt"))
    first = F.when(F.col("s.file_start").isNull(), outside("start")).otherwise(F.col("s.file_start") + F.col("start_t"))
    return joined.select("name", first.cast("int").alias("first_t"), last.cast("int").alias("last_t"))


def ranked(rows: DataFrame, by: str, rank: str) -> DataFrame:
    """``rows`` with the place of each in the order of ``by``, from 0: sorted by ranges, counted by range, numbered within."""
    ranges = coords.durable(rows.repartitionByRange(by).withColumn("__range", F.spark_partition_id()))
    sizes = ranges.groupBy("__range").agg(F.count("*").alias("n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(by))
    return ranges.withColumn("__at", within).join(starts, "__range").select(*rows.columns, (F.col("first") + F.col("__at") - 1).cast("long").alias(rank))


def alive_spans(tiles: DataFrame) -> DataFrame:
    """t, name of every timepoint of every lifetime."""
    return tiles.where("first_t < last_t").select(F.explode(F.sequence("first_t", F.col("last_t") - 1)).alias("t"), "name")


def tile_state(tiles: DataFrame, times: DataFrame, references: DataFrame, overrides: DataFrame) -> DataFrame:
    """t, name, file_i, anchor for living tiles.

    Overrides work in three passes whatever the order of their blocks: everything is dropped, then unanchored, then
    anchored; a dropped tile is never an anchor.  ``references(name, file_i)``, ``overrides(t, verb, name)``.
    """
    verb = lambda v: overrides.where(F.col("verb") == v).select("t", "name").distinct()
    alive = alive_spans(tiles).join(verb("drop"), ["t", "name"], "left_anti").join(times.select("t", "file_i"), "t")
    flags = [references.select("file_i", "name").distinct().withColumn("ref", F.lit(True)), verb("unanchor").withColumn("off", F.lit(True)), verb("anchor").withColumn("on", F.lit(True))]
    state = alive.join(flags[0], ["file_i", "name"], "left").join(flags[1], ["t", "name"], "left").join(flags[2], ["t", "name"], "left")
    anchor = F.col("on").isNotNull() | (F.col("ref").isNotNull() & F.col("off").isNull())
    return state.select("t", "name", "file_i", anchor.alias("anchor"))


def neighbour_pairs(points: DataFrame, spacing: float, error: float, flip_x: bool = False, flip_y: bool = False) -> DataFrame:
    """a, b, axis of adjacent tiles for ``points(file_i, name, x_um, y_um)``, over all files.

    An equi-join on the file and on a grid of the spacing's size keeps candidates to neighbouring cells; all comparisons
    are strict, ``a`` has the larger coordinate, and flips come after discovery.
    """
    cell = spacing + error
    lo, hi = spacing - error, spacing + error
    grid = points.select("file_i", "name", "x_um", "y_um", F.floor(F.col("x_um") / cell).alias("gx"), F.floor(F.col("y_um") / cell).alias("gy"))
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    left = grid.withColumn("d", F.explode(near)).select("file_i", F.col("name").alias("n_i"), F.col("x_um").alias("x_i"), F.col("y_um").alias("y_i"), (F.col("gx") + F.col("d.i")).alias("gx"), (F.col("gy") + F.col("d.j")).alias("gy"))
    right = grid.select("file_i", F.col("name").alias("n_j"), F.col("x_um").alias("x_j"), F.col("y_um").alias("y_j"), "gx", "gy")
    met = left.join(right, ["file_i", "gx", "gy"]).where("n_i < n_j").withColumns({"dx": F.col("x_i") - F.col("x_j"), "dy": F.col("y_i") - F.col("y_j")})

    def along(step: str, across: str, axis: int, flip: bool) -> DataFrame:
        d = F.col(step)
        forward = (d > lo) & (d < hi)
        a, b = F.when(forward, F.col("n_i")).otherwise(F.col("n_j")), F.when(forward, F.col("n_j")).otherwise(F.col("n_i"))
        hit = met.where((F.abs(F.col(across)) < error) & (forward | ((d > -hi) & (d < -lo))))
        return hit.select((b if flip else a).alias("a"), (a if flip else b).alias("b"), F.lit(axis).alias("axis"))

    return along("dy", "dx", 1, flip_y).union(along("dx", "dy", 2, flip_x)).distinct()


def pair_state(pairs: DataFrame, state: DataFrame) -> DataFrame:
    """t, a, b, axis while both ends live."""
    a, b = state.select("t", F.col("name").alias("a")), state.select("t", F.col("name").alias("b"))
    return a.join(pairs, "a").join(b, ["t", "b"]).select("t", "a", "b", "axis")


def layout_stats(files: DataFrame) -> DataFrame:
    """nt, nz (least), ny, nx; more than one lateral size raises."""
    one = lambda c: F.when(F.count_distinct(c) == 1, F.max(c)).otherwise(F.raise_error(F.lit("tile size differs across files")).cast("int")).alias(c)
    return files.agg(F.sum("nt").cast("int").alias("nt"), F.min("nz").alias("nz"), one("ny"), one("nx"))


def default_shift(spacing: float, voxel_x_um: Column) -> Column:
    """Whole pixels between neighbours, truncated."""
    return (F.lit(float(spacing)) / voxel_x_um).cast("int")


def timeline_report(files: DataFrame, state: DataFrame) -> DataFrame:
    """Per file: first and last timepoint, length, living tiles and anchors at its first timepoint."""
    spans = with_file_start(files).where("nt > 0").select("file_i", F.col("file_start").alias("t"), "nt")
    seen = spans.join(state.drop("file_i"), "t", "left").groupBy("file_i", "t", "nt").agg(F.count("name").alias("n_alive"), F.count(F.when(F.col("anchor"), 1)).alias("n_anchors"))
    return seen.select("file_i", F.col("t").alias("first_t"), (F.col("t") + F.col("nt")).alias("end_t"), "nt", "n_alive", "n_anchors")
