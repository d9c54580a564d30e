"""Coordinates as a path sum over the forest of routing steps, extents and canvas geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored

ZYX = ("z", "y", "x")


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder, which a cluster has to name; a private one serves a local master alone."""
    return stored(df)


def path_sum(nodes: DataFrame) -> DataFrame:
    """t, name, z, y, x, placed for ``nodes(t, name, pt, pname, dz, dy, dx)``.

    A root has no parent (``pt`` null) and lies at zero; any other node lies at its parent plus its own offset.  Null
    offsets, and parents that are not there, leave a node and all below it unplaced.  Pointers double in every round, so
    there are as many joins as the logarithm of the longest chain; links that run in a circle raise.
    """
    own = {c: F.when(F.col("pt").isNull(), F.lit(0.0)).otherwise(F.col(f"d{c}").cast("double")) for c in ZYX}
    # a chain is open while it has a parent; it is dead once a link lacks its offset or its parent
    open_ = nodes.select("t", "name", "pt", "pname", *[e.alias(c) for c, e in own.items()], (F.col("pt").isNotNull() & F.col("dz").isNull()).alias("dead"))
    open_ = durable(open_)
    rounds = open_.count().bit_length() + 1
    while True:
        if not rounds:
            some = open_.where("pt is not null and not dead").first()
            raise ValueError(f"the route of {some['name']} at t={some['t']} runs in a circle")
        rounds -= 1
        up = open_.select(F.col("t").alias("pt"), F.col("name").alias("pname"), F.col("pt").alias("gt"), F.col("pname").alias("gname"), *[F.col(c).alias(f"p{c}") for c in ZYX], F.col("dead").alias("pdead"), F.lit(True).alias("there"))
        joined = open_.join(up, ["pt", "pname"], "left")
        stop = F.col("pt").isNull() | F.col("dead")
        lost = ~stop & F.col("there").isNull()
        new = joined.select("t", "name", F.when(stop | lost, None).otherwise(F.col("gt")).alias("pt"), F.when(stop | lost, None).otherwise(F.col("gname")).alias("pname"), *[F.when(stop | lost, F.col(c)).otherwise(F.col(c) + F.coalesce(F.col(f"p{c}"), F.lit(0.0))).alias(c) for c in ZYX], (F.col("dead") | lost | F.coalesce("pdead", F.lit(False)) & ~stop).alias("dead"))
        open_ = durable(new)
        if open_.where("pt is not null and not dead").isEmpty():
            return open_.select("t", "name", *[F.when(~F.col("dead"), F.col(c)).alias(c) for c in ZYX], (~F.col("dead")).alias("placed"))


def missing(nodes: DataFrame, placed: DataFrame, t0: int = 0) -> DataFrame:
    """t, name, kind of nodes without their own offset whose parent is placed; pairs only from ``t0`` on."""
    parents = placed.where("placed").select(F.col("t").alias("pt"), F.col("name").alias("pname"))
    return nodes.where((F.col("kind") != "origin") & F.col("dz").isNull() & ((F.col("kind") == "drift") | (F.col("t") >= t0))).join(parents, ["pt", "pname"], "left_semi").select("t", "name", "kind")


def nodes_of(steps: DataFrame, offsets: DataFrame) -> DataFrame:
    """Forest nodes of routing steps: the parent of a drift is the tile one timepoint earlier, of a pair the tile it hangs on.

    ``offsets(t, kind, a, b, axis, dz, dy, dx)``: a pair's offset leads from ``a`` to ``b`` and counts negative the other way.
    """
    d = [f"d{c}" for c in ZYX]
    s = steps.withColumns({"pt": F.when(F.col("kind") == "drift", F.col("t") - 1).when(F.col("kind") == "pair", F.col("t")), "pname": F.when(F.col("kind") == "drift", F.col("tile")).otherwise(F.col("via"))})
    drift = offsets.where("kind = 'time'").select("t", F.col("a").alias("tile"), F.lit("drift").alias("kind"), F.lit(0).alias("axis"), F.lit(None).cast("string").alias("via"), *d)
    pair = offsets.where("kind = 'pair'")
    forward = pair.select("t", F.col("b").alias("tile"), F.lit("pair").alias("kind"), "axis", F.col("a").alias("via"), *d)
    backward = pair.select("t", F.col("a").alias("tile"), F.lit("pair").alias("kind"), "axis", F.col("b").alias("via"), *[(-F.col(c)).alias(c) for c in d])
    known = drift.union(forward).union(backward).withColumn("via", F.coalesce("via", F.lit("")))
    s = s.withColumn("via", F.coalesce("via", F.lit("")))
    return s.join(known, ["t", "tile", "kind", "axis", "via"], "left").select("t", F.col("tile").alias("name"), "kind", "pt", "pname", *d)


def extent(placed: DataFrame, shape: tuple[int, int, int], t0: int, t1: int) -> DataFrame:
    """z_lo, z_hi, ... over the placed tiles of [t0, t1)."""
    here = placed.where("placed").where((F.col("t") >= t0) & (F.col("t") < t1))
    return here.agg(*[e for c, n in zip(ZYX, shape, strict=True) for e in (F.min(c).alias(f"{c}_lo"), (F.max(c) + n).alias(f"{c}_hi"))])


def restrict(placed: DataFrame, keep: DataFrame) -> DataFrame:
    return placed.join(keep.select("t", "name").distinct(), ["t", "name"], "left_semi")


def required(ext: DataFrame, nt: int, pad: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """Canvas origin and shape that hold an extent with padding on both sides."""
    return ext.select(*[F.floor(F.col(f"{c}_lo") - p).cast("int").alias(f"o{c}") for c, p in zip(ZYX, pad, strict=True)], F.lit(nt).alias("nt"), *[F.ceil(F.col(f"{c}_hi") - F.col(f"{c}_lo") + 2 * p).cast("int").alias(f"n{c}") for c, p in zip(ZYX, pad, strict=True)])


def boxes(placed: DataFrame, geometry: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """t, name and the half-open box of every placed tile on the canvas; offsets truncate."""
    at = placed.where("placed").crossJoin(F.broadcast(geometry))  # one row
    lo = {f"{c}_lo": (F.col(c) - F.col(f"o{c}")).cast("int") for c in ZYX}
    return at.withColumns(lo).select("t", "name", *[e for c, n in zip(ZYX, shape, strict=True) for e in (F.col(f"{c}_lo"), (F.col(f"{c}_lo") + n).alias(f"{c}_hi"))])


def violations(boxed: DataFrame, geometry: DataFrame) -> DataFrame:
    """Boxes that do not fit the canvas."""
    bad = None
    for c in ZYX:
        one = (F.col(f"{c}_lo") < 0) | (F.col(f"{c}_hi") > F.col(f"n{c}"))
        bad = one if bad is None else bad | one
    return boxed.crossJoin(F.broadcast(geometry)).where(bad).select(*boxed.columns)


def slack(geometry: DataFrame, needed: DataFrame) -> DataFrame:
    """Canvas size beyond what is needed, per axis."""
    return geometry.select(*[F.col(f"n{c}").alias(f"c{c}") for c in ZYX]).crossJoin(needed.select(*[F.col(f"n{c}") for c in ZYX])).select(*[(F.col(f"c{c}") - F.col(f"n{c}")).alias(f"slack_{c}") for c in ZYX])


def bbox(boxed: DataFrame) -> DataFrame:
    """Union of the boxes of each timepoint."""
    return boxed.groupBy("t").agg(*[e for c in ZYX for e in (F.min(f"{c}_lo").alias(f"{c}_lo"), F.max(f"{c}_hi").alias(f"{c}_hi"))])


def union_bbox(a: DataFrame, b: DataFrame) -> DataFrame:
    """Null-aware union of two tables of boxes by timepoint."""
    return bbox(a.select("t", *[f"{c}_{e}" for c in ZYX for e in ("lo", "hi")]).unionByName(b.select("t", *[f"{c}_{e}" for c in ZYX for e in ("lo", "hi")])))


def snap_to_chunks(regions: DataFrame, chunk: tuple[int, int, int], shape: DataFrame) -> DataFrame:
    """Regions grown to chunk borders: floor below, ceiling above, clipped to the canvas."""
    out = regions.crossJoin(F.broadcast(shape.select(*[f"n{c}" for c in ZYX])))
    up = {f"{c}_hi": F.least((F.ceil(F.col(f"{c}_hi") / k) * k).cast("int"), F.col(f"n{c}")) for c, k in zip(ZYX, chunk, strict=True)}
    down = {f"{c}_lo": (F.floor(F.col(f"{c}_lo") / k) * k).cast("int") for c, k in zip(ZYX, chunk, strict=True)}
    return out.withColumns(up | down).select(*regions.columns)


def chunk_hits(boxed: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """t, cz, cy, cx, n_tiles: chunks that some box overlaps, by listing each box's chunks instead of a range join."""
    out = boxed
    for c, k in zip(ZYX, chunk, strict=True):
        out = out.withColumn(f"c{c}", F.explode(F.sequence(F.floor(F.col(f"{c}_lo") / k).cast("int"), F.floor((F.col(f"{c}_hi") - 1) / k).cast("int"))))
    return out.groupBy("t", "cz", "cy", "cx").agg(F.count("*").alias("n_tiles"))


def z_segments(boxed: DataFrame, region_z: int) -> DataFrame:
    """t, za, zb, tiles (comma-joined, may be empty): runs of planes that the same tiles cover.

    The marks of a timepoint, planes where a box begins or ends, are numbered; a box covers the runs from the mark of its
    beginning to that of its end, so only what is covered becomes a row.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("t").orderBy("za")  # at most two marks for each tile of a timepoint
    marks = boxed.select("t", F.explode(F.array(F.lit(0), F.lit(region_z), "z_lo", "z_hi")).alias("za")).where(F.col("za").between(0, region_z)).distinct()
    runs = marks.withColumns({"run": F.row_number().over(w), "zb": F.lead("za").over(w)})
    number = lambda c: runs.select("t", F.col("za").alias(c), F.col("run").alias(f"{c}_run"))
    inner = boxed.select("t", "name", F.greatest("z_lo", F.lit(0)).alias("z_lo"), F.least("z_hi", F.lit(region_z)).alias("z_hi")).where("z_lo < z_hi")
    covers = inner.join(number("z_lo"), ["t", "z_lo"]).join(number("z_hi"), ["t", "z_hi"]).select("t", "name", F.explode(F.sequence("z_lo_run", F.col("z_hi_run") - 1)).alias("run"))
    tiles = covers.groupBy("t", "run").agg(F.concat_ws(",", F.sort_array(F.collect_list("name"))).alias("tiles"))
    return runs.where("zb is not null").join(tiles, ["t", "run"], "left").select("t", "za", "zb", F.coalesce("tiles", F.lit("")).alias("tiles"))
