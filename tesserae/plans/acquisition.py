"""A deterministic virtual acquisition over the driver's tables, on which the operators run.

files: blocks of five days of ``events``; tiles: ``supplier`` on a grid ten wide with jitter from the balance; overrides:
event types; volumes: ``embeddings`` as 4 x 4 x 4; the offset log: ``lineitem``.  What many tables are made of (hours, overrides,
masks) is written once, as plans that repeat its making grow beyond what the driver holds.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import coords, graph, layout, tasks
from ..sources import volumes
from ..sources.shared import shared_folder
from ..sources.ship import ship_code

SPACING, ERROR, JITTER, VOXEL = 55.0, 5.0, 7, 0.1
NZ, NY, NX = 4, 64, 64
SHAPE = (NZ, NY, NX)
VOLUME = (4, 4, 4)
CROP = ((0, 4), (None, None), (1, 3))
REALIGN = ((1, 3), (None, None), (None, None))
VERBS = {"error": "drop", "click": "unanchor", "signup": "anchor", "purchase": "realign"}


def tile_name(key):
    return F.lpad(key.cast("string"), 6, "0")


@dataclass
class Acquisition:
    spark: SparkSession
    sf_dir: str

    def __post_init__(self):
        ship_code(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def hours(self) -> DataFrame:
        e = self.table("events").select(F.floor(F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")) / 5).cast("int").alias("file_i"), F.date_trunc("hour", "ts").alias("h"))
        return coords.durable(e.distinct())

    @cached_property
    def files(self) -> DataFrame:
        out = self.hours.groupBy("file_i").agg(F.count("*").cast("int").alias("nt"))
        path = F.concat(F.lit("block_"), F.col("file_i").cast("string"), F.lit(".nd2"))
        return out.withColumns({"file_key": tasks.file_key(path, F.col("nt") * 1000, F.lit(1_700_000_000) + F.col("file_i")), "nz": F.lit(NZ) + F.col("file_i"), "ny": F.lit(NY), "nx": F.lit(NX), "voxel_x_um": F.lit(VOXEL)})

    @cached_property
    def n_files(self) -> int:
        return self.files.count()  # one row per file

    @cached_property
    def times(self) -> DataFrame:
        return layout.timeline(self.files)

    @cached_property
    def points(self) -> DataFrame:
        k = F.col("s_suppkey")
        v = F.round(F.col("s_acctbal") * 100).cast("long")
        jitter = F.pmod(v, F.lit(JITTER)) - JITTER // 2
        return self.table("supplier").select(F.lit(0).alias("file_i"), tile_name(k).alias("name"), k.cast("int").alias("key"), (F.lit(SPACING) * F.pmod(k, F.lit(10)) + jitter).alias("x_um"), (F.lit(SPACING) * F.floor(k / 10)).alias("y_um"))

    @cached_property
    def positions(self) -> DataFrame:
        k = F.col("key")
        return self.points.select("name", "key", F.pmod(k, F.lit(3)).alias("start_file"), F.pmod(k, F.lit(5)).alias("start_t"), F.when(F.pmod(k, F.lit(4)) == 0, self.n_files - 1).alias("end_file"))

    @cached_property
    def tiles(self) -> DataFrame:
        return layout.lifetimes(self.positions, self.files)

    @cached_property
    def tile_file(self) -> DataFrame:
        end = F.coalesce("end_file", F.lit(self.n_files)).cast("int")
        alive = self.positions.where(F.col("start_file") < end).withColumn("file_i", F.explode(F.sequence(F.col("start_file").cast("int"), end - 1)))
        return alive.select("name", "file_i", F.col("key").alias("pos_i"))

    @cached_property
    def references(self) -> DataFrame:
        first = F.pmod(-F.col("key"), F.lit(7)).cast("int")  # every seventh file from there on
        some = self.positions.select("name", first.alias("first")).where(F.col("first") < self.n_files)
        return some.select("name", F.explode(F.sequence("first", F.lit(self.n_files - 1), F.lit(7))).alias("file_i"))

    @cached_property
    def overrides(self) -> DataFrame:
        e = self.table("events")
        n = self.table("supplier").agg(F.count("*").alias("n"))
        file_i = F.floor(F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")) / 5).cast("int")
        from pyspark.sql import Window

        ranked = self.hours.select("file_i", "h", (F.row_number().over(Window.partitionBy("file_i").orderBy("h")) - 1).alias("local_t"))
        at = ranked.join(F.broadcast(layout.with_file_start(self.files).select("file_i", "file_start")), "file_i").select("h", (F.col("file_start") + F.col("local_t")).alias("t"))
        verb = None
        for k, v in VERBS.items():
            verb = F.when(F.col("event_type") == k, v) if verb is None else verb.when(F.col("event_type") == k, v)
        rows = e.select(F.date_trunc("hour", "ts").alias("h"), verb.alias("verb"), "user_id", file_i.alias("file_i")).where("verb is not null").join(F.broadcast(n))
        found = rows.join(at, "h").select(F.col("t").cast("int").alias("t"), "verb", tile_name(F.pmod(F.col("user_id"), F.col("n"))).alias("name"))
        return coords.durable(found.distinct())

    @cached_property
    def state(self) -> DataFrame:
        return coords.durable(layout.tile_state(self.tiles, self.times, self.references, self.overrides))

    @cached_property
    def pairs(self) -> DataFrame:
        return layout.neighbour_pairs(self.points, SPACING, ERROR)

    @cached_property
    def pairs_at(self) -> DataFrame:
        return coords.durable(layout.pair_state(self.pairs, self.state))

    @cached_property
    def refs(self) -> DataFrame:
        return tasks.volumes(self.state, self.times, self.tile_file, self.files, NZ)

    @property
    def shift(self) -> int:
        return int(SPACING / VOXEL)

    @cached_property
    def time_tasks(self) -> DataFrame:
        return tasks.time_tasks(self.state, self.refs, self.overrides, tasks.crop_json(*CROP), tasks.crop_json(*REALIGN))

    @cached_property
    def pair_tasks(self) -> DataFrame:
        return tasks.pair_tasks(self.pairs_at, self.refs, {a: tasks.crop_json(*CROP, free_axis=a) for a in (1, 2)}, self.shift)

    @cached_property
    def plan(self) -> DataFrame:
        """Written once, as the memo below is made from it."""
        return coords.durable(tasks.plan(self.time_tasks, self.pair_tasks))

    def memo(self, plan: DataFrame) -> DataFrame:
        """Keys of the computed tasks of a plan: all but every seventh by key."""
        return plan.where(F.conv(F.substring("key", 1, 4), 16, 10).cast("int") % 7 != 0).select("key")

    @cached_property
    def done(self) -> DataFrame:
        return self.memo(self.plan)

    @cached_property
    def stacks(self) -> str:
        """A folder of stacks made from the vectors that are volumes of ``VOLUME``: of each 64 in the order of ids, eight
        timepoints of eight positions; values in thousandths without their signs."""
        folder = f"{shared_folder(self.spark)}/stacks-{uuid.uuid4().hex}"
        v = F.col("vec_id")
        voxel = lambda x: F.lpad(F.hex((F.floor(F.abs(x.cast("double")) * 1000) % 65536).cast("int")), 4, "0")
        data = F.unhex(F.array_join(F.transform("embedding", lambda x: F.concat(F.substring(voxel(x), 3, 2), F.substring(voxel(x), 1, 2))), ""))  # low byte first
        rows = self.table("embeddings").where(F.size("embedding") == VOLUME[0] * VOLUME[1] * VOLUME[2])
        named = rows.select(F.concat(F.lit("block_"), F.floor(v / 64).cast("string")).alias("file"), (v % 8).alias("pos"), (F.floor(v / 8) % 8).alias("local_t"), data.alias("data"))
        volumes.write_stacks(named, folder, 8, VOLUME).count()
        return folder

    # --- a forest: rows of tiles, with one anchor -----------------------------------------
    @cached_property
    def row_state(self) -> DataFrame:
        return self.state.select("t", "name", (F.col("name") == "000000").alias("anchor"))

    @cached_property
    def row_pairs(self) -> DataFrame:
        return self.pairs_at.where("axis = 2")

    @cached_property
    def row_steps(self) -> DataFrame:
        """Written once, as much is made from it."""
        found, _ = graph.routed(self.row_state, self.row_pairs)
        return coords.durable(found.select("t", "tile", "kind", "via", "axis"))

    @cached_property
    def row_skeleton(self) -> DataFrame:
        return graph.skeleton_of(self.row_steps, self.row_state)

    @cached_property
    def row_nodes(self) -> DataFrame:
        """Routing steps with offsets made from the time and the tile; some are missing."""
        k, t = F.col("tile").cast("int"), F.col("t")
        lost = F.when(F.col("kind") == "pair", (t * 31 + k) % 97 == 0).otherwise(t % 401 == 400)
        own = lambda a, b, m: F.when(~lost, (t * a + k * b) % m - m // 2)
        s = self.row_steps
        return coords.durable(s.select("t", F.col("tile").alias("name"), "kind", F.when(F.col("kind") == "drift", t - 1).when(F.col("kind") == "pair", t).alias("pt"), F.when(F.col("kind") == "drift", F.col("tile")).otherwise(F.col("via")).alias("pname"), own(7, 3, 5).alias("dz"), own(5, 11, 7).alias("dy"), own(3, 5, 9).alias("dx")))

    @cached_property
    def placed(self) -> DataFrame:
        return coords.path_sum(self.row_nodes)
