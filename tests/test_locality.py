"""Volumes beyond a worker, tasks by neighbourhood, vendor files."""

import json
import sys
import types
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_project import scene  # noqa: F401

from tesserae import cli
from tesserae.functions import kernels
from tesserae.operators import correlate, pencil, tasks
from tesserae.plans.acquisition import Acquisition
from tesserae.sources import volumes

SF = "/root/testdata/sf0.001"


# --- transforms by planes and pencils -----------------------------------------------------------------------------------
def planes(spark, pairs):
    rows = [(key, side, z, p.ravel().tolist()) for key, pair in pairs.items() for side, v in enumerate(pair) for z, p in enumerate(v.astype(float))]
    return spark.createDataFrame(rows, "key string, side int, z int, voxels array<double>")


@pytest.mark.parametrize("shape", [(8, 16, 16), (7, 15, 17), (1, 5, 6), (5, 1, 4), (4, 6, 1)])
@pytest.mark.parametrize("rows", [1, 4, 64])
def test_pencils_equal_the_whole_transform(spark, shape, rows):
    rng = np.random.default_rng(sum(shape) + rows)
    pairs = {}
    for k in range(4):
        a = rng.random(shape)
        pairs[str(k)] = a, np.roll(a, [int(rng.integers(-n // 2 + 1, n // 2 + 1)) for n in shape], axis=(0, 1, 2)) + rng.random(shape) * 0.05
    got = {r.key: (r.dz, r.dy, r.dx) for r in pencil.offsets(planes(spark, pairs), shape, rows).collect()}
    assert got == {k: kernels.translation(*p) for k, p in pairs.items()}


def test_missing_and_odd_planes_raise(spark):
    a = np.random.default_rng(0).random((3, 4, 4))
    df = planes(spark, {"p": (a, a)})
    with pytest.raises(Exception, match="5 planes instead of 6"):
        pencil.offsets(df.where("side = 0 or z > 0"), (3, 4, 4)).collect()
    with pytest.raises(Exception, match="or one twice"):
        pencil.offsets(df.where("side = 0 or z > 0").union(df.where("side = 0 and z = 0")), (3, 4, 4)).collect()
    with pytest.raises(Exception, match="voxels instead of"):
        pencil.offsets(df, (3, 4, 5)).collect()
    assert pencil.offsets(df.limit(0), (3, 4, 4)).collect() == []


# --- tasks by neighbourhood ---------------------------------------------------------------------------------------------
def test_blocks_are_squares_of_the_grid(spark):
    points = spark.createDataFrame([(f"{x}{y}", 10.0 * x - 70 + 0.2, 10.0 * y + 5.0) for x in range(8) for y in range(8)], "name string, x_um double, y_um double")
    got = {r.name: r.block for r in tasks.tile_blocks(points, 10.0, 4).collect()}
    squares = {}
    for name, block in got.items():
        squares.setdefault(block, set()).add((int(name[0]) // 2, int(name[1]) // 2))
    assert len(squares) == 16 and all(len(s) == 1 for s in squares.values()) and set(Counter(got.values()).values()) == {4}


def test_a_volume_is_read_once_in_each_block_that_needs_it(spark, tmp_path):
    """16 tiles on a square, 6 timepoints, 8 blocks of work; all reads are written down."""
    log = tmp_path / "reads"
    log.mkdir()
    grid = [(x, y) for x in range(4) for y in range(4)]
    name = lambda x, y: f"t{x}{y}"
    rows = [(t, "time", name(x, y), None, 0, t - 1, x * 4 + y, t, x * 4 + y) for t in range(1, 6) for x, y in grid]
    rows += [(t, "pair", name(x, y), name(x + dx, y + dy), 2 if dx else 1, t, x * 4 + y, t, (x + dx) * 4 + y + dy) for t in range(6) for x, y in grid for dx, dy in ((0, 1), (1, 0)) if x + dx < 4 and y + dy < 4]
    df = spark.createDataFrame(rows, "t int, kind string, a string, b string, axis int, src_local_t int, src_pos int, dst_local_t int, dst_pos int")
    df = df.withColumns({"src_file": F.lit("f"), "dst_file": F.lit("f"), "realign": F.lit(False), "kind_rank": F.when(F.col("kind") == "time", 0).otherwise(1), "key": F.concat_ws("/", "kind", "t", "a", "b"), "what": F.lit("w")})
    points = spark.createDataFrame([(name(x, y), 10.0 * x, 10.0 * y) for x, y in grid], "name string, x_um double, y_um double")
    blocks = tasks.tile_blocks(points, 10.0, 4)

    def read(path, pos, t, nz):
        import uuid

        (log / f"{pos}-{t}-{uuid.uuid4().hex}").touch()
        return np.random.default_rng(pos * 10 + t).random((2, 4, 4))

    def reads(**more):
        for f in log.iterdir():
            f.unlink()
        full = ((None, None),) * 3
        n = correlate.correlate_stored(df, {"f": "x"}, 2, full, full, 2, read=read, **more).count()
        assert n == len(rows)
        return Counter(f.name.rsplit("-", 1)[0] for f in log.iterdir())

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        want = {f"{r.pos}-{r.local_t}": r.readers for r in tasks.volume_readers(tasks.placed_tasks(df, blocks, 3)).collect()}
        got = reads(blocks=blocks, span=3, keep=24)
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = reads(blocks=blocks, span=100, keep=200)
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        by_tile = reads(span=3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == set(want) and all(got[k] <= want[k] for k in want)  # blocks that share a partition share reads
    inner = [k for k, n in want.items() if n == 1]
    assert len(inner) >= len(want) // 4 and sum(want.values()) <= 2 * len(want)
    assert set(one.values()) == {1} and sum(got.values()) < sum(by_tile.values())


def test_most_volumes_of_a_run_have_few_readers(spark):
    a = Acquisition(spark, SF)
    found = tasks.volume_readers(tasks.placed_tasks(a.plan, tasks.tile_blocks(a.points, 55.0, 4), 8)).agg(F.avg("readers"), F.avg("uses")).first()
    assert found[0] < 1.6 < found[1]


# --- vendor files -------------------------------------------------------------------------------------------------------
class Library(types.ModuleType):
    """Stands in for the vendor's library: two files, one without a time axis."""

    class ND2File:
        open_files = 0

        def __init__(self, path):
            self.timed = "still" not in str(path)
            self.sizes = ({"T": 3} if self.timed else {}) | {"P": 2, "Z": 2, "Y": 3, "X": 4}
            self.dtype = np.dtype("uint16")
            point = lambda n, x: types.SimpleNamespace(name=n, stagePositionUm=types.SimpleNamespace(x=x, y=-x))
            places = types.SimpleNamespace(parameters=types.SimpleNamespace(points=[point("left", 1.5), point("right", 56.5)]))
            self.experiment = [object(), places] if self.timed else [places]
            type(self).open_files += 1

        def voxel_size(self):
            return types.SimpleNamespace(x=0.25)

        def read_frame(self, k):
            if k >= self.sizes.get("T", 1) * 4:
                raise IndexError(k)
            return np.arange(12, dtype=np.uint16).reshape(3, 4) + 100 * k

        def close(self):
            type(self).open_files -= 1

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.close()


@pytest.fixture
def library(monkeypatch):
    monkeypatch.setitem(sys.modules, "nd2", Library("nd2"))
    yield Library
    assert Library.ND2File.open_files == 0


def test_vendor_headers(library, tmp_path):
    from tesserae.sources import headers

    h = headers.read_nd2("run.nd2")
    assert h == headers.Header("run.nd2", 3, 2, 3, 4, ("left", "right"), ((1.5, -1.5), (56.5, -56.5)), 0.25) and h.position_of(["right", "old"]) == 1
    assert headers.read_nd2("still.nd2").nt == 1
    (tmp_path / "a.nd2").write_bytes(b"x")
    assert headers.load_headers([tmp_path / "a.nd2"], tmp_path / "c.json", headers.read_nd2) == headers.load_headers([tmp_path / "a.nd2"], tmp_path / "c.json", None)


def test_vendor_volumes(library, tmp_path):
    frame = lambda k: np.arange(12).reshape(3, 4) + 100 * k
    assert (volumes.read_volume("run.nd2", 1, 2) == np.stack([frame(10), frame(11)])).all()
    assert (volumes.read_volume("still.nd2", 1, 0, 1) == frame(2)[None]).all()
    assert (volumes.read_region("run.nd2", 0, 1, [(1, 2), (1, 3), (0, 2)]) == frame(5)[None, 1:3, 0:2]).all()
    for name in ("a.nd2", "b.nd2"):
        (tmp_path / name).write_bytes(b"x")
    reader = volumes.Reader({"path": str(tmp_path)}, ["file", "pos", "local_t", "shape", "stored", "data"])
    assert list(reader.pushFilters([volumes.EqualTo(("pos",), 1), volumes.GreaterThan(("local_t",), 1)])) == []
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["file"][-5:], r["pos"], r["local_t"], r["shape"]) for r in rows] == [("a.nd2", 1, 2, [2, 3, 4]), ("b.nd2", 1, 2, [2, 3, 4])]
    assert (np.frombuffer(rows[0]["data"], "uint16").reshape(2, 3, 4) == np.stack([frame(10), frame(11)])).all()


# --- options ------------------------------------------------------------------------------------------------------------
def test_options_of_the_commands(spark, scene, capsys):  # noqa: F811
    run = lambda *a: cli.main([a[0], str(scene), *a[1:]], spark)
    assert run("offsets", "--concurrency", "1", "--max-mb", "0.001", "--no-progress") == 0 and "15 tasks" in capsys.readouterr().out
    assert run("blend", "--chunk", "4", "16", "16", "--writers", "1", "--timings", "--no-progress") == 0
    out = capsys.readouterr().out
    assert "8 timepoints" in out and "of reading and" in out and out.count("t=") == 1
    assert run("inspect", "--at", "1", "--pair", "right,left", "--no-response") == 0 and run("inspect", "--at", "1", "--pair", "left", "right", "--no-response") == 0
    assert run("inspect", "--at", "1", "--pair", "left,nowhere") == 1
    err = capsys.readouterr().err
    assert "tiles with neighbours: left, right" in err and "left|right" in err
    info = json.loads((scene.parent / "run/inspect/left_right_t1/info.json").read_text())
    assert info["axis"] == 2
