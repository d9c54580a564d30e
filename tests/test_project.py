"""End to end on two small files: four timepoints each, two neighbours, known drifts."""

import json

import numpy as np
import pandas as pd
import pytest
import yaml

from tesserae import cli
from tesserae.plans.project import MissingOffsets, Project
from tesserae.sources import headers, store

NT, NZ, N, STEP = 4, 4, 24, 16
DRIFT = [(0, 1, -1), (1, 0, 1), (0, -1, 0), (0, 0, 1), (0, 1, 0), (0, 0, -1), (1, 0, 0)]


@pytest.fixture
def scene(tmp_path):
    rng = np.random.default_rng(1)
    big = rng.integers(1, 4000, (NZ, N, N + STEP)).astype(np.uint16)
    t = 0
    for f in ("a.raw", "b.raw"):
        frames = []
        for _ in range(NT):
            if t:
                big = np.roll(big, DRIFT[t - 1], axis=(0, 1, 2))
            frames += [big[:, :, :N], big[:, :, STEP:]]
            t += 1
        np.concatenate(frames).tofile(tmp_path / f)
        (tmp_path / f"{f}.json").write_text(json.dumps({"nt": NT, "nz": NZ, "ny": N, "nx": N, "dtype": "uint16", "voxel_x_um": 1.0, "position_names": ["left", "right"], "stage_um": [[STEP, 0], [0, 0]]}))
    cfg = {"files": ["a.raw", "b.raw"], "grid_spacing": STEP, "grid_spacing_error": 2, "positions": {"left": {"start": [0, 0], "reference_in_files": [0, 1]}, "right": {"start": [0, 0]}}}
    (tmp_path / "run.yaml").write_text(yaml.safe_dump(cfg))
    return tmp_path / "run.yaml"


def test_plan_compute_resume_and_blend(spark, scene, capsys):
    p = Project(spark, scene)
    assert p.plan.groupBy("kind").count().toPandas().set_index("kind")["count"].to_dict() == {"pair": 8, "time": 7}
    with pytest.raises(MissingOffsets):
        p.coordinates()
    assert p.compute(limit=5) == 5 and p.compute() == 10 and p.compute() == 0
    got = p.plan.join(p.offsets().select("key", "dz", "dy", "dx"), "key").where("kind = 'time'").orderBy("t").collect()
    assert [(r.dz, r.dy, r.dx) for r in got] == [tuple(-x for x in d) for d in DRIFT]
    pairs = p.plan.join(p.offsets().select("key", "dz", "dy", "dx"), "key").where("kind = 'pair'").collect()
    assert {(r.a, r.b, r.axis, r.dz, r.dy, r.dx) for r in pairs} == {("left", "right", 2, 0, 0, STEP)}

    placed = p.coordinates().toPandas().set_index(["t", "name"])
    walked = np.cumsum([(0, 0, 0), *(tuple(-x for x in d) for d in DRIFT)], axis=0)
    for t in range(8):
        assert placed.loc[(t, "left")][["z", "y", "x"]].astype(int).tolist() == walked[t].tolist()
        assert (placed.loc[(t, "right")].x - placed.loc[(t, "left")].x) == STEP

    args = ["blend", str(scene), "--chunk", "4", "16", "16"]
    assert cli.main(args, spark) == 0 and "8 timepoints" in capsys.readouterr().out
    assert cli.main(args, spark) == 0 and "0 timepoints" in capsys.readouterr().out
    chunks = pd.read_parquet(p.work.canvas)
    g = store.load_geometry(p.work.canvas)
    canvas = np.zeros(g["shape"], np.uint16)
    for r in chunks.itertuples():
        at = [r.cz * 4, r.cy * 16, r.cx * 16]
        block = np.frombuffer(r.data, np.uint16).reshape(r.shape)
        canvas[(int(r.t), *(slice(a, a + n) for a, n in zip(at, block.shape, strict=True)))] = block
    first = np.fromfile(scene.parent / "a.raw", np.uint16).reshape(NT, 2, NZ, N, N)[0]
    o = [int(-v) for v in g["origin"]]
    inner = canvas[0, o[0] : o[0] + NZ, o[1] : o[1] + N, o[2] : o[2] + STEP]
    assert np.abs(inner.astype(int) - first[0][:, :, :STEP]).max() <= 1  # truncation may lose one count
    with pytest.raises(store.CanvasMismatch):
        p.blend(dtype="float32")


def test_commands(spark, scene, capsys):
    run = lambda *a: cli.main([a[0], str(scene), *a[1:]], spark)
    assert run("validate", "--deep") == 0 and run("timeline", "--at", "5") == 0
    assert "left*" in capsys.readouterr().out
    assert run("graph", "--strict") == 0 and ". right: x neighbour of left" in capsys.readouterr().out
    assert run("offsets", "--dry-run") == 0 and "15 tasks" in capsys.readouterr().out
    assert run("drift", "--tile", "left") == 1
    assert run("offsets", "--between", "0", "4") == 0
    assert run("status") == 0 and "3 of 7 cached" in capsys.readouterr().out
    assert run("show", "--at", "5") == 0 and "(not computed)" in capsys.readouterr().out
    assert run("inspect", "--at", "1") == 0 and run("drift", "--tile", "left", "--between", "0", "4") == 0
    out = scene.parent / "run"
    assert (out / "inspect/left_right_t1/response.npy").exists() and (out / "drift/left/offsets.csv").exists()
    assert run("graph", "--between", "5", "3") == 1


def test_keys_change_with_crops_but_not_with_names(spark, scene):
    keys = lambda: {r.key for r in Project(spark, scene).plan.select("key").collect()}
    before = keys()
    text = scene.read_text()
    scene.write_text(text.replace("right:", "other:\n    aliases: [right]"))
    assert keys() == before
    scene.write_text(text + "slices: {z: [0, 2]}\n")
    assert not keys() & before


def test_header_cache_is_keyed_by_stamps(scene):
    paths, cache = [str(scene.parent / "a.raw")], scene.parent / "c.json"
    first = headers.load_headers(paths, cache)
    assert headers.load_headers(paths, cache, read=None) == first
    cache.write_text("{")
    with pytest.warns(RuntimeWarning):
        assert headers.load_headers(paths, cache) == first
    with open(paths[0], "ab") as f:
        f.write(b"x")
    with pytest.raises(TypeError):
        headers.load_headers(paths, cache, read=None)


def test_log_is_tolerant_and_last_wins(spark, tmp_path):
    log = tmp_path / "offsets.jsonl"
    line = lambda k, z: json.dumps({"key": k, "kind": "time", "task": {"kind": "time", "what": "w"}, "offset": {"dz": z, "dy": 0, "dx": 0}})
    log.write_text("\n".join([line("a", 1), line("b", 2), line("a", 3)]) + '\n{"key": "c", "ki')
    with pytest.warns(RuntimeWarning):
        got = {r.key: r.dz for r in store.read_offsets(spark, log).collect()}
    assert got == {"a": 3, "b": 2}
    with pytest.warns(RuntimeWarning):
        assert store.compact(spark, log) == (4, 2)
    assert {r.key: r.dz for r in store.read_offsets(spark, log).collect()} == got
    assert store.read_offsets(spark, tmp_path / "none").count() == 0


def test_geometry_is_strict(tmp_path):
    assert store.load_geometry(tmp_path / "c") is None
    store.geometry_path(tmp_path / "c").write_text("{}")
    with pytest.raises(store.CanvasMismatch):
        store.load_geometry(tmp_path / "c")


def test_a_crash_costs_one_timepoint(spark, scene, monkeypatch):
    from tesserae.operators import canvas

    p = Project(spark, scene)
    p.compute()
    real, calls = canvas.write_chunks, []

    def breaks(chunks, path):
        calls.append(path)
        if len(calls) == 4:
            raise OSError("full")
        real(chunks, path)

    monkeypatch.setattr(canvas, "write_chunks", breaks)
    with pytest.raises(OSError):
        p.blend(chunk=(4, 16, 16), attempts=1)
    assert store.read_blend_log(spark, f"{p.work.canvas}.log.jsonl").count() == 3
    assert p.blend(chunk=(4, 16, 16)) == 5 and len(p.timings) == 5 and p.blend(chunk=(4, 16, 16)) == 0


def test_patience(monkeypatch):
    waits, left = [], [OSError("a"), OSError("b")]
    monkeypatch.setattr(store.time, "sleep", waits.append)

    def work():
        if left:
            raise left.pop()
        return 7

    with pytest.warns(RuntimeWarning):
        assert store.patiently(work, 3, 2.0) == 7
    assert waits == [2.0, 4.0]
    left.append(store.CanvasMismatch("never again"))
    with pytest.raises(store.CanvasMismatch):
        store.patiently(work)
    left.append(OSError("c"))
    with pytest.raises(OSError):
        store.patiently(work, 1)


def test_a_position_outside_the_files_raises(spark):
    from tesserae.operators import layout

    files = spark.createDataFrame([(0, 3), (1, 2)], "file_i int, nt int")
    at = lambda start, end: layout.lifetimes(spark.createDataFrame([("x", start, 1, end)], "name string, start_file int, start_t int, end_file int"), files).collect()
    assert [tuple(r) for r in at(1, None)] == [("x", 4, 5)] and [tuple(r) for r in at(0, 1)] == [("x", 1, 3)]
    for bad in ((2, None), (0, 4)):
        with pytest.raises(Exception, match="outside the files"):
            at(*bad)


@pytest.mark.parametrize("path", ["a b.nd2", 'q"u\\o.nd2', "é/ü\n.raw", "😀.raw", "\x01\t\x7f"])
def test_file_keys_are_those_of_the_json_text(spark, path):
    from pyspark.sql import functions as F

    from tesserae.operators import tasks

    row = spark.createDataFrame([(path,)], "path string").select(tasks.file_key(F.col("path"), F.lit(5), F.lit(6))).first()
    assert row[0] == headers.Stamp(path, 5, 6).key
