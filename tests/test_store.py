"""Logs and canvases when something breaks off."""

import json
import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pandas as pd
import pytest
from test_project import scene  # noqa: F401

from tesserae.operators import canvas
from tesserae.plans.project import Project
from tesserae.sources import files, store

ROOT = Path(__file__).resolve().parents[1]


def rows(spark, n, z=0, first=0):
    return spark.createDataFrame([(f"k{i}", "time", f"w{i}", z, i, -i) for i in range(first, n)], store.OFFSETS)


def lines(path):
    return [line for f in sorted(Path(f"{path}.parts").glob("part-*")) for line in f.read_text().splitlines()]


def test_a_killed_task_leaves_neither_torn_nor_double_lines(tmp_path):
    """A worker dies in the middle of its rows, at the first attempt; the others go on."""
    code = f"""
        import os, sys
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from tesserae.sources import store
        spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}/ck").getOrCreate()
        def run(it):
            for pdf in it:
                yield pdf.assign(kind="time", what="w", dz=1, dy=2, dx=3)[["key", "kind", "what", "dz", "dy", "dx"]]
                if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
                    os._exit(1)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
        found = spark.range(0, 400, 1, 4).selectExpr("cast(id as string) as key").mapInPandas(run, store.OFFSETS)
        assert store.append_offsets(found, "{tmp_path}/log.jsonl") == 400
        assert store.read_offsets(spark, "{tmp_path}/log.jsonl").count() == 400
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, env=os.environ | {"PYTHONPATH": str(ROOT)}, check=True, capture_output=True)
    keys = [json.loads(x)["key"] for x in lines(tmp_path / "log.jsonl")]
    assert sorted(keys, key=int) == [str(i) for i in range(400)]


def test_a_failed_append_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    log = tmp_path / "log.jsonl"
    store.append_offsets(rows(spark, 3), log)
    bad = rows(spark, 100, 9).repartition(4).withColumn("dz", F.when(F.col("dy") == 77, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("dz")))
    with pytest.raises(Exception, match="no"):
        store.append_offsets(bad, log)
    assert len(lines(log)) == 3 and {r.dz for r in store.read_offsets(spark, log).collect()} == {0}


def test_later_appends_win_over_earlier_ones_and_over_the_file(spark, tmp_path):
    log = tmp_path / "log.jsonl"
    old = {"key": "k1", "kind": "time", "task": {"kind": "time", "what": "old"}, "offset": {"dz": 50, "dy": 0, "dx": 0}}
    log.write_text(json.dumps(old) + "\n" + json.dumps(old | {"key": "file only"}) + '\n{"key": "to')
    for z in (1, 2, 3):
        store.append_offsets(rows(spark, 4, z, first=z - 1), log)
    with pytest.warns(RuntimeWarning, match="1 unreadable"):
        got = {r.key: (r.dz, r.what) for r in store.read_offsets(spark, log).collect()}
    assert got == {"k0": (1, "w0"), "k1": (2, "w1"), "k2": (3, "w2"), "k3": (3, "w3"), "file only": (50, "old")}


def test_compaction_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    log = tmp_path / "log.jsonl"
    for z in (1, 2):
        store.append_offsets(rows(spark, 5, z), log)
    say = lambda: sorted(map(tuple, store.read_offsets(spark, log).collect()))
    before, real, calls = say(), files.remove, []

    def breaks(path):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("gone")
        real(path)

    monkeypatch.setattr(store.files, "remove", breaks)
    with pytest.raises(OSError):
        store.compact(spark, log)
    monkeypatch.undo()
    assert say() == before
    n, after = store.compact(spark, log)
    assert n > after == 5 and say() == before and len(lines(log)) == 5
    assert store.compact(spark, log) == (5, 5) and store.compact(spark, tmp_path / "none") == (0, 0)


def voxels(path):
    found = pd.read_parquet(path)
    assert not found.duplicated(["t", "cz", "cy", "cx"]).any()
    return {(int(r.t), r.cz, r.cy, r.cx): (tuple(r.shape), r.data) for r in found.itertuples()}


def test_all_timepoints_in_one_job_that_is_resumed(spark, scene, monkeypatch):  # noqa: F811
    p = Project(spark, scene)
    p.compute()
    small = {"chunk": (4, 16, 16)}
    assert p.blend(scene.parent / "one", at_once=1, **small) == 8 and len(p.timings) == 8
    whole = voxels(scene.parent / "one")
    assert all(r["read_s"] >= 0 and r["compose_s"] > 0 for r in p.timings) and sum(r["chunks"] for r in p.timings) == len(whole)

    out = scene.parent / "all"
    real = canvas.compose_chunks

    def breaks(*args):
        def read(path, pos, t, region):
            import time

            if path.endswith("b.raw") and t == 3:
                time.sleep(3)  # the other tasks end meanwhile
                raise OSError("unreadable")
            return canvas.read_region(path, pos, t, region)

        return real(*args, read)

    monkeypatch.setattr(canvas, "compose_chunks", breaks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with pytest.raises(Exception, match="unreadable"):
            p.blend(out, at_once=0, attempts=1, **small)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    monkeypatch.undo()
    assert store.read_blend_log(spark, f"{out}.log.jsonl").count() == 0
    there = canvas.written(spark, str(out)).count()
    assert 0 < there < len(whole)
    assert p.blend(out, at_once=0, **small) == 8
    assert len(p.timings) == 1 and p.timings[0]["chunks"] == len(whole) - there
    assert voxels(out) == whole and store.read_blend_log(spark, f"{out}.log.jsonl").count() == 8
    assert p.blend(out, at_once=0, **small) == 0

    assert p.blend(out, t0=2, t1=4, at_once=0, force=True, **small) == 2 and p.timings[0]["chunks"] == sum(k[0] in (2, 3) for k in whole)
    assert voxels(out) == whole


def test_frames_of_earlier_coordinates_go(spark, scene):  # noqa: F811
    p = Project(spark, scene)
    p.compute()
    small = {"chunk": (4, 16, 16), "pad": (2, 8, 8), "at_once": 0}
    p.blend(**small)
    before = voxels(p.work.canvas)
    moved = p.plan.where("kind = 'pair' and t = 3").selectExpr("key", "kind", "what", "0 as dz", "4 as dy", "15 as dx")
    store.append_offsets(moved, p.work.offsets)
    p = Project(spark, scene)
    assert p.blend(**small) == 1 and p.timings[0]["t"] == [3]
    after = voxels(p.work.canvas)
    assert {k: v for k, v in before.items() if k[0] != 3} == {k: v for k, v in after.items() if k[0] != 3}
    assert any(before.get(k) != v for k, v in after.items() if k[0] == 3)
    assert len(list(Path(p.work.canvas, "t=3").glob("frame=*"))) == 1


def test_graph_problems_equal_those_of_plain_lists(spark, scene):  # noqa: F811
    from tesserae.operators import validate

    scene.write_text(scene.read_text() + "overrides:\n- {at: 2, drop: [left], anchor: [right]}\n- {at: [5, 6], unanchor: [left], drop: [right], anchor: [left]}\n- {at: 4, drop: [left, right]}\n")
    p = Project.__new__(Project)
    real = validate.validate
    validate.validate = lambda cfg, *a, **k: cfg  # what the overrides break is looked for in the graph
    try:
        p.__init__(spark, scene)
    finally:
        validate.validate = real
    names, anchors, pairs = {}, {}, {}
    for r in p.tops.collect():
        names[r.t], anchors[r.t], pairs[r.t] = list(r.names), set(r.anchors), [tuple(x) for x in r.pairs]
    want = validate.check_graph(p.nt, names, anchors, pairs)
    assert len(want) >= 2 and sorted(p.graph_problems()) == sorted(want)


def test_files_of_any_path(tmp_path):
    for root in (str(tmp_path), f"file://{tmp_path}"):
        place = f"{root}/a/b.txt"
        files.write_text(place, "é")
        files.write_text(place, "è")
        assert files.read_text(place) == "è" and files.names(f"{root}/a") == ["b.txt"] and files.exists(place) and files.is_folder(f"{root}/a")
        files.remove(f"{root}/a")
        files.remove(f"{root}/a")
        assert not files.exists(place) and files.names(f"{root}/a") == []
