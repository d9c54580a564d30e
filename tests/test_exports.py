"""Exports by Spark's tasks, routes in circles, versions of the streamed table."""

import json

import numpy as np
import pandas as pd
import pytest
from test_project import DRIFT, NT, scene  # noqa: F401

from tesserae import cli
from tesserae.operators import coords
from tesserae.plans.project import Project


def test_drift_exports_equal_arrays_made_whole(spark, scene):  # noqa: F811
    Project(spark, scene).compute()
    run = lambda *a: cli.main(["drift", str(scene), "--tile", "left", *a], spark)
    out = scene.parent / "run/drift/left"
    assert run("--size", "16") == 0 and run("--full", "--out", str(scene.parent / "full")) == 0

    raw = np.concatenate([np.fromfile(scene.parent / f, np.uint16).reshape(NT, 2, 4, 24, 24)[:, 0] for f in ("a.raw", "b.raw")])
    shifts = np.cumsum([(0, 0, 0), *(tuple(-x for x in d) for d in DRIFT)], axis=0)
    low, high = shifts.min(axis=0), shifts.max(axis=0)

    def moved(frames):
        canvas = np.zeros((len(frames), *(np.array(frames[0].shape) + high - low)), np.uint16)
        for c, v, s in zip(canvas, frames, shifts - low, strict=True):
            c[tuple(slice(a, a + n) for a, n in zip(s, v.shape, strict=True))] = v
        return canvas

    crop = raw[:, :, 4:20, 4:20]
    assert (np.load(out / "raw_xy.npy") == crop.max(axis=1)).all()
    assert (np.load(out / "aligned_xy.npy") == moved(crop).max(axis=1)).all() and (np.load(out / "aligned_zx.npy") == moved(crop).max(axis=2)).all()
    table = pd.read_csv(out / "offsets.csv")
    assert table[["cum_z", "cum_y", "cum_x"]].to_numpy().tolist() == shifts[1:].tolist() and json.loads((out / "info.json").read_text()) == {"n": 8, "full": False}
    planes = pd.read_parquet(scene.parent / "full/aligned").sort_values(["t", "z"])
    whole = moved(raw)
    got = np.stack([np.frombuffer(r.data, np.uint16).reshape(r.shape) for r in planes.itertuples()]).reshape(whole.shape)
    assert (got == whole).all()


def test_routes_in_a_circle_raise(spark):
    schema = "t int, name string, pt int, pname string, dz int, dy int, dx int"
    chain = [(0, "a", None, None, None, None, None)] + [(t, "a", t - 1, "a", 1, 0, 2) for t in range(1, 40)]
    placed = {(r.t, r.name): (r.z, r.x) for r in coords.path_sum(spark.createDataFrame(chain, schema)).collect()}
    assert placed[39, "a"] == (39.0, 78.0)
    with pytest.raises(ValueError, match="runs in a circle"):
        coords.path_sum(spark.createDataFrame([*chain, (5, "b", 6, "b", 1, 1, 1), (6, "b", 5, "b", 1, 1, 1)], schema))
    with pytest.raises(ValueError, match="runs in a circle"):
        coords.path_sum(spark.createDataFrame([(5, "b", 5, "b", 1, 1, 1)], schema))


def test_older_versions_of_the_streamed_table_go(spark, tmp_path):
    from tesserae.streaming import log

    src = tmp_path / "log"
    src.mkdir()
    for n in range(4):
        (src / f"{n}.json").write_text("\n".join(json.dumps({"key": k, "kind": "time", "seq": n, "dz": n, "dy": 0, "dx": 0}) for k in ("a", f"k{n}")))
        log.keep_last(log.read(spark, str(src)), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["2", "3"]
    assert {r.key: r.dz for r in spark.read.parquet(str(tmp_path / "t/3")).collect()} == {"a": 3, "k0": 0, "k1": 1, "k2": 2, "k3": 3}
