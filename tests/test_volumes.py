"""The volume source: what is pushed into it, how it is cut into tasks, what it reads."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators.canvas import whole_groups
from tesserae.sources import volumes

SHAPE = (2, 3, 4)


@pytest.fixture
def stacks(spark, tmp_path):
    """Three stacks of four timepoints and three positions; one volume of the last was never taken."""
    volumes.register(spark)
    rng = np.random.default_rng(0)
    held = {(f, t, p): rng.integers(0, 60_000, SHAPE).astype(np.uint16) for f in "abc" for t in range(4) for p in range(3)}
    del held["c", 1, 2]
    rows = [(f, p, t, bytearray(v.tobytes())) for (f, t, p), v in held.items()]
    df = spark.createDataFrame(rows, "file string, pos int, local_t int, data binary")
    assert {(r.file, r.n_volumes) for r in volumes.write_stacks(df, str(tmp_path), 3, SHAPE).collect()} == {("a", 12), ("b", 12), ("c", 11)}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "a.json", "b", "b.json", "c", "c.json"]
    return tmp_path, {(f"{tmp_path}/{f}", t, p): v for (f, t, p), v in held.items()}


def scan(spark, path, **options):
    return spark.read.format("volumes").options(**options).load(str(path))


def found(df):
    return {(r.file, r.local_t, r.pos): np.frombuffer(r.data, r.stored).reshape(r.shape) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys() and all((got[k] == want[k]).all() for k in want)


def test_all_volumes_of_a_folder_and_of_named_stacks(spark, stacks):
    folder, held = stacks
    same(found(scan(spark, folder)), held)
    same(found(scan(spark, f"file://{folder}/a,file://{folder}/b").withColumn("file", F.regexp_replace("file", "^file://", ""))), {k: v for k, v in held.items() if k[0][-1] in "ab"})
    same({k: v[:1] for k, v in held.items()}, found(scan(spark, folder, nz=1)))


CASES = [
    ("pos = 1", lambda f, t, p: p == 1, 12),
    ("local_t >= 2 and pos in (0, 2)", lambda f, t, p: t >= 2 and p != 1, 12),
    ("local_t > 0 and local_t < 3 and pos <=> 2", lambda f, t, p: 0 < t < 3 and p == 2, 6),
    ("local_t <= 0", lambda f, t, p: t == 0, 9),
    ("pos = 7", lambda f, t, p: False, 0),
    ("pos + local_t = 3", lambda f, t, p: p + t == 3, 36),
    ("pos = 1 or local_t = 1", lambda f, t, p: p == 1 or t == 1, 36),
]


@pytest.mark.parametrize("where,keep,n_read", CASES, ids=[c[0] for c in CASES])
def test_filters_are_worked_out_before_reading(spark, stacks, where, keep, n_read):
    """One volume a task: as many tasks as volumes that the pushed part of the filter leaves."""
    folder, held = stacks
    df = scan(spark, folder, partition_bytes=48).where(where)
    same(found(df), {k: v for k, v in held.items() if keep(*k)})
    assert df.rdd.getNumPartitions() == max(n_read, 1)


def test_names_are_pushed_and_the_plan_says_so(spark, stacks, capsys):
    folder, held = stacks
    df = scan(spark, folder, partition_bytes=48).where((F.col("file") == f"{folder}/b") & (F.col("pos") == 1) & (F.size("shape") == 3))
    same(found(df), {k: v for k, v in held.items() if k[0].endswith("/b") and k[2] == 1})
    assert df.rdd.getNumPartitions() == 4
    df.explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(pos,1)" in pushed and "EqualTo(file," in pushed
    (folder / "c.json").write_text("{")  # a stack that does not match is not opened
    assert df.count() == 4 and scan(spark, folder).where(F.col("file").startswith(f"{folder}/a")).count() == 12


def test_volumes_are_packed_into_tasks(spark, stacks):
    folder, held = stacks
    for size, n in ((48, 36), (5 * 48, 8), (13 * 48, 3), (1 << 20, 1)):
        df = scan(spark, folder, partition_bytes=size)
        assert df.rdd.getNumPartitions() == n
        same(found(df), held)


def test_without_data_headers_alone_are_read(spark, stacks):
    folder, held = stacks
    for f in "abc":
        (folder / f).unlink()
    df = spark.read.format("volumes").schema("file string, pos int, local_t int").load(str(folder))
    assert {(r.file, r.local_t, r.pos) for r in df.collect()} == set(held)
    with pytest.raises(Exception, match="no colour"):
        spark.read.format("volumes").schema("file string, colour int").load(str(folder)).collect()


def test_regions_are_read_by_rows(spark, stacks):
    folder, held = stacks
    for (path, t, p), v in held.items():
        assert (volumes.read_region(path, p, t, [(0, 2), (1, 3), (2, 4)]) == v[0:2, 1:3, 2:4]).all()
        assert (volumes.read_volume(path, p, t, 1) == v[:1]).all()
    assert volumes.read_region(f"{folder}/a", 0, 0, [(1, 1), (0, 3), (0, 4)]).shape == (0, 3, 4)


def test_a_stack_that_ends_early_is_an_error(spark, stacks):
    folder, _ = stacks
    data = (folder / "a").read_bytes()
    (folder / "a").write_bytes(data[:-1])
    with pytest.raises(Exception, match="ends inside frame"):
        scan(spark, folder).collect()


def test_writing_again_leaves_the_same_bytes_and_misfits_raise(spark, tmp_path):
    rows = [("x", 0, 0, bytearray(48)), ("x", 1, 2, bytearray(b"\1" * 48))]
    df = spark.createDataFrame(rows, "file string, pos int, local_t int, data binary")
    once = lambda: (volumes.write_stacks(df, str(tmp_path), 2, SHAPE).collect(), {p.name: p.read_bytes() for p in tmp_path.iterdir()})[1]
    first = once()
    assert once() == first and json.loads(first["x.json"])["absent"] == [[0, 1], [1, 0], [1, 1], [2, 0]] and len(first["x"]) == 6 * 48
    for bad in [("y", 5, 0, bytearray(48))], [("y", 0, 0, bytearray(47))]:
        with pytest.raises(Exception, match="no volume of 48 bytes"):
            volumes.write_stacks(spark.createDataFrame(bad, df.schema), str(tmp_path), 2, SHAPE).collect()
    assert not (tmp_path / "y.json").exists()


def test_groups_of_a_stream_are_whole():
    import pandas as pd

    keys = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    for cuts in ([], [1], [2, 3], [4, 5, 6], list(range(1, 10))):
        at = [0, *cuts, len(keys)]
        frames = [pd.DataFrame({"k": keys[a:b], "v": range(a, b)}) for a, b in zip(at, at[1:], strict=False)]
        frames.insert(1, frames[0].iloc[:0])
        assert [g.v.tolist() for g in whole_groups(frames, ["k"])] == [[0, 1], [2], [3, 4, 5, 6], [7], [8, 9]]
    assert list(whole_groups([], ["k"])) == []
