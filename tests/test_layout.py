import pytest
from pyspark.sql import functions as F

from tesserae.operators import canvas, coords, graph, layout, tasks


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def files(spark):
    return table(spark, [(0, 3), (1, 0), (2, 7), (3, 2)], "file_i int, nt int")


def test_ragged_timeline_and_locate(spark, files):
    assert [r.file_start for r in layout.with_file_start(files).orderBy("file_i").collect()] == [0, 3, 3, 10]
    assert layout.timeline(files).count() == 12
    found = layout.locate(files, table(spark, [(0,), (9,), (10,)], "t int")).orderBy("t").collect()
    assert [(r.file_i, r.local_t) for r in found] == [(0, 0), (2, 6), (3, 0)]
    with pytest.raises(Exception, match="out of range"):
        layout.locate(files, table(spark, [(12,)], "t int")).collect()


def test_lifetimes_end_is_exclusive(spark, files):
    pos = table(spark, [("a", 0, 0, None), ("b", 0, 2, 3)], "name string, start_file int, start_t int, end_file int")
    assert {r.name: (r.first_t, r.last_t) for r in layout.lifetimes(pos, files).collect()} == {"a": (0, 12), "b": (2, 10)}


@pytest.mark.parametrize("dx, dy, want", [(55, 0, {("b", "a", 2)}), (0, 55, {("b", "a", 1)}), (-55, 0, {("a", "b", 2)}), (60, 0, set()), (55, 5, set()), (50, 0, set()), (59.9, 4.9, {("b", "a", 2)})])
def test_neighbours_are_strict_and_directed(spark, dx, dy, want):
    points = table(spark, [(0, "a", 0.0, 0.0), (0, "b", float(dx), float(dy)), (1, "a", 0.0, 0.0)], "file_i int, name string, x_um double, y_um double")
    assert {tuple(r) for r in layout.neighbour_pairs(points, 55, 5).collect()} == want
    assert {(b, a, k) for a, b, k in want} == {tuple(r) for r in layout.neighbour_pairs(points, 55, 5, True, True).collect()}


def test_overrides_work_in_three_passes(spark):
    tiles = table(spark, [("a", 0, 3), ("b", 0, 3)], "name string, first_t int, last_t int")
    times = table(spark, [(t, 0) for t in range(3)], "t int, file_i int")
    refs = table(spark, [("a", 0)], "name string, file_i int")
    over = table(spark, [(1, "anchor", "b"), (1, "drop", "a"), (1, "anchor", "a"), (2, "unanchor", "a")], "t int, verb string, name string")
    got = {(r.t, r.name): r.anchor for r in layout.tile_state(tiles, times, refs, over).collect()}
    assert got == {(0, "a"): True, (0, "b"): False, (1, "b"): True, (2, "a"): False, (2, "b"): False}


def test_path_sum_stops_at_missing_offsets_and_parents(spark):
    n = [(0, "a", None, None, 0, 0, 0), (1, "a", 0, "a", 1, 2, 3), (2, "a", 1, "a", 1, 2, 3), (2, "b", 2, "a", 0, 0, 5), (3, "a", 2, "a", None, None, None), (4, "a", 3, "a", 1, 1, 1), (4, "c", 9, "z", 1, 1, 1)]
    nodes = table(spark, [(*x, "drift") for x in n], "t int, name string, pt int, pname string, dz int, dy int, dx int, kind string")
    placed = coords.path_sum(nodes)
    assert {(r.t, r.name): (r.z, r.y, r.x) for r in placed.where("placed").collect()} == {(0, "a"): (0, 0, 0), (1, "a"): (1, 2, 3), (2, "a"): (2, 4, 6), (2, "b"): (2, 4, 11)}
    assert [(r.t, r.name) for r in coords.missing(nodes.where("pt is not null"), placed).collect()] == [(3, "a")]


def test_snap_floors_and_clips(spark):
    box = table(spark, [(0, 5, 40, 7, 600, 13, 20), (1, -7, 4, 0, 1, 0, 1)], "t int, z_lo int, z_hi int, y_lo int, y_hi int, x_lo int, x_hi int")
    shape = table(spark, [(64, 1024, 1024)], "nz int, ny int, nx int")
    got = {r.t: tuple(r)[1:] for r in coords.snap_to_chunks(box, (32, 512, 512), shape).collect()}
    assert got[0] == (0, 64, 0, 1024, 0, 512) and got[1][0] == -32


def test_ranges_and_runs(spark):
    df = table(spark, [("k", t) for t in (1, 2, 3, 7, 9, 10)], "k string, t int")
    assert graph.ranges(df, "k").first().ts == "1-3, 7, 9-10"
    signed = table(spark, [(0, "x"), (1, "x"), (2, "y"), (4, "y")], "t int, sig string")
    assert sorted((r.first_t, r.last_t) for r in graph.topology_runs(signed).collect()) == [(0, 1), (2, 2), (4, 4)]


def test_ramp_and_average(spark):
    assert [round(x, 4) for x in spark.range(1).select(canvas.ramp(F.lit(3)).alias("r")).first().r] == [0.01, 0.5, 0.99]
    s = table(spark, [(0, 1.0, 100.0), (0, 3.0, 200.0), (1, 0.0, 9.0)], "k int, w double, v double")
    assert {r.k: round(r.value, 6) for r in canvas.weighted_average(s, ["k"]).collect()} == {0: 175.0, 1: 0.0}


def test_keys_match_python(spark):
    import hashlib
    import json

    got = spark.range(1).select(tasks.file_key(F.lit("a/b.nd2"), F.lit(10), F.lit(20)).alias("k")).first().k
    text = json.dumps({"path": "a/b.nd2", "size": 10, "mtime": 20}, sort_keys=True, separators=(",", ":"))
    assert got == hashlib.sha256(text.encode()).hexdigest()[:16]
    assert tasks.crop_json((0, 4), (None, None), (1, 3), 2) == "[[0,4],[null,null],[null,null]]"


def test_last_wins(spark):
    log = table(spark, [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "key string, seq int, v string")
    assert {r.key: r.v for r in tasks.last_wins(log, "key", ["seq"]).collect()} == {"a": "z", "b": "q"}
