"""Scans by ranges and medians by selection, on long series, ties and nulls."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tesserae.operators import coords, drift, graph, scan


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Ranges of so little data would be put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def series(spark):
    """One series with most rows, several short ones, nulls among values."""
    rng = random.Random(8)
    rows = [("hot", i, rng.randint(-9, 9)) for i in range(3000)] + [(f"k{i % 7}", i, None if i % 5 == 0 else i) for i in range(60)] + [("one", 0, 4), (None, 1, 5), (None, 2, 6)]
    rng.shuffle(rows)
    return rows


def plain(rows):
    by = {}
    for k, i, v in rows:
        by.setdefault(k, []).append((i, v))
    return {k: sorted(x) for k, x in by.items()}


def test_prefix_sums_over_many_ranges(spark, series):
    df = spark.createDataFrame(series, "k string, i int, v int")
    ranges = scan.ranged(df, "k", ["i"]).where("k = 'hot'").select("__range").distinct().count()
    assert ranges > 1
    got = {(r.k, r.i): r.total for r in scan.prefix_sums(df, "k", ["i"], ["v"], ["total"]).collect()}
    for k, x in plain(series).items():
        total = None
        for i, v in x:
            total = total if v is None else (total or 0) + v
            assert got[k, i] == total
    assert len(got) == len(series)


def test_previous_over_many_ranges(spark, series):
    df = spark.createDataFrame(series, "k string, i int, v int")
    got = {(r.k, r.i): r.before for r in scan.previous(df, "k", ["i"], "v", "before").collect()}
    want = {(k, i): before for k, x in plain(series).items() for (i, _), before in zip(x, [None, *[v for _, v in x]], strict=False)}
    assert got == want


SHAPES = {
    "even": lambda rng, n: [rng.random() for _ in range(n)],
    "wide": lambda rng, n: [10.0 ** rng.uniform(-250, 250) * rng.choice((-1, 1)) for _ in range(n)],
    "tied": lambda rng, n: [float(rng.choice((1, 1, 1, 2, 2, 3))) for _ in range(n)],
    "two": lambda rng, n: [0.0] * (n // 2) + [1.0] * (n - n // 2),
    "same": lambda rng, n: [7.5] * n,
    "ends": lambda rng, n: [0.0] * (n // 2 - 3) + [rng.random() for _ in range(6)] + [1.0] * (n - n // 2 - 3),
    "falling": lambda rng, n: [1 / (i + 1) for i in range(n)],
}


@pytest.mark.parametrize("n", [2000, 2001])
def test_medians_by_selection(spark, n):
    rng = random.Random(n)
    rows = [(name, x) for name, make in SHAPES.items() for x in make(rng, n)] + [("short", 1.0), ("short", 2.0), ("none", None), (None, 3.0)]
    want = {name: statistics.median(x for k, x in rows if k == name) for name in (*SHAPES, "short")}
    got = {r.k: r.med for r in scan.medians(spark.createDataFrame(rows, "k string, v double"), "k", "v", short=40).collect()}
    assert got == want


def test_no_task_sorts_more_than_a_short_series(spark, monkeypatch):
    """What is gathered into lists is bounded, however long the series is."""
    real = F.sort_array
    monkeypatch.setattr(scan.F, "sort_array", lambda c: real(F.when(F.size(c) > 50, F.raise_error(F.lit("too long")).cast("array<double>")).otherwise(c)))
    rows = spark.range(50_000).select(F.lit("hot").alias("k"), (F.xxhash64("id") % 100_000).cast("double").alias("v"))
    got = scan.medians(rows, "k", "v", short=50).first().med
    monkeypatch.undo()
    seen = sorted(r.v for r in rows.collect())
    assert got == (seen[24_999] + seen[25_000]) / 2


def test_outliers_use_the_exact_median(spark):
    rows = [("a", float(i % 11)) for i in range(500)] + [("a", 18.0), ("a", 14.0)]
    got = drift.outliers(spark.createDataFrame(rows, "k string, m double"), "k", "m").collect()
    assert [(r.k, r.m, r.med) for r in got] == [("a", 18.0, 5.0)]


def test_runs_with_gaps_and_changes(spark):
    rows = [(0, "x"), (1, "x"), (2, ""), (3, ""), (5, ""), (6, "y"), (7, "x"), (9, "x"), (10, "x")]
    got = sorted(tuple(r) for r in graph.topology_runs(spark.createDataFrame(rows, "t int, sig string")).collect())
    assert got == [(0, 1, 2), (2, 3, 2), (5, 5, 1), (6, 6, 1), (7, 7, 1), (9, 10, 2)]


def test_segments_of_boxes_that_leave_the_region(spark):
    from tesserae.functions import kernels

    boxes = {"a": (-3, 4), "b": (2, 90), "c": (5, 5), "d": (70, 80), "e": (0, 64)}
    df = spark.createDataFrame([(1, n, *z) for n, z in boxes.items()], "t int, name string, z_lo int, z_hi int")
    got = sorted((r.za, r.zb, r.tiles) for r in coords.z_segments(df, 64).collect())
    want = [(a, b, ",".join(names)) for a, b, names in kernels.segments({n: ((lo,), (hi,)) for n, (lo, hi) in boxes.items()}, 64)]
    merged = []  # an empty box marks a plane, which changes nothing
    for a, b, names in got:
        if merged and merged[-1][2] == names:
            merged[-1] = (merged[-1][0], b, names)
        else:
            merged.append((a, b, names))
    assert merged == want
