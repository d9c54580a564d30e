"""Large finite vectors take part in the search, infinite ones do not and stop nothing."""

import numpy as np
from pyspark.sql import functions as F

from tesserae.llm import maxscore


def test_large_vectors_are_scored_exactly_and_infinite_ones_left_out(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * (1e6 if i % 9 == 0 else 3e30 if i % 25 == 0 else 1)]) for i in range(120)]
    df = spark.createDataFrame([*rows, (900, [float("-inf")] * 6), (910, [1.0, float("inf")]), (901, [float("nan")])], "vec_id long, embedding array<float>")
    q = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    want = []
    for a in (i for i in q if i % 10 == 0):
        best = sorted((-sum(x * y for x, y in zip(q[a], q[b], strict=True)), b) for b in q if b != a)[:10]
        want += [(a, k, b, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for k, (s, b) in enumerate(best, 1)]
    got = maxscore.top_k(df, F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_wide_vectors_of_large_components_keep_their_order(spark):
    """1,024 dimensions of 2**27: sums of products leave a long."""
    rng = np.random.default_rng(4)
    big = float(1 << 17)  # 2**27 after scaling
    rows = [(i, [big * float(x) for x in rng.choice([-1.0, 1.0], 1024)]) for i in range(40)] + [(100, [big] * 1024), (101, [big] * 1024), (102, [big] * 1023 + [big / 2])]
    got = maxscore.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") == 100).orderBy("rank").collect()
    q = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    best = sorted((-sum(x * y for x, y in zip(q[100], q[b], strict=True)), b) for b in q if b != 100)[:10]
    assert [r.vec_id for r in got] == [b for _, b in best] and [r.vec_id for r in got[:2]] == [101, 102]


def test_the_bound_of_components_falls_with_the_dimensions():
    for dims in (1, 64, 256, 1024, 1 << 20):
        assert 3 * dims * maxscore.largest(dims) ** 2 < 1 << 63
