"""Several shards with a shared threshold give what brute force gives, ties, repeats and large vectors included."""

import random

import pytest
from pyspark.sql import functions as F

from tesserae.llm import maxscore as mx


@pytest.mark.parametrize("low, high", [(-2, 2), (0, 3), (-40, -30)])
def test_shards_equal_brute_force(spark, monkeypatch, low, high):
    monkeypatch.setattr(mx, "SHARD", 60)
    monkeypatch.setattr(mx, "BLOCK", 7)
    rng = random.Random(low)
    rows = [(i, [rng.randint(low, high) / 1024 for _ in range(6)]) for i in range(400)]
    rows += [(400, [200_000.0] * 6), (401, [1e300, 0.0, 0.0, 0.0, 0.0, 0.0]), (402, []), (403, None), (404, [float("nan")] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    import math

    whole = {i: [math.floor(1024 * x) for x in v] + [0] * (6 - len(v)) for i, v in rows if v is not None and i < 404}
    got = {}
    for r in mx.top_k(df, F.col("id") % 10 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == {i for i in whole if i % 10 == 0}
    for q, found in got.items():
        order = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(found) == [(k, i) for k, (_, i) in enumerate(order, 1)], q


def test_a_floor_above_all_ends_at_once():
    import numpy as np

    s = mx.Shard(np.arange(5), np.ones((5, 3)))
    at, score = s.top(-1, np.array([1, 1, 1]), 2, 4)
    assert len(at) == 0 and s.top(-1, np.array([1, 1, 1]), 2, 3)[1].tolist() == [3, 3]


def test_empty_table(spark):
    assert mx.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 2 == 0).collect() == []


def test_sortable():
    rng = random.Random(3)
    xs = [rng.choice((1, -1)) * rng.getrandbits(rng.randint(0, 2100)) for _ in range(500)] + [0, 255, 256, -255, -256]
    assert [x for _, x in sorted((mx._sortable(x), x) for x in xs)] == sorted(xs)


def test_query_blocks_pass_by_a_shard_that_is_made_once(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    made, real = [], mx._Held
    monkeypatch.setattr(mx, "_Held", lambda *a: made.append(1) or real(*a))
    x = rng.integers(-50, 50, (30, 4)).astype(float)
    pack = lambda at, asks, ids, v: {"at": at, "copy": 0, "asks": asks, "ids": np.array(ids, np.int64).tobytes(), "dims": v.shape[1], "values": v.tobytes(), "floors": np.full(len(ids), mx.NO_FLOOR, np.int64).tobytes()}
    rows = [pack(2, True, [100], x[:1])]  # a shard without vectors
    for at, part in ((3, x[:20]), (5, x[20:])):
        rows += [pack(at, False, list(range(at * 100, at * 100 + len(part))), part)] + [pack(at, True, [1000 + i], x[i : i + 1]) for i in range(6)]
    schema = pa.schema([("at", pa.int32()), ("copy", pa.int32()), ("asks", pa.bool_()), ("ids", pa.binary()), ("dims", pa.int32()), ("values", pa.binary()), ("floors", pa.binary())])
    found = [r for b in mx._search(3)(iter([pa.RecordBatch.from_pylist(rows[k : k + 4], schema) for k in range(0, len(rows), 4)])) for r in b.to_pylist()]
    assert len(made) == 2 and len(found) == 2 * 6 * 3
    for r in found:
        at, q = divmod(r["vec_id"], 100)
        assert r["score"] == int(x[r["query_id"] - 1000] @ (x[:20] if at == 3 else x[20:])[q])
