import random

import pytest
from test_dedup import brute_near

from tesserae.llm import minhash_dedup as md


@pytest.mark.parametrize("each", [32, 0])  # few near pairs, and too many: on full sets in blocks
def test_lists_longer_than_a_block(spark, monkeypatch, each):
    rng = random.Random(8)
    base = [str(rng.random()) for _ in range(60)]
    rows = [(i, " ".join("z%d" % rng.randrange(50) if rng.random() < 0.04 else w for w in base)) for i in range(90)]
    for name, value in (("BLOCK", 16), ("DENSE_BLOCK", 32), ("NEAR_EACH", each), ("NEAR_MORE", each * 30)):
        monkeypatch.setattr(md, name, value)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_near(rows)
    assert 1 < len({x[2] for x in want.values()}) < 80
    assert {r.doc_id: tuple(r) for r in md.near_duplicates(df).collect()} == want
