"""What is found of a document goes back as a row, however many partitions its anchors are in."""

import numpy as np
import pytest

from tesserae.llm import anchors as an
from tesserae.llm import substring_dedup, suffix_dedup


@pytest.mark.parametrize("module", [suffix_dedup, substring_dedup])
def test_a_document_is_a_row_of_the_answers(spark, monkeypatch, module):
    # whole copies in other tasks, and texts that share a part each
    texts = {i: " ".join(f"w{i % 10}x{k}" for k in range(400)) for i in range(40)}
    texts |= {100 + i: " ".join(f"s{k}" for k in range(80)) + " " + " ".join(f"y{i}z{k}" for k in range(200)) for i in range(10)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8, "doc_id")
    kept = []
    real = an.durable
    monkeypatch.setattr(an, "durable", lambda df: kept.append(real(df)) or kept[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = {r.doc_id: r.n_removed for r in module.digest(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    covers = kept[-1].where(kept[-1].kind == an.COVER).groupBy("doc").count().collect()
    assert len(covers) >= 30 and max(r["count"] for r in covers) <= 2  # from its chunk, and from all others
    assert all(n == 0 for i, n in found.items() if i < 10) and found[100] == 0
    whole = {i: len(t.split()) if module is substring_dedup else len(t) for i, t in texts.items()}
    assert all(found[i] == whole[i] for i in range(10, 40)) and all(0 < found[i] < whole[i] for i in range(101, 110))


def test_stretches_are_the_union_of_the_windows():
    rng = np.random.default_rng(4)
    doc, fp = rng.integers(-3, 3, 400), rng.integers(0, 2, 400).astype(np.int32)
    at, n = rng.integers(0, 900, 400), rng.integers(1, 9, 400)
    want = {}
    for d, f, a, c in zip(doc.tolist(), fp.tolist(), at.tolist(), n.tolist(), strict=True):
        want.setdefault((d, f), set()).update(range(a, a + c))
    rows = [r for b in an.cover(doc, fp, at, n) for r in b.to_pylist()]
    got = {(r["doc"], r["fp"]): np.frombuffer(r["blob"], an.SPAN) for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys()
    for key, spans in got.items():
        assert [x for s in spans for x in range(s["at"], s["at"] + s["n"])] == sorted(want[key])
        assert (spans["at"][1:].astype(int) > (spans["at"] + spans["n"])[:-1]).all()
