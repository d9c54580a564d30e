"""What op9 sends goes by the texts and the model, not by the number of partitions."""

import random

import numpy as np
import pytest

from tesserae.llm import kn_quality as kn

U = np.uint64


def corpus(spark, n=400):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 5))) for _ in range(150)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=rng.randint(20, 60))), "en" if i % 3 else "de") for i in range(n)], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, 1, 0) for i in range(n - 50)], "doc_id long, quality int, toxic int")


def scores(docs, labels):
    return {r.doc_id: (r.perplexity, r.threshold, r.kept) for r in kn.classify(docs, labels).collect()}


def test_many_partitions_send_no_more_copies_and_sums(spark):
    docs, labels = corpus(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def sent(partitions: int) -> int:
        """Rows of the sums of log-probabilities: one for each batch and shard."""
        rows, real = [], type(docs).repartition
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))

        def counted(df, *by):
            if "logp" in df.columns:
                rows.append(df.count())
            return real(df, *by)

        with pytest.MonkeyPatch.context() as m:
            m.setattr(type(docs), "repartition", counted)
            kn.classify(docs, labels)
        assert len(rows) == 1
        return rows[0]

    try:
        few, many = sent(12), sent(150)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert few and many <= few


def test_shards_go_by_the_bigrams():
    assert kn._shards(10_000_000, 51) == kn._shards(10_000_000, 3000) == kn.LEAST_SHARDS
    assert kn._shards(100 * kn.SHARD_PAIRS, 3000) == kn._shards(100 * kn.SHARD_PAIRS, 4) == 100
    assert kn._shards(0, 4) == 4


def test_more_shards_than_partitions_and_groups_of_batches_give_the_same(spark, monkeypatch):
    docs, labels = corpus(spark)
    want = scores(docs, labels)
    monkeypatch.setattr(kn, "SHARD_PAIRS", 1000)
    monkeypatch.setattr(kn, "input_bytes", lambda df: 3 * 1 << 40)
    monkeypatch.setattr(kn, "GROUP_BYTES", (1 << 40) // 10)
    groups, real = [], kn._by_range
    monkeypatch.setattr(kn, "_by_range", lambda bounds, n: groups.append((len(bounds) + 1, n)) or real(bounds, n))
    got = scores(docs, labels)
    assert groups[0][0] > 4 and groups[0][1] > 1
    assert {k: v[2] for k, v in got.items()} == {k: v[2] for k, v in want.items()}
    for k, (perplexity, threshold, _) in want.items():
        assert got[k][:2] == pytest.approx((perplexity, threshold), rel=1e-5)


def test_steps_give_the_bigrams_back():
    rng = np.random.default_rng(5)
    for v, w in ((1, 3), (40, 40), (2**31 - 1, 2**32 - 1)):
        keys = np.unique((rng.integers(0, v, 500).astype(U) << U(32)) | rng.integers(0, w, 500).astype(U))
        assert kn._summed(*kn._steps(keys)).tolist() == keys.tolist()
    assert len(kn._summed(*kn._steps(np.empty(0, U)))) == 0


def test_every_count_goes_to_one_shard_and_requests_meet_it():
    keys = np.sort(np.random.default_rng(6).choice(10_000, 900, replace=False)).astype(U) << U(20)
    bounds = keys[[200, 200, 600]]
    parts = [(shard, keys[a:b].tolist()) for shard, a, b in kn._ranges(keys, bounds)]
    assert [x for _, part in parts for x in part] == keys.tolist() and [shard for shard, _ in parts] == [0, 2, 3]
    for shard, a, b in kn._ranges(keys[::7], bounds):
        assert set(keys[::7][a:b].tolist()) <= set(dict(parts)[shard])
