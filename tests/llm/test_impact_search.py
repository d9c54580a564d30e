"""Ranked search against the scores by their definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tesserae.llm import impact_search as s

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain(docs, items, k=20):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counts = [(d, Counter(words(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n, total = len(counts), sum(x for *_, x in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    out = []
    for item, text in items:
        found = []
        for d, c, size in counts:
            m = 100 - 25 + (25 * size * n) // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w, times in Counter(words(text)).items() if w in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r, None if null else d, -x) for r, (x, null, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, **more):
    return sorted(map(tuple, s.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), **more).collect()), key=str)


def corpus(rng, n, words):
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i * 3 - 50, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("k", [1, 5, 20])
def test_scores_and_order(spark, k):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(80)]
    docs = corpus(rng, 700, words)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(12)]
    assert searched(spark, docs, items, k=k) == plain(docs, items, k)


ODD = [(1, None), (2, ""), (3, " .,;"), (4, "Été ÉTÉ été"), (5, "一二 三"), (None, "apple pie"), (6, "apple pie"), (6, "apple pie"), (7, "Apple-pie_apple9"), (8, "k" * 100_000 + " apple"), (9, "apple " * 50_000), (10, "x\x7fy\x00z"), (11, "İI")]


def test_odd_rows(spark):
    items = [(1, "apple"), (1, "apple"), (2, None), (3, "!"), (4, "ÉTÉ Été"), (5, "pie apple apple"), (None, "三"), (6, "nothing here"), (7, "x y z İi")]
    assert searched(spark, ODD, items) == plain(ODD, items)


def test_ties_beyond_k_go_to_smaller_ids(spark):
    docs = [(i, "same words here") for i in range(300)] + [(1000 + i, "other text") for i in range(400)]
    assert searched(spark, docs, [(1, "same here")]) == plain(docs, [(1, "same here")])


def test_empty_tables_and_many_passes(spark, monkeypatch):
    assert searched(spark, [], [(1, "a")]) == [] and searched(spark, ODD, []) == [] and searched(spark, [(1, None)], [(1, "a")]) == []
    monkeypatch.setattr(s, "QUERY_BYTES", 40)
    items = [(i, f"apple pie {i}") for i in range(9)]
    assert searched(spark, ODD, items) == plain(ODD, items)


def test_a_query_stops_early_and_stays_right():
    """One rare term of high impact decides; the common term's groups are not all added up."""
    rng = np.random.default_rng(5)
    n = 20_000
    docs = np.sort(rng.choice(n, 60, replace=False)).astype(np.int32)
    doc = np.concatenate([np.arange(n, dtype=np.int32), docs])
    term = np.concatenate([np.zeros(n, np.int32), np.ones(60, np.int32)])
    tf = rng.integers(1, 9, len(doc))
    order = np.lexsort((term, doc))
    block = s.Block(rng.integers(1, 300, n), term[order], doc[order], tf[order], n, 150 * n)
    weights = np.array([1, 8000], np.int64)
    found, score = block.top(np.array([0, 1]), weights, 20, 0)
    assert block.added < n // 4
    whole = block.complete(np.arange(n), weights)
    assert (score == whole[found]).all()
    assert sorted(-np.sort(-whole)[:20]) == sorted(-np.sort(-score)[:20])
