"""The levels of op3 and the factor arrays of op10 against plain definitions."""

import random

import numpy as np
import pytest

from tesserae.llm import anchors as an
from tesserae.llm import substring_dedup as sd
from tesserae.llm import suffix_dedup as sx


def test_lengths_double():
    assert sd.lengths(50) == [13, 25, 50] and sd.lengths(8) == [8] and sd.lengths(100) == [13, 25, 50, 100]


def test_smaller_neighbours():
    rng = random.Random(2)
    for _ in range(200):
        v = np.array([rng.randint(0, 6) for _ in range(rng.randint(0, 40))], dtype=np.int64)
        before = [max([j for j in range(i) if v[j] < v[i]], default=-1) for i in range(len(v))]
        after = [min([j for j in range(i + 1, len(v)) if v[j] < v[i]], default=-1) for i in range(len(v))]
        assert sx.previous_smaller(v).tolist() == before and sx.next_smaller(v).tolist() == after
    assert sx.previous_smaller(np.arange(100_000)[::-1]).max() == -1


@pytest.mark.parametrize("depth", [5, 8, 13, 50])
def test_longest_previous_factor_equals_brute_force(depth):
    rng = random.Random(depth)
    for _ in range(30):
        texts = ["".join(rng.choice("ab") for _ in range(rng.randint(depth, depth + 40))) for _ in range(5)]
        texts[3] = texts[1][:depth] + "c" + texts[2]
        at, doc, base, every = [], [], 0, []
        for d, t in enumerate(texts):
            for i in range(len(t) - depth + 1):
                at.append(base + i)
                doc.append(9 - d if d % 2 else d)
                every.append(t[i : i + depth])
            base += len(t)

        def common(x, y):
            return next((k for k, (p, q) in enumerate(zip(x, y, strict=True)) if p != q), depth)

        want = [max([common(every[i], every[j]) for j in range(len(at)) if doc[j] < doc[i]], default=0) for i in range(len(at))]
        text = np.frombuffer("".join(texts).encode(), np.uint8)
        assert sx.longest_previous_factor(text, np.array(at), np.array(doc), depth).tolist() == want


def test_only_windows_of_repeated_parts_are_left():
    words = [f"w{i}" for i in range(200)]
    left = np.array([(30, 41)], dtype=an.SPAN).tobytes()  # windows 30 to 70 of 25 words
    got = [(a, b) for a, b, _ in sd._candidates(" ".join(words), 25, 50, [left])]
    assert got == [(30, 46)]
    assert [(a, b) for a, b, _ in sd._candidates(" ".join(words), 25, 50, None)] == [(0, 151)]


def test_nothing_left_ends_the_levels(spark):
    df = spark.createDataFrame([(i, " ".join(f"d{i}x{k}" for k in range(120))) for i in range(6)], "doc_id long, text string")
    out = sd.with_spans(df)
    assert out.where("__spans is not null").isEmpty() and "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.n_removed for r in sd.digest(df).collect()} == {0}


def test_names_in_use_raise(spark):
    df = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, __doc int")
    with pytest.raises(ValueError):
        sd.remove(df)
    clash = spark.createDataFrame([(1, "a b", "x", "y"), (2, None, "x", "y")], "doc_id long, text string, fp string, kind string")
    assert sorted(map(tuple, sd.remove(clash).collect()), key=str) == [(1, "a b", "x", "y"), (2, None, "x", "y")]
