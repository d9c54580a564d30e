"""Exact deduplication against a plain definition, and its minimal perfect hash."""

import hashlib
import random
import re

import numpy as np
import pytest

from tesserae.llm import exact_dedup as x

SCHEMA = "doc_id long, text string"


def plain(rows):
    """Sorted rows of the contract."""
    of = {}
    for d, t in rows:
        of.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), d is None, d or 0))
    out = []
    for bare, found in of.items():
        best = min(found)
        left = 1
        for r in sorted(found):
            stays, left = (r == best and left > 0), left - (r == best)
            out.append((None if r[1] else r[2], None if best[1] else best[2], len(found), stays, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


def judged(spark, rows, **more):
    return sorted(map(tuple, x.judge(spark.createDataFrame(rows, SCHEMA), **more).collect()), key=str)


ODD = [(1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, None), (5, ""), (6, " \r\n\x0b\x0c"), (7, "A b"), (None, "a  b  "), (None, "a  b  "), (None, "x"), (8, "x"), (9, "é e"), (10, "ée"), (11, "ab\x85"), (2, "ab"), (12, "𝒜 𝒜"), (13, "𝒜𝒜")]


def test_odd_rows_equal_the_definition(spark):
    assert judged(spark, ODD) == plain(ODD)


@pytest.mark.parametrize("old", ["true", "false", "id % 2 = 0"])
def test_the_history_changes_nothing_in_the_result(spark, old):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab \n") for _ in range(rng.randint(0, 6)))) for i in rng.sample(range(-500, 500), 600)] + ODD
    assert judged(spark, rows, old=F.expr(old)) == plain(rows)


def test_a_hot_text_and_a_very_long_one(spark):
    rows = [(i, "same text") for i in range(2000)] + [(5000 + i, "w " * 300_000 + "x" * (i // 2)) for i in range(4)]
    assert judged(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert judged(spark, []) == []


def test_kept_rows_have_all_columns(spark):
    names = ["doc_id", "text", "digest", "short", "Keep", "row", "n", "id"]
    rows = [(d, t, f"d{i}", i, i, i, i, i) for i, (d, t) in enumerate(ODD)]
    kept = x.keep_one(spark.createDataFrame(rows, "doc_id long, text string, digest string, short int, Keep int, row int, n int, id int"))
    assert kept.columns == names
    found = [tuple(r) for r in kept.collect()]
    assert set(found) <= set(rows)
    want = [(d, h) for d, _, _, stays, h in plain(ODD) if stays]
    assert sorted(((r[0], hashlib.sha256(re.sub(r"[\x20\x09-\x0d]", "", r[1] or "").encode()).hexdigest()) for r in found), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000])
def test_perfect_hash_is_minimal_and_strangers_fail_the_byte_check(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 64, (n, 4), dtype=np.uint64)
    sizes, bits = x.fit(keys)
    at = x.slots(keys, sizes, bits)
    assert sorted(at.tolist()) == list(range(n))
    assert len(bits) * 8 <= 10 * max(n, 64)
    strangers = keys[:1000].copy()
    strangers[:, 3] ^= np.uint64(1)  # the first level sees no difference
    held = np.empty_like(keys)
    held[at] = keys
    theirs = x.slots(strangers, sizes, bits)
    assert not (held[theirs[theirs >= 0]] == strangers[theirs >= 0]).all(axis=1).any()


def test_repeated_digests_are_refused():
    with pytest.raises(ValueError):
        x.fit(np.zeros((2, 4), np.uint64))


def test_an_index_is_read_again_for_later_arrivals(spark, tmp_path):
    part = lambda rows: x.groups(x._rows(spark.createDataFrame(rows, SCHEMA)))
    x.build(part([(5, "a b"), (6, "c")]), 3).rows.write.parquet(str(tmp_path / "index"))
    history = x.History(spark.read.parquet(str(tmp_path / "index")), 3)
    got = {(r.id, r.n, r.known) for r in x.look_up(history, part([(7, "a  b"), (1, "c"), (8, "d"), (9, "d ")])).collect()}
    assert got == {(7, 2, True), (1, 2, True), (9, 2, False)}
