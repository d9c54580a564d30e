"""Deduplication operators against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import collections
import hashlib
import random
import re

import pytest

from tesserae.llm import minhash_dedup, substring_dedup, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=5, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(400)]
    passage = " ".join(rng.choices(vocab, k=70))
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0 or not rows:
            t = " ".join(rng.choices(vocab, k=rng.randint(1, 160)))
        elif kind == 1:
            t = rng.choice(rows)[1]
        elif kind == 2:
            w = rng.choice(rows)[1].split(" ")
            t = " ".join(rng.choice(vocab) if rng.random() < 0.02 else x for x in w)
        elif kind == 3:
            t = " ".join(rng.choices(vocab, k=20)) + "\n" + passage + "\t" + " ".join(rng.choices(vocab, k=9))
        elif kind == 4:
            t = " ".join(rng.choices(vocab[:2], k=120))
        else:
            t = rng.choice(["", " \n ", "one", "a b c", rng.choice(rows)[1].upper()])
        rows.append((i * 3 % 61, t))
    return [*rows, (500, None), (501, "")]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "x", 0) for d, t in ROWS], "doc_id long, text string, doc string, fp int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def brute_words(rows, size=50):
    words, first = {d: WORD.findall(t or "") for d, t in rows}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i : i + size]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d] = (d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def brute_bytes(rows, size=50):
    data, first = {d: (t or "").encode() for d, t in rows}, {}
    for d in sorted(data):
        for i in range(len(data[d]) - size + 1):
            first.setdefault(data[d][i : i + size], d)
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = (d, len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


def brute_near(rows):
    sets = {}
    for d, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    part = {d: d for d in sets}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                part[max(x, y)] = min(x, y)
    return {d: (d, len(s), root(d), root(d) == d) for d, s in sets.items()}


def test_substring_dedup_matches_brute_force(docs):
    want = brute_words(ROWS)
    assert sum(x[2] for x in want.values()) > 500
    assert {r.doc_id: tuple(r) for r in substring_dedup.digest(docs).collect()} == want


def test_suffix_dedup_matches_brute_force(docs):
    assert {r.doc_id: tuple(r) for r in suffix_dedup.digest(docs).collect()} == brute_bytes(ROWS)


def test_suffix_dedup_with_hot_anchors_dealt_by_window(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 1)
    assert {r.doc_id: tuple(r) for r in suffix_dedup.digest(docs).collect()} == brute_bytes(ROWS)


def test_minhash_matches_brute_force(docs):
    want = brute_near(ROWS)
    assert {r.doc_id: tuple(r) for r in minhash_dedup.near_duplicates(docs).collect()} == want
    kept = {r.doc_id for r in minhash_dedup.keep_one(docs).collect()}
    assert kept == {d for d, x in want.items() if x[3]}


def test_minhash_on_one_large_group_of_near_copies(spark, monkeypatch):
    rng = random.Random(2)
    base = [str(rng.random()) for _ in range(60)]
    rows = [(i, " ".join("z%d" % rng.random() if rng.random() < 0.03 else w for w in base)) for i in range(120)]
    want = brute_near(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for each in (32, 0):  # few near pairs, and too many: on full sets in blocks
        monkeypatch.setattr(minhash_dedup, "NEAR_EACH", each)
        monkeypatch.setattr(minhash_dedup, "NEAR_MORE", each * 30)
        monkeypatch.setattr(minhash_dedup, "DENSE_BLOCK", 32)
        assert {r.doc_id: tuple(r) for r in minhash_dedup.near_duplicates(df).collect()} == want


@pytest.mark.parametrize("operator", [substring_dedup.digest, substring_dedup.remove, suffix_dedup.digest, minhash_dedup.near_duplicates, minhash_dedup.keep_one])
def test_empty_tables(empty, operator):
    assert operator(empty).count() == 0


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(None, text), (2, text), (2, text), (2, "other words"), (7, text), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in substring_dedup.digest(df).collect())
    assert got == [(-1, 0), (-1, 0), (2, 0), (2, 0), (2, 0), (7, 80)]
    got = sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup.digest(df).collect())
    assert got == [(-1, 0), (-1, 0), (2, 0), (2, 0), (2, 0), (7, len(text))]
    got = collections.Counter((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(df).collect())
    assert got == {(None, None, True): 2, (2, 2, True): 3, (7, 2, False): 1}


def test_remove_keeps_other_columns_and_untouched_texts(docs):
    out = {r.doc_id: r for r in substring_dedup.remove(docs).collect()}
    assert set(out[0].asDict()) == {"doc_id", "text", "doc", "fp"} and out[500].text is None
    want = brute_words(ROWS)
    for d, t in ROWS:
        if not want[d][2]:
            assert out[d].text == t
        else:
            assert hashlib.sha256(" ".join(WORD.findall(out[d].text)).encode()).hexdigest() == want[d][3]


def test_a_very_long_text_without_spaces(spark):
    df = spark.createDataFrame([(1, "ab" * 600_000), (2, "ab" * 40)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in suffix_dedup.digest(df).collect()} == {1: 0, 2: 80}
    assert {r.doc_id: r.n_words for r in substring_dedup.digest(df).collect()} == {1: 1, 2: 1}
