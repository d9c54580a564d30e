"""Extraction, tokens, licences, decontamination, quality and search."""

import random

import numpy as np
import pytest

from tesserae.llm import bpe_automaton, decontaminate, html_extract, kn_quality, license_scan, maxscore, token_counts

JSON = token_counts.default_tokenizer()
ODD = ["", " ", "a<|endoftext|>b <|endoftext|> x <|endoftext", "x" * 3000, " " * 2000 + "a", "\n\n \n x", "I'll 12 é中\U0001f600\x85\x1f\xa0z​"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def texts(n=200):
    rng = random.Random(4)
    return [*ODD, *("".join(rng.choice(" \n\tab'stlldre12é中.,!$_-") for _ in range(rng.randint(1, 400))) for _ in range(n))]


def test_automaton_equals_the_library(library):
    e = bpe_automaton.Encoder(open(JSON, encoding="utf-8").read())
    for t in texts():
        ids = library.encode(t, add_special_tokens=False).ids
        assert e.encode(t) == ids and e.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_and_counts(spark, library):
    import hashlib

    rows = list(enumerate(texts(60))) + [(None, "null id"), (900, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in rows}
    for r in bpe_automaton.round_trip(df, JSON).collect():
        assert r.n_tokens == len(want[r.doc_id]) and r.ids_sha256 == hashlib.sha256(",".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((dict(rows)[r.doc_id] or "").encode()).hexdigest()
    for chunk in (40, 32_768):
        got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, JSON, 100, chunk, 8).collect()}
        assert got == {d: (len((t or "").encode()), len(want[d]), len(want[d]) > 100) for d, t in rows}


def test_overlaps_widen_until_a_stable_place_is_met(library):
    encode = lambda x: library.encode(x, add_special_tokens=False).offsets
    t = "word " * 20 + "y" * 500 + " end of it"
    assert token_counts.count_spliced(t, encode, 64, 8) == len(encode(t))


def page(inner):
    return f"<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/x>News</a></li></ul></nav>{inner}<footer>&copy; 2020</footer></body></html>"


@pytest.mark.parametrize(
    "html, text",
    [
        (page("<article><h1>T &amp; U</h1><p>One  two\nthree</p><p>End.</p></article>"), "T & U\nOne two three\nEnd."),
        (page("<article><p>A b c d</p><div class='ad'>buy</div><p>e f</p><section id=comments><p>nice post here</p></section></article>"), "A b c d\ne f"),
        (page("<div class='cookie-notice'>We use cookies</div><div id=main><h2>Title</h2><p>Some text here</p></div><aside><p>other words</p></aside>"), "Title\nSome text here"),
        ("<script>var a='<p>x</p>'</script><style>p{}</style><p>only &lt;this&gt;", "only <this>"),
        ("plain < text", "plain < text"),
        ("<p>cut <b", "cut"),
        ("<!-- never closed <p>x", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_main_text(html, text):
    assert html_extract.main_text(html) == text


def test_labelled_pages_are_learned():
    held_out = html_extract.labelled_pages(60, seed=99)
    right = sum(html_extract.main_blocks(p) == [b for b in t if b] for p, t in held_out)
    assert right >= 0.9 * len(held_out)


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>a b</p>", 9), (None, None, None, 9)], "page_id long, url string, html string, n_chars int")
    assert [tuple(r) for r in html_extract.extract(df).collect()] == [(1, "u", "a b", 3), (None, None, "", 0)]


def test_license_scan_matches_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(80):
        lines = [" ".join(rng.choices(["the", "mit", "under", "license", "cc", "by", "nc", "é", "apache", "version", "2"], k=rng.randint(0, 9))) for _ in range(3)]
        if i % 4 == 0:
            lines.insert(1, rng.choice(license_scan.TEMPLATES)[0].upper())
        rows.append((i, rng.choice(["\n", " "]).join(lines)))
    rows += [(100, None), (None, "Under the MIT License."), (101, "x " * 500 + license_scan.TEMPLATES[5][0] + " y" * 500)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        w = license_scan.words_of(t or "")
        hits = [(i, label) for p, label in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        r = got[d]
        assert (r.n_words, r.n_base) == (len(w), len(hits))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in hits})) and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        half, shares = license_scan.BLOCK // 2, {}
        for k in range(0, max(len(w) - half, 1), half):  # every block, every template, by the definition
            block = set(w[k : k + license_scan.BLOCK])
            for template, label in license_scan.TEMPLATES:
                words = set(template.split())
                if 100 * len(words & block) >= license_scan.THRESHOLD * len(words):
                    shares[label] = max(shares.get(label, 0), len(words & block) / len(words))
        assert r.labels == ",".join(sorted({x for _, x in hits} | set(shares))), (t, r.labels, shares)
        assert r.score == (1.0 if hits else max(shares.values(), default=0.0))
    assert "gpl-2" in got[101].labels.split(",")


def test_license_scan_with_odd_tables(spark):
    rows = [(1, "Released under the MIT license", "x", 1), (1, "Released under the MIT license", "x", 1), (2, "word " * 300_000 + "cc by nc 4 0 licensed under", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, row int")
    got = sorted((r.doc_id, r.labels, r.n_words) for r in license_scan.scan(df).collect())
    assert [x[:2] for x in got[:2]] == [(1, "mit")] * 2 and got[2][0] == 2 and "cc-by-nc" in got[2][1].split(",") and got[2][2] == 300_007
    assert license_scan.scan(df.limit(0)).collect() == []
    own = license_scan.scan(df, [("word word word", "words"), ("nothing of this", "none")], 60)
    assert {r.doc_id: r.labels for r in own.collect()} == {1: "mit", 2: "cc-by-nc,words"}


QUESTION = "If Anna buys 12 apples at 3 euros each and Anna sells 5 of them to Bob, how much money does Anna have left?"


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, QUESTION), (2, None), (None, "x"), (3, "too short")], "item_id long, text string")
    rows = [
        (1, f"Before it. {QUESTION} And after."),
        (2, QUESTION.replace("Anna", "Marta").replace("Bob", "Tom").replace("12", "40").replace("5", "9")),
        (3, "Nothing of the kind is said in this text, which has only a few common words in it."),
        (4, None),
        (None, QUESTION),
        (5, "too short"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, k int")
    got = {r.doc_id: (r.contaminated, r["items"]) for r in decontaminate.judge(df, bench).collect()}
    assert got == {1: (True, "1"), 2: (True, "1"), 3: (False, ""), 4: (False, ""), None: (True, "1"), 5: (False, "")}
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(df, bench).collect()) == [3, 4, 5]
    none = spark.createDataFrame([], bench.schema)
    assert decontaminate.judge(df, none).where("contaminated").count() == 0 and decontaminate.judge(df.limit(0), bench).count() == 0


def test_slots_must_correspond(spark):
    bench = spark.createDataFrame([(1, "sum of 5 and then of 5 and once of 5 and last of 5 so")], "item_id long, text string")
    same = "sum of 8 and then of 8 and once of 8 and last of 8 so"
    df = spark.createDataFrame([(1, same), (2, same.replace("then of 8", "then of 9").replace("last of 8", "last of 9"))], "doc_id long, text string")
    assert {r.doc_id: r.contaminated for r in decontaminate.judge(df, bench).collect()} == {1: True, 2: False}


def test_quality_separates_held_out_junk(spark):
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(120)]
    good = lambda: " ".join(rng.choices(vocab, k=rng.randint(20, 90)))
    junk = lambda k: (" ".join(w + "!!" for w in good().upper().split()), " | ".join(good().split()), " ".join([rng.choice(vocab)] * 60))[k % 3]
    rows = [(i, good(), "en" if i % 2 else None) for i in range(300)] + [(1000 + i, junk(i), "en") for i in range(45)]
    rows += [(2000, None, "en"), (2001, "", "en"), (2002, "short one", "xx"), (None, good(), "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200)] + [(1000 + i, 0, 0) for i in range(10)] + [(None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kn_quality.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    unseen = [got[i].kept for i in range(200, 300)]
    assert sum(unseen) >= 97 and not any(got[1000 + i].kept for i in range(45))
    assert all(got[i].kept for i in (2000, 2001, 2002, None)) and got[2000].perplexity is None
    left = kn_quality.keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got.values())
    assert kn_quality.classify(docs.limit(0), labels).count() == 0
    assert kn_quality.classify(docs, labels.limit(0)).where("not kept").count() == 0


def test_discounts_and_probabilities_sum_to_one(spark):
    assert kn_quality.discounts(0, 0, 0, 0) == (0.5, 0.5, 0.5)
    rows = [(0, 1, 5), (0, 2, 1), (1, 2, 2), (2, 1, 1), (2, 2, 3), (1, 0, 1), (3, 1, 1), (3, 3, 4), (1, 1, 1), (2, 3, 2)]
    rest, unigram, total, d = kn_quality._model(spark.createDataFrame(rows, "v int, w int, n long"), 4, np.zeros(4, dtype=int))
    assert np.isclose(unigram.sum(), 1)
    for v in range(4):
        mine = {w: n for x, w, n in rows if x == v}
        p = [rest[v] * unigram[w] + (mine[w] - d[0, min(mine[w], 3)]) / total[v] * (w in mine) if w in mine else rest[v] * unigram[w] for w in range(4)]
        assert np.isclose(sum(p), 1)


def test_maxscore_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(700)]
    rows += [(700, rows[3][1]), (701, None), (702, [None] * 12), (703, [float("nan")] * 12), (704, [float("inf")] * 12), (705, [0.5] * 3), (705, [0.5] * 3), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, score int")
    from pyspark.sql import functions as F

    got = sorted(tuple(r) for r in maxscore.top_k(df, F.col("id") % 50 == 0).collect())
    ok = {i: np.pad(np.floor(1024 * np.float32(v).astype(float)).astype(int), (0, 12 - len(v))) for i, v in rows if i is not None and i not in range(701, 705)}
    want = []
    for q in (i for i in ok if i % 50 == 0):
        best = sorted(((-int(ok[q] @ v), i) for i, v in ok.items() if i != q))[:10]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    assert maxscore.top_k(df.limit(0), F.col("id") % 50 == 0).count() == 0
    few = maxscore.top_k(df.where("vec_id < 3"), F.col("id") == 0)
    assert few.count() == 2
