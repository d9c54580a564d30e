"""Perplexities and template runs against plain definitions, the pipeline's stages on odd rows."""

import collections
import math
import random

import pytest

import corpus_pipeline
from tesserae.llm import decontaminate, kn_quality


def shape(w):
    if any(c.isdigit() for c in w):
        return "digit"
    return "upper" if w.isupper() and len(w) > 1 else "capital" if w != w.lower() else "lower"


def plain_model(train, least):
    """P(w | v) of modified Kneser-Ney bigrams by their definition, over words and classes."""
    words = collections.Counter(w for t in train for w in t.split())
    own = {w for w, n in words.items() if n >= least}
    members = collections.Counter(shape(w) for w in words if w not in own)
    vocab = own | {f"<{c}>" for c in kn_quality.CLASSES}

    def ids(text):
        out, run, before = ["<start>"], 0, None
        for w in text.split():
            run, before = (run + 1 if w == before else 0), w
            out.append("<run8>" if run >= 7 else "<run4>" if run >= 3 else "<repeat>" if run >= 1 else w if w in own else f"<{shape(w)}>")
        return out

    pairs = collections.Counter(p for t in train if t.split() for p in zip(ids(t), ids(t)[1:], strict=False))
    of_counts = collections.Counter(pairs.values())
    d = (0, *kn_quality.discounts(*(of_counts[k] for k in (1, 2, 3, 4))))
    total, kinds, seen = collections.Counter(), collections.defaultdict(collections.Counter), collections.Counter()
    for (v, w), n in pairs.items():
        total[v] += n
        kinds[v][min(n, 3)] += 1
        seen[w] += 1
    all_seen = sum(seen.values())
    of_seen = collections.Counter(seen.values())
    e = (0, *kn_quality.discounts(*(of_seen[k] for k in (1, 2, 3, 4))))
    spare = sum(e[min(n, 3)] for n in seen.values())

    def member(w):
        if w in ("<repeat>", "<run4>", "<run8>"):
            return sum(members.values()) + len(own) + 1
        return members[w[1:-1]] + 1 if w not in own else 1

    def p(v, w):
        low = (seen[w] - e[min(seen[w], 3)]) / all_seen + spare / all_seen / len(vocab)
        rest = sum(d[k] * n for k, n in kinds[v].items()) / total[v] if total[v] else 1.0
        high = (pairs[v, w] - d[min(pairs[v, w], 3)]) / total[v] if pairs[v, w] else 0.0
        return (high + rest * low) / member(w)

    def perplexity(text):
        x = ids(text)
        return math.exp(-sum(math.log(p(v, w)) for v, w in zip(x, x[1:], strict=False)) / (len(x) - 1))

    return perplexity


def test_perplexities_equal_the_definition(spark, monkeypatch):
    monkeypatch.setattr(kn_quality, "MIN_COUNT", 3)
    rng = random.Random(6)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 4))) for _ in range(60)] + ["Rome", "NATO", "1914", "x1"]

    def text():
        out = [rng.choice(words) for _ in range(rng.randint(13, 50))]
        if rng.random() < 0.3:
            out[3:3] = [out[2]] * rng.choice((1, 4, 9))
        return " ".join(out)

    rows = [(i, text(), "en") for i in range(120)] + [(1000 + i, f"{text()} never{i} Seen{i} 77{i}", "en") for i in range(20)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, perplexity double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    held = {r[0] for r in docs.select("doc_id").withColumnRenamed("doc_id", "__id").where(kn_quality._held_out()).collect()}
    perplexity = plain_model([t for i, t, _ in rows if i < 100 and i not in held], 3)
    got = {r.doc_id: r for r in kn_quality.classify(docs, labels).collect()}
    for i, t, _ in rows:
        assert got[i].perplexity == pytest.approx(perplexity(t), rel=1e-4), i
    measured = sorted(perplexity(t) for i, t, _ in rows if i in held and i < 100)
    assert got[0].threshold >= measured[-2] * 0.999  # the 0.99 quantile of few


def test_a_very_long_text_and_repeated_rows_have_one_score(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcde", k=3)) for _ in range(50)]
    rows = [(i, " ".join(rng.choices(words, k=40)), "en") for i in range(200)] + [(500, " ".join(rng.choices(words, k=300_000)), "en")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [r for r in kn_quality.classify(docs, spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int")).collect() if r.doc_id == 500]
    assert len(got) == 2 and got[0] == got[1] and got[0].n_tokens == 300_000


def longest_common(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best = max(best, *row)
    return best


def test_runs_of_words_equal_brute_force(spark):
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]
    items = [(i, [rng.choice(words) for _ in range(rng.randint(8, 30))]) for i in range(25)]
    rows = []
    for i in range(120):
        _, item = rng.choice(items)
        a = rng.randint(0, max(0, len(item) - 6))
        part = item[a : a + rng.randint(6, 20)]
        rows.append((i, [rng.choice(words) for _ in range(rng.randint(0, 30))] + part + [rng.choice(words) for _ in range(rng.randint(0, 30))]))
    rows.append((500, [rng.choice(words) for _ in range(60_000)] + items[3][1]))
    docs = spark.createDataFrame([(d, " ".join(t), "c") for d, t in rows], "doc_id long, text string, item string")
    bench = spark.createDataFrame([(d, " ".join(t)) for d, t in items], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.tokens) for r in decontaminate.judge(docs, bench).collect()}
    for d, t in rows[:-1]:
        runs = {i: longest_common(t, item) for i, item in items}
        leaked = {i: n for i, n in runs.items() if n >= max(decontaminate.WINDOW, min(decontaminate.COVER, math.ceil(decontaminate.SHARE * len(dict(items)[i]) / 100)))}
        assert got[d] == (",".join(map(str, sorted(leaked))), max(leaked.values(), default=0)), d
    assert "3" in got[500][0].split(",")


def test_names_of_several_words_stand_for_one(spark):
    bench = spark.createDataFrame([(1, "If Anna Lee buys 12 apples at 3 euros each and sells 5 of them to Bob, how much money does Anna Lee have left?")], "item_id long, text string")
    other = "If Bob buys 40 apples at 7 euros each and sells 9 of them to Maria del Mar, how much money does Bob have left?"
    german = "Wenn Anna zwei Äpfel für 3 Euro kauft und dann Bob trifft, wie viel Geld hat Anna am Ende noch übrig?"
    more = bench.union(spark.createDataFrame([(2, german)], bench.schema))
    df = spark.createDataFrame([(1, "Here it is. " + other), (2, german.replace("zwei", "neun").replace("Anna", "Eva").replace("3 Euro", "8 Euro")), (3, "Nothing of the kind is said here at all, by nobody.")], "doc_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.judge(df, more).collect()}
    assert got == {1: "1", 2: "2", 3: ""}


def test_stages_on_odd_rows(spark, tmp_path):
    """Null and empty texts, null ids, repeated rows, clashing names and empty tables pass through every stage."""
    text = " ".join(f"word{i}" for i in range(70))
    schema = "doc_id long, text string, lang string, source string, n_chars int, token string, kept int, key long"
    rows = [(1, text, "en", "s", len(text), "a", 1, 2), (1, text, "en", "s", len(text), "a", 1, 2), (2, None, None, None, None, None, None, None), (3, "", "en", "s", 0, "", 0, 0), (None, "some text", "xx", None, 9, None, None, None), (4, "other words " * 20, "en", "s", 240, "b", 1, 2)]
    for name, made in (("full", rows), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(made, schema).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        docs = spark.read.parquet(str(folder / "documents.parquet"))
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(folder))
            if k < 4:
                assert out.columns == docs.columns
                assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in made)
