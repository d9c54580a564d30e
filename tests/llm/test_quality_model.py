"""The quality model has every frequent word, and words it does not know are dear."""

import random

from tesserae.llm import kn_quality


def measured(spark, trusted, others):
    docs = spark.createDataFrame([*((i, t, "en") for i, t in enumerate(trusted)), *((10_000 + i, t, "en") for i, t in enumerate(others))], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(trusted))], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kn_quality.classify(docs, labels).collect()}
    return [got[i].perplexity for i in range(len(trusted))], [got[10_000 + i].perplexity for i in range(len(others))]


def test_words_beyond_the_most_frequent_4000_have_bigrams(spark):
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bcdfghklmn" for b in "aeiouwxyz" for c in "abcdefghijklmnopqrstuvwxyzäöüßéèêëàâîïôûùçñíóúáåæøœãõýþðłśž"][:4500]
    least = rng.sample(words[4000:], 60)
    trusted, (shuffled,) = measured(spark, [" ".join(words + words[:4000])] * 40, [" ".join(least)])
    assert max(trusted) < 2 and shuffled > 100


def test_unknown_words_are_no_cheaper_than_known_ones(spark):
    rng = random.Random(4)
    known = ["".join(rng.choices("abcdefg", k=6)) for _ in range(200)]
    rare = iter(["".join(rng.choices("hijklmn", k=7)) for _ in range(4000)])
    trusted, (same, unseen) = measured(
        spark,
        [" ".join(next(rare) if k % 10 == 5 else rng.choice(known) for k in range(80)) for _ in range(200)],
        [" ".join(rng.choices(known, k=80)), " ".join("".join(rng.choices("opqrst", k=8)) for _ in range(80))],
    )
    assert unseen > 3 * max(same, *trusted)


def test_limits_have_no_multiplier_and_short_or_foreign_texts_have_limits(spark):
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdefg", k=rng.randint(2, 6))) for _ in range(120)]
    good = lambda n: " ".join(rng.choices(vocab, k=n))
    bad = lambda n: " ".join(rng.choice(vocab).upper() + "&&&" for _ in range(n))
    rows = [(i, good(rng.randint(15, 60)), "en") for i in range(500)]
    rows += [(600, good(8), "en"), (601, bad(8), "en"), (602, good(30), "xx"), (603, bad(30), "xx"), (604, good(5), "xx"), (605, bad(8), "xx")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(500)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kn_quality.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels).collect()}
    assert got[0].threshold <= max(got[i].perplexity for i in range(500))
    assert sum(not got[i].kept for i in range(500)) <= 10
    assert [got[i].kept for i in range(600, 606)] == [True, False, True, False, True, False]
