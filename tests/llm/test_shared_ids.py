"""Rows that share an id are one document, whatever the other rows say."""

from tesserae.llm import minhash_dedup as md

TEXT = " ".join(f"w{i}" for i in range(60))


def test_an_empty_row_of_an_id_goes_with_the_others(spark):
    rows = [(1, TEXT, "a"), (5, "", "b"), (5, TEXT, "c"), (6, None, "d"), (7, "", "e"), (7, None, "f"), (None, TEXT, "g"), (9, "x" * 3_000_000, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in md.near_duplicates(df).collect())
    assert got == sorted([("1", 56, "1", True), ("5", 0, "1", False), ("5", 56, "1", False), ("6", 0, "6", True), ("7", 0, "7", True), ("7", 0, "7", True), ("None", 56, "None", True), ("9", 1, "9", True)])
    assert sorted(str(r.doc_id) for r in md.keep_one(df).collect()) == ["1", "6", "7", "7", "9", "None"]


def test_a_very_long_text_has_its_near_copy(spark):
    words = [f"v{i}" for i in range(200_000)]
    other = words[:100_000] + ["changed"] + words[100_000:]
    df = spark.createDataFrame([(3, " ".join(words)), (4, " ".join(other)), (8, "short one")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in md.near_duplicates(df).collect()} == {3: 3, 4: 3, 8: 8}
