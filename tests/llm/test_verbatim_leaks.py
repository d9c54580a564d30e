"""Verbatim copies of benchmark items are found whatever they are made of."""

from tesserae.llm import decontaminate

ITEMS = [
    (1, "In 1912 Tom Smith paid 35 dollars to Ann Lee for 4 kg"),
    (2, "一列火车以每小时六十公里的速度行驶三小时，它走了多远？"),
    (3, "What is 7 x 8?"),
    (4, "Who wrote Hamlet?"),
    (5, "Tom and his old dog ran home"),
    (6, "リンゴが5個あります。"),
]


def test_items_of_slots_short_items_and_unspaced_scripts(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(i, f"Some words, as Before {text} and others after it.") for i, text in ITEMS]
    rows += [(12, f"他说：{ITEMS[1][1]}请回答。"), (16, f"問題。{ITEMS[5][1]}では")]
    clean = [
        (21, "In 1950 Max Jones paid 99 dollars to Eve Ray for 7 kg"),
        (22, "一列火车以每小时六十公里的速度行驶，然后停了下来。"),
        (23, "What is 7 x 9?"),
        (24, "Who wrote to Hamlet?"),
    ]
    got = {r.doc_id: r["items"] for r in decontaminate.judge(spark.createDataFrame(rows + clean, "doc_id long, text string"), bench).collect()}
    assert got == {i: str(i % 10) for i, _ in rows} | {i: "" for i, _ in clean}
