"""The maximum-scoring run decides; names are evidence and delete nothing on their own."""

import time

import pytest

from tesserae.llm import html_extract as h

TEXT = "<h1>Title here</h1><p>This is the article text with a fair number of words in it.</p><p>And more of it.</p>"
WANT = "Title here\nThis is the article text with a fair number of words in it.\nAnd more of it."
LINKS = "<ul><li><a href=/>Home</a></li><li><a href=/x>News</a></li><li><a href=/y>Sports</a></li></ul>"


@pytest.mark.parametrize(
    "body",
    [
        f'<div class="content has-sidebar">{TEXT}</div>',
        f'<div class="no-ads article">{TEXT}</div>',
        f'<article class="post share-enabled">{TEXT}</article>',
        f'<div id="page-with-menu"><article>{TEXT}</article></div>',
        f"<form><nav>{LINKS}</nav><article>{TEXT}</article></form>",
        f"<form><nav>{LINKS}</nav><div>{TEXT}</div></form>",
        f"<div>{LINKS}</div><div>{TEXT}</div><div>{LINKS}</div>",
        f'<div>{TEXT}</div><div class="comments"><article class="comment"><p>{"nice post dear friend " * 60}</p></article></div>',
        f"<main><header><p hidden>x</p></header>{TEXT}<aside>see also</aside></main>",
        f'<article>{TEXT.replace("</p><p>", "</p><div class=ad>buy this now</div><p>")}</article>',
        f'<div style="display:none">{"hidden words " * 300}</div><div>{TEXT}</div>',
    ],
)
def test_layouts(body):
    assert h.main_text(f"<html><body><nav>{LINKS}</nav>{body}<footer>&copy; x</footer></body></html>") == WANT


def test_formulas_stay():
    assert h.main_text("<article><p>Let <math><mi>x</mi><mo>+</mo><mn>1</mn></math> be a number of some kind</p></article>") == "Let x+1 be a number of some kind"


def test_best_run_equals_brute_force():
    import random

    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        a, b = h.best_run(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1))])


def test_the_run_changes_what_is_kept():
    """Without the scan, the blocks outside zones would be another text on many held-out pages."""
    evidence, _ = h.weights()
    changed = right = 0
    held_out = h.labelled_pages(100, seed=5)
    for page, text in held_out:
        elements, blocks = h.parse(page)
        place = h.places(elements, evidence)
        got = h.main_blocks(page)
        right += got == text
        changed += got != [t for b in blocks if (t := h.block_text(b, place))]
    assert changed > 20 and right >= 95


@pytest.mark.parametrize("page", ["<div>" * 40_000 + "x" + "</span>" * 40_000, "<b>" * 40_000 + "<p>x" * 40_000, "<ul><li><p>" * 20_000 + "x", "</div>" * 80_000 + "x"])
def test_deep_pages_take_linear_time(page):
    began = time.time()
    h.main_text(page)
    assert time.time() - began < 10


def test_empty_table_repeated_rows_and_other_columns(spark):
    rows = [(1, "u", "<p>a b c</p>", "t", 5), (1, "u", "<p>a b c</p>", "t", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted(h.extract(df).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(1, "u", "a b c", 5), (1, "u", "a b c", 5), (None, None, "", 0)], key=str)
    assert h.extract(df.limit(0)).collect() == []
    long = "<p>" + "word " * 400_000 + "</p>"
    assert h.extract(spark.createDataFrame([(1, "u", long)], "page_id long, url string, html string")).first().n_chars == 5 * 400_000 - 1
