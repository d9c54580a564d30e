"""What stands in an article stays, and attributes are read as HTML reads them."""

import pytest

from tesserae.llm import html_extract as h

PARA = "<p>" + "word " * 40 + "</p>"
LINKS = "<ul>" + "".join(f"<li><a href=x>link{i}</a></li>" for i in range(30)) + "</ul>"
TABLE = "<table>" + "".join(f"<tr><td>{i}</td><td>{i * i}</td></tr>" for i in range(50)) + "</table>"
LINK_TEXTS = [f"link{i}" for i in range(30)]
NUMBERS = [str(x) for i in range(50) for x in (i, i * i)]
WORDS = " ".join(["word"] * 40)
CASES = {
    "sources and what follows": (PARA + "<h2>Sources</h2>" + LINKS + "<p>Last words.</p>", [WORDS, "Sources", *LINK_TEXTS, "Last words."]),
    "a table and what follows": (PARA + TABLE + "<p>End of it.</p>", [WORDS, *NUMBERS, "End of it."]),
    "an opening before a list": ("<p>An opening.</p>" + LINKS, ["An opening.", *LINK_TEXTS]),
    "an article of links": (LINKS, LINK_TEXTS),
    "a zone inside": (PARA + '<div class="related">' + LINKS + "</div>" + PARA, [WORDS, WORDS]),
}


@pytest.mark.parametrize("frame", ["article", "main"])
@pytest.mark.parametrize("case", CASES)
def test_articles_are_whole(case, frame):
    inner, want = CASES[case]
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Menu {i}</a></li>" for i in range(9)) + "</ul>"
    page = f"<html><body><nav>{menu}</nav><div>{menu}</div><{frame}><h1>Title here</h1>{inner}</{frame}><footer><p>Foot words</p></footer></body></html>"
    assert h.main_blocks(page) == ["Title here", *want]


def test_quotes_begin_values_after_an_equals_sign_alone():
    assert h.main_text("<p title=it's>One two three four five six</p><p>Don't stop here at all</p>") == "One two three four five six\nDon't stop here at all"
    assert h.main_text(f"<article>{PARA}<p title='a > b' data-x=\"c > d\">More of it</p></article>").endswith("\nMore of it")
    assert h.main_text(f"<article>{PARA}<p alt = \"x\" title=\"the class sidebar\">More of it</p></article>").endswith("\nMore of it")


@pytest.mark.parametrize("size", [10, 511, 512, 5000, 300_000])
def test_long_attributes_hide_no_evidence(size):
    page = f'<article>{PARA}<div data-x="{"y" * size}" class="sidebar">side words here</div><p>More of it</p></article>'
    assert h.main_blocks(page) == [WORDS, "More of it"]


def test_a_page_of_unclosed_quotes_ends():
    assert "tail" not in h.main_text('<p class="' * 3000) and h.main_text("<a href=" * 5000) == ""
