"""Main text of web pages as the maximum-scoring contiguous run of words and tags.

A page is read as a stream of words and tags in blocks.  Words of running text score above zero, and so do all words of an
article or main, its lists of links too; words of other links and of zones (elements whose tag and names speak for a menu, a
footer, an advert...) score below it, and so do tags, which weigh less inside an article; a linear scan finds the
contiguous run of blocks with the highest sum, and its blocks, without the words of zones, are the text.  All weights are
log-odds counted over labelled pages (``labelled_pages``: made by a rule, bounded in number by ``TRAIN_PAGES``); the sign
of a word of running text and of a tag is the method's and stays.

What an element is follows from all of its evidence: the log-odds of its tag and of what its class, id and role say, token by
token - a zone ("site-footer"), content ("post"), or neither, as "has-sidebar", "no-ads" and "share-enabled" speak of
something else.  Negative evidence makes a zone, unless the element is a wrapper: one that holds every article or main (or,
for other than header, nav, footer and aside, every h1 of a page without them) of the page that is no zone itself.  Zones
inside content do not end a run: they are left out of the stream.  Nothing but hidden elements goes without a score.

Defined cases: a null, empty or wordless page gives an empty text; unclosed elements end where HTML lets them end; closing
tags without an open element are ignored; a tag or comment cut off at the end of a page is dropped; rows are returned as
often as they come, rows with a null id or url too; other columns of the input, whatever their names, are not returned; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .runtime import ship_code, table

TRAIN_PAGES, SEED = 600, 7

#: Elements of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg annotation".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace mpadded mphantom semantics".split()
)
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote pre figcaption address br article main".split())
LANDMARKS = frozenset("header nav footer aside".split())
#: Words of class, id and role that name what is no article, what is one, and what speaks of something else.
ZONE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion sidebar side aside comment comments commentlist "
    "reply replies respond disqus discussion cookie cookies consent gdpr notice notices notification alert banner popup modal overlay newsletter "
    "subscribe subscription share sharing social related recommended recommendations breadcrumb breadcrumbs menu menus nav navbar navigation topnav "
    "footer foot header masthead topbar copyright legal widget widgets toolbar pagination pager login signin signup register search searchbox toc "
    "skip hidden form contentinfo complementary dialog paywall disclaimer tags taglist feedback rating".split()
)
CONTENT_WORDS = frozenset("article post content entry story main body text page blog news single prose".split())
OTHER_WORDS = frozenset("has no with without is not enabled disabled hide show wrapper wrap container layout open closed".split())
# a quote begins a value after an equals sign alone; elsewhere it is a character like others
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:"[^"]*"|'[^']*')|=(?!\s*["']))*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TELLING = frozenset("class id role hidden aria-hidden style".split())
_NAMES = re.compile(r"[a-z]+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    features: tuple[str, ...]
    hidden: bool
    anchors: int = 0  # articles, mains and, apart, h1s inside
    titles: int = 0


@dataclass(slots=True)
class Block:
    pieces: list[tuple[str, int]] = field(default_factory=list)  # text and the element it stands in
    tags: list[tuple[str, int]] = field(default_factory=list)


def _says(token: str) -> str:
    """What one token of a class, id or role speaks for."""
    words = set(_NAMES.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()))
    if words & OTHER_WORDS:
        return "other"
    return "zone" if words & ZONE_WORDS else "content" if words & CONTENT_WORDS else "other"


@functools.lru_cache(1 << 12)
def _features(tag: str, attributes: str) -> tuple[tuple[str, ...], bool]:
    """Evidence that an element gives, and whether it is hidden."""
    said, hidden = {f"tag {tag}"}, False
    for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), a or b or c
        if name not in _TELLING:
            continue
        if name == "style":
            hidden |= bool(_NOT_SHOWN.search(value.lower()))
        elif name in ("hidden", "aria-hidden"):
            hidden |= name == "hidden" or value.lower() == "true"
        else:
            said |= {f"name {x}" for t in value.split() if (x := _says(t)) != "other"}
    return tuple(sorted(said)), hidden and tag not in ("html", "body")


def parse(page: str) -> tuple[list[Element], list[Block]]:
    """Elements in the order of their beginnings, and blocks; linear in the page, however deep it is."""
    elements = [Element("", -1, (), False)]
    blocks, block = [], Block()
    stack: list[int] = [0]
    open_: Counter = Counter()
    outer: list[int] = [0]  # places of the stack that hold no inline element

    def pop_to(k: int) -> None:
        for e in stack[k:]:
            open_[elements[e].tag] -= 1
        del stack[k:]
        while outer[-1] >= k:
            outer.pop()

    def at_block(depth: int) -> str:
        return elements[stack[outer[-depth]]].tag if len(outer) >= depth else ""

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            block.pieces.append((page[at:], stack[-1]))
            break
        if m.start() > at:
            block.pieces.append((page[at : m.start()], stack[-1]))
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        if not m[2] and not m[0].endswith(">"):
            break
        tag = tag.lower()
        if tag not in INLINE and (block.pieces or block.tags):
            blocks.append(block)
            block = Block()
        block.tags.append((tag, stack[-1]))
        if closing:
            if open_[tag]:
                pop_to(next(k for k in range(len(stack) - 1, -1, -1) if elements[stack[k]].tag == tag))
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            if tag == "br":
                block.pieces.append((" ", stack[-1]))
            continue
        if tag in CLOSES_P and at_block(1) == "p":
            pop_to(outer[-1])
        elif tag == "li" and "li" in (at_block(1), at_block(2) if at_block(1) == "p" else ""):
            pop_to(outer[-1] if at_block(1) == "li" else outer[-2])
        if attributes.rstrip().endswith("/") and tag not in ("p", "div", "span", "a"):
            continue
        features, hidden = (_features if len(attributes) < 512 else _features.__wrapped__)(tag, attributes)  # long ones are not kept
        elements.append(Element(tag, stack[-1], features, hidden))
        if tag not in INLINE:
            outer.append(len(stack))
        stack.append(len(elements) - 1)
        open_[tag] += 1
    blocks.append(block)
    return elements, blocks


def places(elements: list[Element], evidence: dict[str, float]) -> list[str]:
    """For each element what its words are: text, link, told or cited (text and links inside an article or main), zone, inner
    (a zone inside content) or hidden."""
    own = [sum(evidence.get(f, 0.0) for f in e.features) for e in elements]
    for e in elements:
        e.anchors = e.titles = 0
    for k in range(len(elements) - 1, 0, -1):  # children come after their parents
        e = elements[k]
        parent = elements[e.parent]
        parent.anchors += e.anchors + (e.tag in ("article", "main") and own[k] >= 0)
        parent.titles += e.titles + (e.tag == "h1")
    anchors, titles = elements[0].anchors, elements[0].titles
    out, content, core = ["text"], [False], [False]
    for k, e in enumerate(elements[1:], 1):
        above, inside = out[e.parent], content[e.parent]
        wraps = anchors and e.anchors == anchors or not anchors and titles and e.titles == titles and e.tag not in LANDMARKS
        heads = e.tag == "header" and inside  # the title of an article
        if e.hidden or above == "hidden":
            out.append("hidden")
        elif above in ("zone", "inner"):
            out.append(above)
        elif own[k] < 0 and not wraps and not (heads and "name zone" not in e.features):
            out.append("inner" if inside else "zone")
        else:
            link = e.tag == "a" or above in ("link", "cited")
            out.append(("cited" if link else "told") if core[e.parent] else "link" if link else "text")
        good = own[k] > 0 and out[k] in ("text", "link", "told", "cited")
        content.append(inside or good and (e.tag in ("article", "main") or "name content" in e.features))
        core.append(core[e.parent] or good and e.tag in ("article", "main"))
        if core[k] and out[k] == "text":
            out[k] = "told"  # the article itself
    return out


def kinds(block: Block, elements: list[Element], place: list[str]) -> Counter:
    """How often each kind of word and tag is met in a block."""
    out: Counter = Counter()
    for text, e in block.pieces:
        if place[e] not in ("inner", "hidden") and (n := len(text.split())):
            out[f"word {place[e]}"] += n
    for tag, e in block.tags:
        if place[e] not in ("inner", "hidden"):
            out["tag zone" if place[e] == "zone" else "tag told" if place[e] in ("told", "cited") else "tag link" if tag == "a" else "tag inline" if tag in INLINE and tag != "br" else "tag text" if tag in TEXT_TAGS else "tag frame"] += 1
    return out


SHOWN = ("text", "link", "told", "cited")


def block_text(block: Block, place: list[str]) -> str:
    shown = "".join(text for text, e in block.pieces if place[e] in SHOWN)
    return " ".join(html.unescape(shown).split())


def labelled_pages(count: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[str, list[str]]]:
    """Pages and the blocks of their articles, made by a rule: frames, menus, adverts and comments around paragraphs, half of
    the pages with telling names, the others without any."""
    rng = random.Random(seed)
    stem = ["lo", "ren", "ta", "mi", "ku", "sel", "dor", "vi"]
    word = lambda: "".join(rng.choices(stem, k=rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    zones, tags = sorted(ZONE_WORDS), sorted(LANDMARKS | {"form", "menu", "dialog", "button", "select", "object", "audio", "video", "datalist", "canvas", "applet", "map"})
    pages = []
    for _ in range(count):
        named = rng.random() < 0.5
        title, body = words(3, 9), [words(8, 90) + "." for _ in range(rng.randint(2, 9))]
        menu = lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 2)}</a></li>' for _ in range(rng.randint(3, 9))) + "</ul>"

        def frame(size: int, named=named, menu=menu) -> str:
            inner = menu() if rng.random() < 0.5 else f"<p>{words(1, size)}</p>"
            tag = rng.choice(tags) if rng.random() < 0.6 or not named else "div"
            name = f' class="{word()} {rng.choice(zones)}-{word()}"' if named and (tag == "div" or rng.random() < 0.3) else ""
            return f"<{tag}{name}>{inner}</{tag}>" if named or rng.random() < 0.5 else f"<div>{menu()}</div>"

        outer, name = rng.choice(["article", "main", "div", "section"]), ""
        if named and rng.random() < 0.7:
            name = f' class="{rng.choice(sorted(CONTENT_WORDS))} {rng.choice(["has-", "no-", "with-"])}{rng.choice(zones)}"'
        text = "".join(f"<p>{p}</p>" if rng.random() < 0.8 else f"<p><b>{p}<br>" for p in body)
        if rng.random() < 0.3:
            text = text.replace("</p>", "</p>" + f'<div class="{rng.choice(zones)}">{words(3, 30)}</div>', 1) if "</p>" in text else text
        if outer in ("article", "main") and rng.random() < 0.4:  # sources, or a table of numbers
            lines = [words(1, 3) if rng.random() < 0.5 else str(rng.randint(1, 9999)) for _ in range(rng.randint(3, 40))]
            text += "<ul>" + "".join(f'<li><a href="/{word()}">{x}</a></li>' for x in lines) + "</ul>" if rng.random() < 0.5 else "<table>" + "".join(f"<tr><td>{x}</td></tr>" for x in lines) + "</table>"
            body += lines
        page = "".join(frame(25) for _ in range(rng.randint(1, 4))) + f"<{outer}{name}><h1>{title}</h1>{text}</{outer}>" + "".join(frame(40) for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.1:
            page = f"<form>{page}</form>"
        pages.append((f"<html><body>{page}</body></html>", [title, *body]))
    return pages


@functools.cache
def weights() -> tuple[dict[str, float], dict[str, float]]:
    """Log-odds, over the labelled pages, of an element's features by the words they hold, and of each kind of word and tag
    by the blocks they stand in."""
    pages = [(parse(page), set(text)) for page, text in labelled_pages()]
    inside, outside = Counter(), Counter()
    for (elements, blocks), article in pages:
        chain: dict[int, frozenset] = defaultdict(frozenset)
        for k, e in enumerate(elements[1:], 1):
            chain[k] = chain[e.parent] | frozenset(e.features)
        for b in blocks:
            for text, e in b.pieces:
                mine = " ".join(html.unescape("".join(t for t, _ in b.pieces)).split()) in article
                for f in chain[e]:
                    (inside if mine else outside)[f] += len(text.split())
    odds = lambda k, a, b: math.log((a[k] + 1) / (sum(a.values()) + 1)) - math.log((b[k] + 1) / (sum(b.values()) + 1))
    evidence = {f: round(odds(f, inside, outside), 3) for f in {*inside, *outside} if f.startswith("name") or f.removeprefix("tag ") not in ("html", "body", "div", "section", "p", "ul", "ol", "li", "b", "br", "a", "h1")}
    evidence["name zone"], evidence["name content"] = min(evidence["name zone"], -0.1), max(evidence["name content"], 0.1)
    inside, outside = Counter(), Counter()
    for (elements, blocks), article in pages:
        place = places(elements, evidence)
        for b in blocks:
            (inside if block_text(b, place) in article else outside).update(kinds(b, elements, place))
    w = {k: odds(k, inside, outside) for k in ("word text", "word link", "word told", "word cited", "word zone", "tag told", "tag text", "tag frame", "tag link", "tag zone", "tag inline")}
    return evidence, {k: max(x, 0.1) if k in ("word text", "word told", "word cited") else min(x, -0.1) for k, x in w.items()}


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the highest sum (the first of several; empty where no sum is above zero)."""
    best = here = 0.0
    run, start = (0, 0), 0
    for k, x in enumerate(scores):
        if here <= 0:
            here, start = 0.0, k
        here += x
        if here > best:
            best, run = here, (start, k + 1)
    return run


def main_blocks(page: str | None) -> list[str]:
    """The blocks of the best run, without the words of zones."""
    if not page:
        return []
    evidence, w = weights()
    elements, blocks = parse(page)
    place = places(elements, evidence)
    a, b = best_run([sum(w[k] * n for k, n in kinds(x, elements, place).items()) for x in blocks])
    return [text for x in blocks[a:b] if (text := block_text(x, place))]


def main_text(page: str | None) -> str:
    return "\n".join(main_blocks(page))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points)."""
    ship_code(pages.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(it):
        for b in it:
            texts = [main_text(p) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
