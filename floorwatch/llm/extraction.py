"""Main text of web pages: a page becomes a flat row of text blocks, and a decision tree tells article from furniture.

Each block has its word count and link density, those of the blocks before and after it, and what its containers say of
themselves, weighed by the share of the page's text in them: a small teaser that calls itself an entry does not make the
rest of its page furniture, and a layout with a sidebar is none. The tree (CART by Gini impurity) is trained on BLOCKS, a
small table of labelled blocks. What follows a heading such as "Comments" in the same container is reader comments.

Inline tags leave no trace, a line break is white space, all other tags end a block. Scripts, styles, comments, forms,
titles and hidden parts are no text. Character references are decoded; white space in a block, as Unicode has it,
becomes one space; blocks are joined in page order by one space. Null and empty html, and pages without an article,
give an empty text. Tags may be unclosed or cut off. Each row is handled by itself, so repeated pages are no matter, a page
takes time in proportion to its length, and no pages give no rows. Only page_id, url and the html column are read; other
columns, whatever their names, are left out.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names by which containers call themselves, in class, id, role and itemprop: what is furniture even around an article, ...
FIRM_NAMES = frozenset(
    """nav navigation navbar menu footer breadcrumb breadcrumbs pagination pager copyright contentinfo complementary comment
    comments reply replies respond responses disqus opinions feedback talkback guestbook remarks ugc related recommended
    legal disclaimer""".split()
)
#: ... what is furniture unless an <article> or <main> in it says otherwise, ...
LOOSE_NAMES = frozenset(
    """topbar toolbar ad advert adverts advertisement advertising adbox sponsor sponsored promo promotion cookie cookies
    consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login register share sharing
    social skip""".split()
)
#: ... and what may be a sidebar as well as the layout around a whole page, told apart by the share of text in it.
LAYOUT_NAMES = frozenset("sidebar aside rail ads search widget masthead header head banner form".split())
ARTICLE_NAMES = frozenset("article articlebody post entry content main story body text".split())
#: Names that are furniture unless an article is around them.
OUTER_NAMES = frozenset({"header", "head", "banner"})
#: First and last parts of names that say how a page is laid out, not what a container is: with-sidebar, ad-free.
STATES = frozenset("with has have no not without is are show hide free none off on enabled disabled".split())

FIRM_TAGS = frozenset("nav footer aside dialog menu button select".split())
LAYOUT_TAGS = frozenset({"form", "fieldset"})
#: How a heading over reader comments reads.
COMMENTS_HEAD = re.compile(
    r"(?:\d+ )?(?:(?:reader|user|your|all) )?(?:comments?|replies|kommentare?|commentaires?|comentarios?)(?: \(?\d+\)?)?:?"
    r"|(?:leave|post|write|add) (?:a|your) (?:comment|reply)",
    re.IGNORECASE,
)
NONE, LAYOUT, LOOSE, FIRM = range(4)

INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong
    sub sup time tt u var wbr""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_RAW = "script style noscript template textarea title iframe object svg canvas audio video select option".split()
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(_RAW)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)


@dataclass
class Place:
    """An open tag: how far it is furniture, whether an article is around it, its innermost layout container."""

    tag: str
    level: int = NONE
    article: bool = False
    layout: int = -1
    heading: bool = False


@dataclass
class Block:
    text: str
    words: int
    linked: int
    level: int
    article: bool
    layout: int
    heading: bool


def _said(attributes: str) -> set[str]:
    """Whole names, and their first and last parts where those say what a container is."""
    names: set[str] = set()
    for match in _NAMED.finditer(attributes):
        for name in next(x for x in match.groups() if x is not None).split():
            parts = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if x]
            if parts and parts[0] not in STATES and parts[-1] not in STATES:
                names.update(("".join(parts), parts[0], parts[-1]))
    return names


def _below(outer: Place, tag: str, attributes: str, number: int) -> Place:
    """What a tag within another one is; number is its own among the page's containers."""
    names = _said(attributes) if attributes else set()
    level, layout, article = outer.level, outer.layout, outer.article
    if tag in ("article", "main"):
        if level < FIRM:
            level, layout = NONE, -1
        own = FIRM if names & FIRM_NAMES else NONE
    elif tag in FIRM_TAGS or names & FIRM_NAMES:
        own = FIRM
    elif names & LOOSE_NAMES:
        own = LOOSE
    elif tag in LAYOUT_TAGS or names & (LAYOUT_NAMES - OUTER_NAMES):
        own = LAYOUT
    elif tag == "header" or names & OUTER_NAMES:
        own = NONE if article else LAYOUT
    else:
        own = NONE
    if attributes and _HIDDEN.search(attributes):
        own = FIRM
    marks = tag in ("article", "main") or bool(names & ARTICLE_NAMES)
    return Place(
        tag, max(level, own), article or (marks and max(level, own) == NONE),
        number if own == LAYOUT else layout, tag in HEADINGS,
    )


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    stack = [Place("")]
    links = opened = 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                here = stack[-1]
                if here.heading and len(stack) > 1 and COMMENTS_HEAD.fullmatch(text):  # the rest of its container is comments
                    here.level = stack[-2].level = FIRM
                linked = sum(len(t.split()) for t, link in parts if link)
                out.append(Block(text, text.count(" ") + 1, linked, here.level, here.article, here.layout, here.heading))
            parts.clear()

    at = 0
    for match in _TOKEN.finditer(page):
        if match.start() > at:
            parts.append((entities.unescape(page[at : match.start()]), links > 0))
        at = match.end()
        closing, tag, attributes = match.group(2), match.group(3), match.group(4)
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            links = max(0, links - 1) if closing else 1
        if tag == "br":
            parts.append((" ", links > 0))
        if tag in VOID or tag in INLINE:
            if tag == "hr":
                flush()
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        links = 0
        if stack[-1].tag in ("p", *HEADINGS):
            stack.pop()
        if tag in ("li", "dt", "dd", "tr", "td", "th") and stack[-1].tag == tag:
            stack.pop()
        if not attributes.rstrip().endswith("/"):
            opened += 1
            outer = stack[-1]
            page_wide = tag in ("html", "body")
            stack.append(Place(tag, outer.level, outer.article, outer.layout) if page_wide else _below(outer, tag, attributes, opened))
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!]", rest)  # a tag that is cut off
        parts.append((entities.unescape(rest[: cut.start()] if cut else rest), links > 0))
    flush()
    return out


FEATURES = ("words", "link", "words_before", "link_before", "words_after", "link_after", "furniture", "place", "heading")

#: Labelled blocks, a row each: the features in the order of FEATURES, then 1 for article, 0 for furniture. Link densities
#: in percent. furniture: 100 in a container that calls itself so, less in a layout container, by the percent of the page's
#: text that it holds; 0 elsewhere. place: the percent of the page's text that containers marked as article hold, negative
#: outside of them, 0 without any.
BLOCKS = """
1 100 0 0 1 100 100 -100 0 0 | 1 100 1 100 1 100 100 -85 0 0 | 12 0 1 100 14 0 93 -92 0 0 | 40 0 1 100 9 0 78 -78 0 0
2 0 3 100 60 0 100 -97 0 0 | 8 0 120 0 0 0 64 -100 0 0 | 25 4 80 0 3 0 100 66 0 0 | 30 0 90 0 40 0 100 88 0 0
6 100 50 0 70 0 93 100 0 0 | 55 0 70 0 3 100 78 85 0 0 | 3 0 40 0 20 0 100 92 1 0 | 1 100 0 0 1 100 64 0 0 0
2 100 2 100 2 100 100 0 0 0 | 45 0 8 0 60 0 100 0 0 0 | 14 10 90 0 0 0 93 0 0 0 | 70 0 12 0 9 0 78 0 0 0
5 0 0 0 80 0 0 -100 1 0 | 30 0 5 0 2 0 0 -85 0 0 | 4 100 1 100 60 0 0 -92 0 0 | 18 0 90 0 0 0 0 -78 0 0
60 3 40 0 2 100 0 -97 0 0 | 9 0 3 100 80 0 0 100 1 1 | 13 0 40 0 15 0 0 66 1 1 | 2 0 70 0 30 0 0 88 1 1
80 0 9 0 40 0 0 100 0 1 | 120 2 80 0 6 0 0 85 0 1 | 1 0 60 0 90 0 0 92 0 1 | 1 0 1 0 1 0 0 78 0 1 | 3 0 90 0 12 0 0 97 0 1
45 20 30 0 30 0 0 100 0 1 | 6 0 110 0 8 0 0 66 0 1 | 200 0 3 0 0 0 0 88 0 1 | 8 60 50 0 50 0 0 100 0 1
15 100 60 0 20 0 0 85 0 1 | 1 100 80 0 70 0 0 92 0 1 | 34 0 0 0 0 0 0 78 0 1 | 90 0 8 0 60 0 0 0 0 1
40 5 70 0 80 0 0 0 0 1 | 25 0 60 0 50 0 0 0 0 1 | 9 0 70 0 90 0 0 0 0 1 | 150 1 4 0 20 10 0 0 0 1
22 0 45 0 4 100 0 0 0 1 | 6 0 80 0 60 0 0 0 1 1 | 10 0 2 100 75 0 0 0 1 1 | 4 0 65 0 48 0 0 0 1 1 | 30 0 12 0 36 5 0 0 0 1
18 8 52 0 41 0 0 0 0 1 | 13 0 33 0 27 0 0 0 0 1 | 1 100 1 100 1 100 0 0 0 0 | 2 100 1 100 2 100 0 0 0 0
3 100 0 0 2 100 0 0 0 0 | 5 80 3 100 4 100 0 0 0 0 | 20 90 3 100 12 80 0 0 0 0 | 2 0 1 100 3 100 0 0 0 0
4 0 6 60 0 0 0 0 0 0 | 7 50 30 0 5 100 0 0 0 0 | 3 0 4 100 2 100 0 0 0 0 | 6 0 3 50 4 0 0 0 0 0 | 5 0 4 0 0 0 0 0 0 0
2 0 3 0 4 0 0 0 1 0 | 2 0 0 0 1 100 0 97 0 1 | 9 0 1 100 5 0 0 100 0 1 | 30 0 2 100 1 0 0 66 0 1
4 100 2 100 3 100 0 88 0 0 | 1 0 2 0 60 40 0 100 0 1 | 75 10 1 50 3 100 0 85 0 1 | 12 0 5 0 4 100 0 92 1 1
3 0 2 0 1 0 0 78 0 1 | 50 0 20 0 3 20 0 97 0 1 | 7 0 1 0 2 0 0 100 0 1 | 18 30 4 0 7 0 0 66 0 1 | 2 100 9 0 0 0 0 88 0 1
1 0 33 0 25 0 0 100 0 1 | 140 0 1 0 1 0 0 85 0 1 | 66 0 2 0 4 100 0 92 0 1 | 5 50 1 100 70 0 0 78 0 1
90 0 3 0 50 0 0 -97 0 0 | 45 0 60 0 70 0 0 -100 0 0 | 10 0 2 0 40 0 0 -66 1 0 | 6 0 50 0 30 0 0 -88 0 0
22 5 9 0 12 0 0 -100 0 0 | 1 0 70 0 0 0 0 -85 0 0 | 35 0 1 100 90 0 0 -92 0 0 | 12 0 80 0 60 0 0 -78 0 0
28 0 20 0 16 0 0 -97 0 0 | 16 0 14 0 25 0 0 -100 0 0 | 120 0 40 0 2 100 0 -66 0 0 | 8 0 30 0 100 0 0 -88 1 0
5 0 1 100 24 0 0 0 1 1 | 24 0 5 0 18 0 0 0 0 1 | 18 0 24 0 5 0 0 0 0 1 | 7 0 18 0 22 0 0 0 0 1 | 16 0 7 0 1 100 0 0 0 1
31 6 16 0 2 100 0 0 0 1 | 12 0 28 0 19 0 0 0 0 1 | 55 0 1 100 1 100 0 0 0 1 | 2 0 1 100 31 0 0 0 1 1
8 12 29 0 44 0 0 0 0 1 | 21 0 2 0 33 0 0 0 0 1 | 37 4 21 0 2 0 0 0 0 1 | 2 0 1 100 1 100 0 0 0 0 | 4 0 2 100 3 0 0 0 0 0
3 0 5 0 0 0 0 0 0 0 | 1 100 2 100 22 0 0 0 0 0 | 3 100 30 0 2 100 0 0 0 0 | 2 0 26 0 0 0 0 0 0 0 | 6 83 1 100 35 0 0 0 0 0
9 100 8 100 7 100 0 0 0 0 | 60 0 50 0 70 0 5 0 0 1 | 120 2 80 0 6 0 10 0 0 1 | 40 5 70 0 80 0 2 0 0 1
30 0 45 0 20 0 3 0 0 1 | 5 0 2 100 60 0 8 0 1 1 | 2 100 3 100 2 100 8 0 0 0 | 1 100 2 100 1 100 12 0 0 0
3 100 1 100 50 0 4 0 0 0 | 45 0 60 0 30 0 55 0 0 0 | 25 0 30 0 40 0 42 0 0 0 | 70 0 12 0 9 0 60 0 0 0
16 0 30 0 22 0 48 0 0 0 | 38 0 50 0 45 0 70 0 0 0 | 90 0 80 0 70 0 85 0 0 0 | 3 0 50 0 0 0 0 3 0 0
4 0 2 100 12 0 0 6 0 0 | 6 0 40 0 8 0 0 10 0 0 | 5 20 30 0 1 100 0 8 0 0 | 3 0 60 0 70 0 0 2 0 0 | 60 0 55 0 3 0 0 -4 0 1
48 0 0 0 70 0 0 -6 0 1 | 80 0 60 0 2 100 0 -10 0 1 | 35 5 42 0 50 0 0 -3 0 1 | 26 0 90 0 33 0 0 -20 0 1
55 0 3 0 60 0 0 -2 0 1 | 4 0 3 100 70 0 0 -5 1 1 | 7 0 1 100 55 0 0 -3 1 1 | 2 100 1 100 2 100 0 -5 0 0
1 100 4 100 60 0 0 -8 0 0 | 3 100 2 100 1 100 0 -12 0 0 | 2 0 1 100 3 100 0 -4 0 0 | 30 0 44 0 25 0 0 -55 0 0
50 0 70 0 40 0 0 -62 0 0 | 42 0 35 0 60 0 0 -70 0 0 | 2 100 2 100 2 100 0 100 0 0 | 2 100 60 0 2 100 0 95 0 0
2 100 2 100 40 0 0 100 0 0 | 1 100 1 100 3 100 0 88 0 0 | 3 100 45 0 1 100 0 92 0 0 | 2 100 3 100 0 0 0 100 0 0
3 100 2 100 75 0 0 70 0 0 | 1 100 30 0 2 100 0 80 0 0 | 12 100 10 100 14 100 0 90 0 1 | 8 100 9 100 11 100 0 97 0 1
9 100 50 0 12 100 0 85 0 1 | 11 100 10 100 40 0 0 76 0 1 | 3 0 1 0 2 0 0 55 0 1 | 40 0 30 0 50 0 0 60 0 1
28 0 6 0 33 0 0 52 0 1 | 5 0 20 0 60 0 0 58 1 1 | 2 100 70 0 65 0 0 72 0 1
2 0 3 0 2 0 0 100 0 1 | 6 0 3 0 5 0 0 100 0 1 | 5 0 6 0 4 0 0 95 0 1 | 4 0 12 0 3 0 0 100 0 1 | 1 0 3 0 6 0 0 100 0 1
3 0 2 0 2 0 0 90 0 1 | 6 0 20 0 10 0 0 100 0 1 | 3 0 60 0 14 0 0 100 0 1 | 5 0 40 0 9 0 0 100 0 1 | 4 0 30 0 11 50 0 100 0 1
2 0 18 0 7 0 0 84 0 1 | 6 0 2 0 2 0 0 96 0 1 | 1 0 8 0 22 0 0 81 0 1 | 3 0 0 0 5 0 0 100 1 1 | 5 0 1 100 3 0 0 100 1 1
6 0 90 0 2 0 0 98 0 1 | 4 0 75 0 18 0 0 100 0 1 | 2 40 25 0 20 0 0 93 0 1 | 5 40 6 0 7 0 0 100 0 1 | 3 34 12 0 16 0 0 87 0 1
2 100 32 0 2 100 0 100 0 0 | 2 100 14 0 3 100 0 93 0 0 | 1 100 25 0 2 100 0 90 0 0 | 3 100 18 0 1 100 0 100 0 0
2 100 10 0 1 100 0 95 0 0 | 2 100 40 0 4 100 0 86 0 0
"""


class Tree:
    """A binary decision tree: at each node (feature, limit, below or at it, above it), at each leaf a label."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, least: int = 2):
        self.root = self._grow(rows, labels, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, least: int):
        if len(set(y.tolist())) == 1:
            return int(y[0])
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for limit in (values[:-1] + values[1:]) / 2:
                low = x[:, f] <= limit
                if min(low.sum(), (~low).sum()) < least:
                    continue
                impurity = sum(len(p) * 2 * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, limit, low)
        if best is None:
            return int(y.mean() >= 0.5)
        _, f, limit, low = best
        return f, float(limit), self._grow(x[low], y[low], least), self._grow(x[~low], y[~low], least)

    def label(self, row: tuple[float, ...]) -> int:
        node = self.root
        while isinstance(node, tuple):
            f, limit, low, high = node
            node = low if row[f] <= limit else high
        return node


def labelled() -> tuple[np.ndarray, np.ndarray]:
    table = np.asarray([row.split() for row in BLOCKS.replace("\n", "|").split("|") if row.strip()], dtype=float)
    return table[:, :-1], table[:, -1]


def described(found: list[Block]) -> list[tuple[float, ...]]:
    """The features of each block of a page."""
    text = [b.words - b.linked if b.level <= LAYOUT else 0 for b in found]
    total = max(1, sum(text))
    held: dict[int, int] = {}
    for block, words in zip(found, text, strict=True):
        held[block.layout] = held.get(block.layout, 0) + words
    marked = 100 * sum(words for block, words in zip(found, text, strict=True) if block.article) / total
    own = [(b.words, 100 * b.linked / b.words) for b in found]
    around = [(0, 0), *own, (0, 0)]
    furniture = [0 if b.level == NONE else 100 * (1 - held[b.layout] / total) if b.level == LAYOUT else 100 for b in found]
    return [
        (*own[i], *around[i], *around[i + 2], furniture[i], marked if b.article else -marked, b.heading)
        for i, b in enumerate(found)
    ]


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    return " ".join(b.text for b, row in zip(found, described(found), strict=True) if tree.label(row))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(Tree(*labelled()))
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        for batch in batches:
            texts = [main_text(x.as_py() or "", tree) for x in batch.column("html")]
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), *columns], names=["page_id", "url", "text", "n_chars"]
            )

    mine = pages.select("page_id", "url", F.col(html).alias("html"))
    return mine.mapInArrow(extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
