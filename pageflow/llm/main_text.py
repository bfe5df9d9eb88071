"""Main text of web pages by tag-path ratios.

A block of text lies in one block-level element; its tag path is the way from
the root to that element. Per page, text length, punctuation and link text are
added up per path and divided by the path's blocks; the ratios are smoothed over
sibling paths, fused into one value and compared with a threshold taken from the
page itself. Blocks on paths over it are content. Headings, and the short
paragraphs, list items, cells and the like in the part of the page that holds
the content, are filled in. Blocks that are mostly links are left out, with the
headings over nothing else.

Elements whose tag says that they are no content (navigation, scripts and the
like) carry no weight. A class, id or role, or a form, is only a hint: elements so hinted
are left out as long as enough of the page's text is left, and otherwise come
back one by one, the largest first, those that tell of comments last. Reader
comments without a hint are known by their structure: several like elements
one after the other, each with a byline, under a heading that tells of comments
or with bylines that do. An ``article`` or ``main`` element outside of all these is
a prior only: on a page that has one, paths outside count by ``OUTSIDE``.

The work grows in proportion to the page, however its markup is broken.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shipping import map_arrow

SMOOTHING = 0.5
THRESHOLD = 0.8
#: What a path outside of ``article`` and ``main`` counts, where a page has them.
OUTSIDE = 0.5
#: A block with a larger share of link text is left out.
LINKED = 0.5
#: With a smaller share of the page's text left, hinted elements come back; for those that tell of comments, the second.
LEAST_LEFT, LEAST_BESIDE_COMMENTS = 0.2, 0.05
#: Hinted elements smaller than this share come back together.
SMALL = 0.05
#: Text of an article that is enough by itself, and text before comments.
SOME_TEXT = 200
#: A byline is no longer than this.
BYLINE = 80

# Element kinds of the language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br input".split()
)
UNSEEN = frozenset("head script style noscript template textarea select option button svg math iframe object canvas video audio title dialog".split())
ASIDE = frozenset("nav footer aside menu".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text by their meaning.
WRITTEN = HEADINGS | frozenset("p li dt dd td th pre blockquote figcaption caption".split())
#: Elements that are parts of a body and never the whole.
NO_BODY = WRITTEN | frozenset("ul ol dl table thead tbody tfoot tr figure".split())
#: An element that ends an open one of the same group, up to the boundary element.
CLOSES = {
    "p": ({"p"}, {"td", "th", "li", "blockquote", "div", "section", "article", "main", "body"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Elements before which an open paragraph ends.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split()
)
#: Words in class, id or role that hint at what is not content.
HINTS = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookiebar "
    "cookies footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promotion recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar widget widgets".split()
)
#: Words that hint at reader comments.
COMMENT_HINTS = frozenset(
    "comment commentform commentlist comments discussion disqus feedback replies reply respond responses talkback".split()
)
#: The same as the first, unless inside an article.
PAGE_HINTS = frozenset("header footer foot".split())
#: A class that begins so tells of another element.
OTHERS = frozenset("has with no without".split())
NO_HINT, HINT, COMMENT_HINT = 0, 1, 2
#: Words of a heading over reader comments, and of a byline in them.
_OVER_COMMENTS = re.compile(r"(?i)\b(comments?|responses?|repl(?:y|ies)|discussion|thoughts|feedback|readers?|kommentare?|comentarios?|commentaires?)\b")
_COMMENT_BYLINE = re.compile(r"(?i)\b(reply|says|wrote|writes|permalink|commented|antworten|responder|répondre)\b")
_DATED = re.compile(
    r"(?i)\b(\d{1,2}:\d{2}|\d{4}-\d{1,2}-\d{1,2}|\d{1,2}[./]\d{1,2}[./]\d{2,4}|\d+ \w+ ago|yesterday|today"
    r"|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.? \d{1,2}|\d{1,2}\.? (?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec))"
)
_UNSEEN_STYLE = re.compile(r"(?i)\b(display\s*:\s*none|visibility\s*:\s*hidden)")
_DIGITS = re.compile(r"\d+")
_TAG_START = re.compile("<[A-Za-z/!?]")
_WORDS = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[.,;:!?¿¡…、。，！？]")


@dataclass
class Element:
    tag: str
    path: int
    aside: bool
    inside: bool
    link: bool
    number: int


@dataclass
class Node:
    path: int
    block: int
    text: str
    inside: bool
    link: bool
    element: int


@dataclass
class Block:
    path: int
    text: str
    inside: bool
    linked: int
    element: int

    @property
    def link_list(self) -> bool:
        return self.linked > LINKED * len(self.text)


@dataclass
class Page:
    """Text nodes that may be content, and the paths: parent path and tag of each."""

    nodes: list[Node] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [0])
    tags: list[str] = field(default_factory=lambda: [""])
    numbers: dict[tuple[int, str], int] = field(default_factory=dict)
    #: Elements that are no inline ones, or hinted: the element above, its look, and its hint.
    above: list[int] = field(default_factory=lambda: [0])
    looks: list[tuple[str, str]] = field(default_factory=lambda: [("", "")])
    hints: list[int] = field(default_factory=lambda: [NO_HINT])

    def path(self, parent: int, tag: str) -> int:
        found = self.numbers.setdefault((parent, tag), len(self.parents))
        if found == len(self.parents):
            self.parents.append(parent)
            self.tags.append(tag)
        return found


def _hint(value: str, inside: bool) -> int:
    found = NO_HINT
    for name in value.lower().split():
        words = _WORDS.findall(name)
        if not words or words[0] in OTHERS:
            continue
        if not COMMENT_HINTS.isdisjoint(words):
            return COMMENT_HINT
        if not HINTS.isdisjoint(words) or (not inside and not PAGE_HINTS.isdisjoint(words)):
            found = HINT
    return found


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page, self.open, self.block = Page(), [Element("", 0, False, False, False, 0)], 0
        self.counts: Counter[str] = Counter()  # of open elements, so that no end tag looks for one in vain

    def parse_marked_section(self, i, report=1):
        # an unknown section ends at the next bracket, as a comment would
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _cut(self, at: int) -> None:
        if any(e.tag not in INLINE for e in self.open[at:]):
            self.block += 1
        self.counts.subtract(e.tag for e in self.open[at:])
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._close_open({"p"}, CLOSES["p"][1])
        if tag in CLOSES:
            self._close_open(*CLOSES[tag])
        above = self.open[-1]
        hint = max((_hint(value, above.inside) for name, value in attrs if name in ("class", "id", "role") and value), default=NO_HINT)
        hidden = any(
            name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and _UNSEEN_STYLE.search(value))
            for name, value in attrs
        )
        content = tag in CONTENT or ("role", "main") in attrs
        aside = above.aside or hidden or tag in UNSEEN or tag in ASIDE or (tag == "header" and not above.inside)
        if content or tag in ("html", "body"):
            hint = NO_HINT
        elif tag == "form":
            hint = max(hint, HINT)
        if tag not in INLINE:
            self.block += 1
        if tag in VOID:
            if tag in ("br", "hr", "img") and self.page.nodes:
                self.handle_data(" ")
            return
        path, number = above.path, above.number
        if tag not in INLINE:
            path = self.page.path(above.path, tag)
        if tag not in INLINE or hint:
            number = len(self.page.above)
            self.page.above.append(above.number)
            self.page.looks.append((tag, _DIGITS.sub("", next((value or "" for name, value in attrs if name == "class"), ""))))
            self.page.hints.append(hint)
        self.counts[tag] += 1
        self.open.append(Element(tag, path, aside, not aside and (above.inside or content), above.link or tag == "a", number))

    def _close_open(self, tags: set[str], bounds: set[str]) -> None:
        if not any(self.counts[tag] for tag in tags):
            return None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                return self._cut(at)
            if self.open[at].tag in bounds:
                return None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.counts[tag]:
            return None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                return self._cut(at)
            if tag in INLINE and self.open[at].tag not in INLINE:
                return None

    def handle_data(self, data):
        above = self.open[-1]
        if not above.aside:
            self.page.nodes.append(Node(above.path, self.block, data, above.inside, above.link, above.number))


def parse(html: str) -> Page:
    # a comment that does not end takes all that follows; the parser would look for its end at every mark
    unended = html.find("<!--", html.rfind("-->") + 1)
    html = html[:unended] if unended >= 0 else html
    # likewise for a tag
    unended = _TAG_START.search(html, html.rfind(">") + 1)
    reader = _Reader()
    reader.feed(html[: unended.start()] if unended else html)
    reader.close()
    page = reader.page
    out = _hinted_out(page)
    page.nodes = [node for node in page.nodes if not out[node.element]]
    out = _comments(page)
    page.nodes = [node for node in page.nodes if not out[node.element]]
    return page


def _sums(page: Page) -> tuple[list[int], list[int]]:
    """Text in each element by itself, and with the elements below."""
    own = [0] * len(page.above)
    for node in page.nodes:
        own[node.element] += len(node.text.strip())
    whole = own.copy()
    for e in range(len(whole) - 1, 0, -1):
        whole[page.above[e]] += whole[e]
    return own, whole


def _below(page: Page, marked: list[bool]) -> list[bool]:
    """The marked elements and all below them."""
    out = marked.copy()
    for e in range(1, len(out)):
        out[e] = out[e] or out[page.above[e]]
    return out


def _hinted_out(page: Page) -> list[bool]:
    """Elements that are left out by their hints."""
    own, whole = _sums(page)
    marked = [hint != NO_HINT for hint in page.hints]
    article = [0] * len(own)
    for node in page.nodes:
        if node.inside:
            article[node.element] += len(node.text.strip())
    while True:
        out = _below(page, marked)
        left = sum(size for size, gone in zip(own, out, strict=True) if not gone)
        if left >= LEAST_LEFT * whole[0] or sum(size for size, gone in zip(article, out, strict=True) if not gone) >= SOME_TEXT:
            return out
        outer = [e for e in range(1, len(own)) if marked[e] and not out[page.above[e]] and whole[e]]
        back = [e for e in outer if page.hints[e] == HINT]
        if not back and left < LEAST_BESIDE_COMMENTS * whole[0]:
            back = outer
        if not back:
            return out
        largest = max(back, key=whole.__getitem__)
        # many small ones come back at once
        for e in [largest] if whole[largest] >= SMALL * whole[0] else back:
            marked[e] = False


def _comments(page: Page) -> list[bool]:
    """Elements of reader comments: like neighbours with bylines, after the text they comment on."""
    own, whole = _sums(page)
    n = len(own)
    before, told, dated = [-1] * n, [False] * n, [False] * n
    over: dict[int, str] = {}
    seen, last = 0, ""
    for block in text_blocks(page):
        e = block.element
        byline = len(block.text) <= BYLINE
        for marks, pattern in ((told, _COMMENT_BYLINE), (dated, _DATED)):
            if byline and pattern.search(block.text):
                up = e
                while up and not marks[up]:
                    marks[up] = True
                    up = page.above[up]
        up = e
        while up and before[up] < 0:
            before[up], over[up] = seen, last
            up = page.above[up]
        seen += len(block.text)
        last = block.text if page.tags[block.path] in HEADINGS else ("" if not byline else last)
    children: dict[int, list[int]] = {}
    for e in range(1, n):
        if before[e] >= 0:
            children.setdefault(page.above[e], []).append(e)
    marked = [False] * n
    for members in children.values():
        for _, some in groupby(members, key=lambda e: page.looks[e]):
            run = list(some)
            size = sum(whole[e] for e in run)
            if len(run) < 2 or before[run[0]] < SOME_TEXT or size > (1 - LEAST_LEFT) * whole[0]:
                continue
            headed = bool(_OVER_COMMENTS.search(over[run[0]]))
            known = sum(told[e] or (headed and dated[e]) for e in run)
            if known >= 2 and 5 * known >= 4 * len(run):
                for e in run:
                    marked[e] = True
    return _below(page, marked)


def text_blocks(page: Page) -> list[Block]:
    """The blocks that hold text, in page order, with single spaces inside."""
    held: list[list[Node]] = []
    for node in page.nodes:
        if not held or node.block != held[-1][0].block:
            held.append([])
        held[-1].append(node)
    blocks = []
    for nodes in held:
        text = " ".join("".join(node.text for node in nodes).split())
        if text:
            linked = len(" ".join("".join(node.text for node in nodes if node.link).split()))
            blocks.append(Block(nodes[0].path, text, any(node.inside for node in nodes), linked, nodes[0].element))
    return blocks


def path_values(page: Page, blocks: list[Block]) -> np.ndarray:
    """The fused value of each path: smoothed text ratio, raised by punctuation, lowered by links and outside the article."""
    n = len(page.parents)
    length, marks, links, inside, count = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for block in blocks:
        size = len(block.text)
        length[block.path] += size
        marks[block.path] += len(_MARKS.findall(block.text))
        links[block.path] += block.linked
        inside[block.path] += size * block.inside
        count[block.path] += 1
    used = np.maximum(count, 1)
    parents = np.array(page.parents)

    def smooth(ratio: np.ndarray) -> np.ndarray:
        family = np.bincount(parents, ratio, n)[parents] + ratio[parents]
        members = np.bincount(parents, count > 0, n)[parents] + (count > 0)[parents]
        return (1 - SMOOTHING) * ratio + SMOOTHING * family / np.maximum(members, 1)

    text_ratio, mark_ratio = smooth(length / used), smooth(marks / used)
    value = np.where(count > 0, text_ratio * np.sqrt(1 + mark_ratio) * (1 - links / np.maximum(length, 1)), 0.0)
    return value * (OUTSIDE + (1 - OUTSIDE) * inside / np.maximum(length, 1)) if inside.any() else value


def _root(page: Page, paths: set[int]) -> int:
    """The lowest common ancestor of the paths that may hold a body: no paragraph, list or table."""

    def way(path: int) -> list[int]:
        up = [path]
        while up[-1]:
            up.append(page.parents[up[-1]])
        return up[::-1]

    ways = [way(path) for path in paths]
    root = 0
    for step in zip(*ways):
        if len(set(step)) > 1:
            break
        root = step[0]
    while page.tags[root] in NO_BODY:
        root = page.parents[root]
    return root


def content_blocks(page: Page) -> list[Block]:
    """The blocks of the content, in page order."""
    blocks = text_blocks(page)
    value = path_values(page, blocks)
    held = value[value > 0]
    if not len(held):
        return [block for block in blocks if block.inside]
    chosen = value >= max(THRESHOLD * held.mean(), held.mean() - held.std(), 1e-9)
    tags = [page.tags[block.path] for block in blocks]
    over = [i for i, block in enumerate(blocks) if chosen[block.path]]
    # a heading is content through what it stands over
    main = [i for i in over if not blocks[i].link_list and tags[i] not in HEADINGS] or over
    own = frozenset(main)
    root = _root(page, {blocks[i].path for i in main})
    below, near = np.zeros(len(value), bool), np.zeros(len(value), bool)
    below[root] = near[page.parents[root]] = True
    for path in range(1, len(value)):
        below[path] |= below[page.parents[path]]
        near[path] |= near[page.parents[path]]
    kept = np.zeros(len(blocks), bool)
    kept[main] = True
    for i, block in enumerate(blocks):
        if tags[i] in WRITTEN and not block.link_list:
            # a heading or paragraph may also lie between content, or before it beside the part that holds it
            beside = tags[i] in HEADINGS or tags[i] == "p"
            kept[i] |= below[block.path] or (beside and (main[0] < i < main[-1] or (i < main[0] and near[block.path])))
        elif tags[i] in HEADINGS:
            kept[i] |= below[block.path] and i + 1 in own
    for i in np.flatnonzero(kept)[::-1]:
        if tags[i] in HEADINGS and i not in own:
            end = next((j for j in range(i + 1, len(blocks)) if tags[j] in HEADINGS and tags[j] <= tags[i]), len(blocks))
            kept[i] = kept[i + 1 : end].any() or (end == i + 1 and i < main[-1])
    return [block for block, keep in zip(blocks, kept, strict=True) if keep]


def extract(html: str | None) -> str:
    """Blocks of the main text, one per line, with single spaces inside."""
    return "\n".join(block.text for block in content_blocks(parse(html or "")))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``.

    A null or empty page, and one without content, has the empty text. Rows are
    kept as they are, also repeated ones and those with null ids. Other columns
    are not read. Pages of any length are read whole; an empty table gives an
    empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                some = batch.slice(begin, 256)
                texts = [extract(html) for html in some["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some["page_id"], some["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, text string, n_chars long")
