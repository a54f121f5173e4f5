"""Main text of web pages by tag-path ratios.

A page is read into text nodes with their paths of tags from the root. Per path, the
length of text and the punctuation are added up over all nodes and divided by the number
of nodes; both ratios are smoothed over neighbouring paths in page order and multiplied.
Paths above the threshold are content. The deepest container that holds nearly all
content is the article, or an article, main or content container around it, if content or
a heading stands beside: its nodes are kept, so short headings and captions inside it are
not lost. Content outside it is kept too, with the headings before it. Menus, forms and
the like are left out by their elements.

Names (``class``, ``id``, ``role``) leave out parts around an article. Inside one, only a
whole name of a block does (``class="ad"``); a block whose name merely contains such a word
(``id="search-methods"``) goes only if its own ratios are low, too. Headings, paragraphs
and list items of an article are never judged by their names.

Reading takes time in proportion to the page: paths and containers are linked to their
parents, never written out, and no pattern looks at a character again and again.

Character references are decoded; white space inside a block becomes one blank; blocks
are joined by one blank in page order.

Cases: a null or empty page, or one without content, gives the empty text; unclosed and
stray tags are taken as browsers do for paragraphs and lists; a tag that never ends is
text; elements may be nested to any depth; a null or repeated identifier is carried as it
is; further columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LABEL = re.compile(r"""(?<![\w-])(class|id|role|style|aria-hidden|hidden)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile(r"[A-Za-z][^\s/>]*")
STOP = re.compile("[>\"']")
# fixed values: elements of HTML and usual names of page parts
RAW = set("script style noscript template iframe svg textarea title select".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CONTAINERS = set("html body main article section div td blockquote center".split())
SKIPPED = set("nav footer aside form button input label fieldset menu dialog head object canvas".split())
NAMES = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer header masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination popup promo promotion related reply respond share "
    "sharing sidebar social sponsor sponsored subscribe toolbar widget alert complementary "
    "contentinfo search form".split()
)
NEVER_CONTENT = set("ad ads comment comments related share sidebar footer nav".split())
# in an article, only these are judged by their names
BLOCKS = set("div section ul ol dl table figure details span iframe".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES = {
    "p": {"p"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
ENDS_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)
CONTENT_NAMES = set("article entry post content main".split())
BARRIERS = {"ul", "ol", "dl", "table", "div", "section", "article", "body", "td", "th", "main"}
COVER = 0.9
THRESHOLD = 0.1
# a block with a doubtful name needs this share of the article's ratio
DOUBT = 0.25
PRIOR = 4.0
WANTED, DOUBTFUL, UNWANTED = range(3)


@dataclass(frozen=True)
class Element:
    """An open element with what holds for all text inside it."""

    name: str
    path: int
    box: int
    wanted: bool
    doubt: int
    article: bool
    linked: bool


@dataclass(frozen=True)
class Node:
    """One text node: its path, innermost container, block, and how it is judged."""

    path: int
    box: int
    block: int
    open: bool
    doubt: int
    linked: bool
    text: str
    bare: str


class Page:
    """The text nodes of a page in order, its paths and its containers."""

    def __init__(self, page: str) -> None:
        self.nodes: list[Node] = []
        self.paths: dict[tuple[int, str], int] = {}
        # per path: whether it leads through a heading, through an article
        self.in_heading, self.in_article = [False], [False]
        # per container: the one around it, its depth, whether it is meant for the text
        self.parents, self.depths, self.content, self.tags = [-1], [0], [False], [""]
        self.doubts = 0
        self.block = 0
        self.stack = [Element("", 0, 0, True, 0, False, False)]
        self.opened: Counter[str] = Counter()
        self.read(page)

    def read(self, page: str) -> None:
        at = 0
        for start, end, name, tag in tokens(page):
            if start > at:
                self.add(page[at:start])
            at = end
            if name:
                self.element(name, tag)
        if at < len(page):
            self.add(page[at:])

    def add(self, raw: str) -> None:
        text = html.unescape(raw)
        if text:
            e = self.stack[-1]
            self.nodes.append(Node(e.path, e.box, self.block, e.wanted, e.doubt, e.linked, text, text.strip()))

    def cut(self, place: int) -> None:
        for e in self.stack[place:]:
            self.opened[e.name] -= 1
        del self.stack[place:]

    def close(self, names: set[str]) -> None:
        """End the innermost open element of these names, unless a barrier is between."""
        if not any(self.opened[n] for n in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name in names:
                self.cut(i)
                return
            if self.stack[i].name in BARRIERS:
                return

    def element(self, name: str, tag: str) -> None:
        if name.lstrip("/") not in INLINE:
            self.block += 1
        if name[0] == "/":
            if self.opened[name[1:]]:
                place = len(self.stack) - 1
                while self.stack[place].name != name[1:]:
                    place -= 1
                self.cut(place)
            return
        if name in ENDS_PARAGRAPH:
            self.close({"p"})
        if name in CLOSES:
            self.close(CLOSES[name])
        if name in VOID or tag.endswith("/>"):
            return
        around = self.stack[-1]
        path = around.path
        if name not in INLINE or name == "a":
            path = self.paths.setdefault((around.path, name), len(self.in_heading))
            if path == len(self.in_heading):
                self.in_heading.append(self.in_heading[around.path] or name in HEADINGS)
                self.in_article.append(self.in_article[around.path] or name in ("article", "main"))
        box = around.box
        holds = False
        if name in CONTAINERS:
            holds = holds_content(tag, name)
            box = len(self.parents)
            self.parents.append(around.box)
            self.depths.append(self.depths[around.box] + 1)
            self.content.append(holds)
            self.tags.append(name)
        verdict = judged(tag, name, around.article)
        doubt = around.doubt
        if verdict == DOUBTFUL and not doubt:
            self.doubts += 1
            doubt = self.doubts
        self.opened[name] += 1
        self.stack.append(
            Element(
                name,
                path,
                box,
                around.wanted and verdict != UNWANTED,
                doubt,
                around.article or name in ("article", "main") or holds,
                around.linked or name == "a",
            )
        )


def tokens(page: str) -> Iterator[tuple[int, int, str, str]]:
    """Start, end, lower-case name (with a slash for end tags, or empty) and text of each tag.

    A quoted value belongs to its tag if an equals sign is before it and the quote ends.
    """
    at = 0
    last_quote = {q: page.rfind(q) for q in "\"'"}
    last_end = page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield start, at, "", ""
            continue
        closing = page.startswith("/", start + 1)
        named = NAME.match(page, start + 1 + closing)
        if not named and page[start + 1 : start + 2] not in ("!", "?"):
            at = start + 1
            continue
        if last_end < start:
            return
        end = start
        while True:
            stop = STOP.search(page, end + 1)
            if not stop:
                return
            end = stop.start()
            if stop.group() == ">":
                break
            # a value in quotes
            if named and last_quote[stop.group()] > end and page[start:end].rstrip()[-1:] == "=":
                end = page.find(stop.group(), end + 1)
        at = end + 1
        if not named:
            yield start, at, "", ""
            continue
        name = named.group().lower()
        if not closing and name in RAW and page[end - 1] != "/":
            ending = RAW_END[name].search(page, at)
            at = ending.end() if ending else len(page)
            yield start, at, "", ""
            continue
        yield start, at, "/" + name if closing else name, page[start : end + 1]


RAW_END = {name: re.compile(f"</{name}\\s*>", re.I) for name in RAW}


def judged(tag: str, name: str, inside_article: bool) -> int:
    """Whether an element is a part of the page beside its main text, or may be one."""
    if name in SKIPPED or (name == "header" and not inside_article):
        return UNWANTED
    out = WANTED
    for key, value in LABEL.findall(tag[len(name) + 1 :]):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden":
            return UNWANTED
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return UNWANTED
        elif key == "aria-hidden":
            if value == "true":
                return UNWANTED
        elif name not in ("html", "body", "article", "main") and name not in HEADINGS:
            found = set(re.split(r"[\s_:-]+", value))
            if not found & NAMES or (found & CONTENT_NAMES and not found & NEVER_CONTENT):
                continue
            if not inside_article:
                return UNWANTED
            if name in BLOCKS:
                # an id is a place to jump to, and sections are named by what they are about
                whole = set(value.split()) & NAMES and not (key == "id" and name == "section")
                if whole:
                    return UNWANTED
                out = DOUBTFUL
    return out


def holds_content(tag: str, name: str) -> bool:
    """Whether a container is meant for the main text."""
    if name in ("article", "main"):
        return True
    if name in ("html", "body"):
        return False
    for key, value in LABEL.findall(tag[len(name) + 1 :]):
        if key.lower() in ("class", "id", "role"):
            found = set(re.split(r"[\s_:-]+", value.strip("\"'").lower()))
            if found & CONTENT_NAMES and not found & NAMES:
                return True
    return False


class _Marks(dict):
    """Whether a character is punctuation, looked up once each."""

    def __missing__(self, c: str) -> bool:
        self[c] = found = not c.isalnum() and unicodedata.category(c)[0] == "P"
        return found


MARKS = _Marks()


def punctuation(text: str) -> int:
    return sum(map(MARKS.__getitem__, text))


def smoothed(values: np.ndarray) -> np.ndarray:
    """A small Gaussian over neighbouring paths, weights of existing ones adding up to 1."""
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    spread = np.convolve(values, kernel, "full")[2 : 2 + len(values)]
    return spread / np.convolve(np.ones(len(values)), kernel, "full")[2 : 2 + len(values)]


def sums(nodes: list[Node], keys: list[int], size: int) -> np.ndarray:
    """Length of text, punctuation and number of nodes per key; text of links counts less."""
    out = np.zeros((3, size))
    for n, k in zip(nodes, keys, strict=True):
        out[0, k] += len(n.bare) * (0.2 if n.linked else 1.0)
        out[1, k] += 1 + punctuation(n.bare)
        out[2, k] += 1
    out[2] = np.maximum(out[2], 1)
    return out


def path_scores(page: Page, nodes: list[Node]) -> dict[int, float]:
    """Fused ratio of each path: smoothed text ratio times smoothed punctuation ratio."""
    order: dict[int, int] = {}
    for n in nodes:
        order.setdefault(n.path, len(order))
    size, marks, count = sums(nodes, [order[n.path] for n in nodes], len(order))
    fused = np.sqrt(smoothed(size / count) * (size / count)) * smoothed(marks / count)
    prior = np.array([PRIOR if page.in_article[p] else 1.0 for p in order])
    return dict(zip(order, fused * prior, strict=True))


def without_doubtful(page: Page, nodes: list[Node], scores: dict[int, float]) -> list[Node]:
    """Blocks of an article with a doubtful name stay if their own ratios are high enough."""
    if not page.doubts:
        return nodes
    size, marks, count = sums(nodes, [n.doubt for n in nodes], page.doubts + 1)
    own = size / count * (marks / count)
    sure = [n for n in nodes if not n.doubt and scores[n.path] >= THRESHOLD * max(scores.values())]
    if not sure:
        return nodes
    total, points, many = sums(sure, [0] * len(sure), 1)[:, 0]
    least = DOUBT * total / many * (points / many)
    return [n for n in nodes if not n.doubt or own[n.doubt] >= least]


def content_nodes(page: Page) -> list[Node]:
    """Nodes above the threshold, their headings, and the rest of the container around them."""
    candidates = [n for n in page.nodes if n.open and n.bare]
    if not candidates:
        return []
    scores = path_scores(page, candidates)
    candidates = without_doubtful(page, candidates, scores)
    least = THRESHOLD * max(scores[n.path] for n in candidates)
    above = {id(n) for n in candidates if scores[n.path] >= least}
    # containers come after those around them: weights go up from the last to the first
    boxes = len(page.parents)
    weight, total = [0.0] * boxes, 0.0
    for n in candidates:
        if id(n) in above:
            worth = len(n.bare) * (PRIOR if page.in_article[n.path] else 1.0)
            total += worth
            weight[n.box] += worth
    for b in range(boxes - 1, 0, -1):
        weight[page.parents[b]] += weight[b]
    covering = [b for b in range(1, boxes) if weight[b] and weight[b] >= COVER * total]
    if not covering:
        return candidates
    root = max(covering, key=lambda b: (page.depths[b], -b))
    kept, before_content = set(above), False
    for n in reversed(candidates):
        if not page.in_heading[n.path]:
            before_content = id(n) in above
        elif before_content and (not n.box or weight[n.box]):
            kept.add(id(n))

    def inside(outer: int) -> list[bool]:
        found = [False] * boxes
        for b in range(1, boxes):
            found[b] = b == outer or found[page.parents[b]]
        return found

    within = inside(root)
    beside = [False] * boxes
    for n in candidates:
        if id(n) in kept and not within[n.box]:
            beside[n.box] = True
    for b in range(boxes - 1, 0, -1):
        beside[page.parents[b]] |= beside[b]
    chain, b = [], page.parents[root]
    while b > 0:
        chain.append(b)
        b = page.parents[b]
    wider = next((b for b in reversed(chain) if page.content[b] and beside[b]), root)
    within = inside(wider)
    return [n for n in candidates if id(n) in kept or within[n.box]]


def main_text(source: str | None) -> str:
    page = Page(source or "")
    kept = {id(n) for n in content_nodes(page)}
    blocks: dict[int, list[str]] = {}
    for n in page.nodes:
        if id(n) in kept or (n.open and not n.bare and n.block in blocks):
            blocks.setdefault(n.block, []).append(n.text)
    return " ".join(filter(None, (" ".join("".join(b).split()) for b in blocks.values())))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    schema = "page_id long, url string, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
