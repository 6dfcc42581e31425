"""The main text of web pages, by scoring the page's tree.

Paragraphs pass points for their length and commas to their ancestors; an ancestor's sum is discounted
by the share of its text that stands in links. The best container is kept with the siblings that look
like it, and its blocks are joined in page order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
# Never part of an article. The first stand inside a line, so what is around them stays one block.
DROPPED_INSIDE = frozenset(
    "script style template noscript iframe object embed svg math canvas audio video map button input select "
    "textarea option noembed noframes link meta".split()
)
DROPPED = DROPPED_INSIDE | frozenset("head title nav footer aside form dialog menu".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar dialog alert alertdialog toolbar".split()
)
# Words of class and id that name what stands beside an article.
COMMENTS = frozenset("comment comments respond replies reply disqus discussion".split())
ASIDE = COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner nav navbar "
    "navigation menu menus breadcrumb breadcrumbs masthead topbar footer foot copyright sidebar aside rail widget "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "paywall share sharing social related recommended recommendations pager pagination toolbar skip".split()
)
HEADER = frozenset(("header", "head"))
# Words that say an element belongs to the article, unless one of the second list says otherwise.
OWN, NOT_OWN = frozenset("article post entry story".split()), COMMENTS | {"related", "ad", "ads", "share"}
# A start tag ends open elements of these names ...
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"),
    "tfoot": ("tr", "td", "th", "thead", "tbody"),
}
# ... but none beyond one of these; other end tags do not reach beyond a cell.
SCOPE = frozenset("ul ol dl table select body html article section div main".split())
CELL, TABLE = frozenset("td th caption table".split()), frozenset("table thead tbody tfoot tr td th caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td th dd dt li figcaption".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
# A tag with a quote that is never closed ends at the next bracket.
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMA = re.compile(r"[,，、،]")
_SENTENCE_END = re.compile(r"[.!?。][\"'”»)]*$")


# --- The tree ------------------------------------------------------------------------------------


@dataclass(slots=True)
class Node:
    """An element; a page's elements lie in one list in the order of their start tags."""

    name: str
    parent: int
    marks: frozenset[str] = frozenset()  # words of class and id
    role: str = ""
    hidden: bool = False
    dropped: bool = False
    holds: bool = False  # an article or main element is here or below
    points: float = 0.0
    length: int = 0  # characters of text here and below
    linked: int = 0  # of these, inside links

    @property
    def semantic(self) -> bool:
        return (self.name in ("article", "main") or self.role in ("article", "main")) and not self.marks & COMMENTS


@dataclass
class Page:
    """Elements, and in page order the pieces of text: (element, text), or (element, None) where a block ends."""

    nodes: list[Node]
    pieces: list[tuple[int, str | None]]


def _marked(attributes: str) -> tuple[frozenset[str], str, bool]:
    words, role, hidden = set(), "", False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name in ("class", "id"):
            words.update(_WORD.findall(f"{value} {_CAMEL.sub(' ', value)}".lower()))
        elif name == "role":
            role = value.strip().lower()
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style":
            hidden = hidden or bool(_UNSEEN.search(value))
    return frozenset(words), role, hidden


class Builder:
    """Reads a page; missing end tags are implied, stray ones ignored."""

    def __init__(self) -> None:
        self.nodes = [Node("html", -1)]
        self.pieces: list[tuple[int, str | None]] = []
        self.at = 0
        self.body = False

    def text(self, value: str) -> None:
        if value:
            self.pieces.append((self.at, unescape(value)))

    def cut(self, node: int) -> None:
        name = self.nodes[node].name
        if name not in INLINE and name not in DROPPED_INSIDE:
            self.pieces.append((node, None))

    def leave(self, node: int) -> None:
        """Close elements up to and with this one."""
        while self.at != node:
            self.cut(self.at)
            self.at = self.nodes[self.at].parent
        self.cut(node)
        self.at = self.nodes[node].parent

    def start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and (name == "html" or self.body):
            return
        self.imply(name)
        self.body = self.body or name == "body"
        self.nodes.append(Node(name, self.at, *(_marked(attributes) if attributes.strip(" /\n\t") else ())))
        own = len(self.nodes) - 1
        self.cut(own)
        if name == "br":
            self.pieces.append((own, " "))
        elif name not in VOID:
            self.at = own

    def imply(self, name: str) -> None:
        """End the elements that a start tag ends."""
        nodes = self.nodes
        if name == "body" and self.at:
            at = self.at
            while nodes[at].parent > 0:
                at = nodes[at].parent
            self.leave(at)
        elif name not in INLINE and name not in DROPPED_INSIDE:
            # A block ends an open paragraph, and inline elements left open in it.
            at = self.at
            while at and nodes[at].name in INLINE:
                at = nodes[at].parent
            if nodes[at].name == "p" or (nodes[at].name in HEADINGS and name in HEADINGS):
                self.leave(at)
        if name in CLOSES:
            at, last = self.at, None
            while at and (nodes[at].name in CLOSES[name] or nodes[at].name not in SCOPE):
                if nodes[at].name in CLOSES[name]:
                    last = at
                at = nodes[at].parent
            if last is not None:
                self.leave(last)

    def end(self, name: str) -> None:
        wanted = HEADINGS if name in HEADINGS else (name,)
        at = self.at
        while at and self.nodes[at].name not in wanted:
            over = self.nodes[at].name
            if (name in INLINE and over not in INLINE) or (over in CELL and name not in TABLE):
                return
            at = self.nodes[at].parent
        if at:
            self.leave(at)


def parsed(html: str) -> Page:
    build, place = Builder(), 0
    while (at := html.find("<", place)) >= 0:
        found = _TAG.match(html, at) or _LOOSE_TAG.match(html, at)
        if found is None:
            build.text(html[place : at + 1])
            place = at + 1
            continue
        build.text(html[place:at])
        place = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            build.end(name)
            continue
        build.start(name, found[3])
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, place)
            place = end.end() if end else len(html)
            build.end(name)
    build.text(html[place:])
    return Page(build.nodes, build.pieces)


# --- What does not belong ------------------------------------------------------------------------


def _beside(node: Node, in_article: bool) -> bool:
    """Whether an element stands beside the article, by its name, role, or words of class and id."""
    if node.name == "body":
        return False
    if node.hidden or node.role in ROLES or (node.name in DROPPED and not (node.name == "form" and node.holds)):
        return True
    if node.name == "header":
        # The header of an article is its title; that of a page is not.
        return not in_article and not node.holds
    if node.name in INLINE and node.name != "span":
        return False
    aside = node.marks & ASIDE or (node.marks & HEADER and not in_article)
    if not aside or (node.name in HEADINGS and in_article) or (node.marks & OWN and not node.marks & NOT_OWN):
        return False
    return not node.holds or bool(node.marks & COMMENTS)


def prune(page: Page) -> None:
    nodes = page.nodes
    for node in reversed(nodes[1:]):
        node.holds = node.holds or node.semantic
        # What lies in a list of comments is no article of the page.
        if node.holds and not (node.marks & COMMENTS):
            nodes[node.parent].holds = True
    inside = [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        above = nodes[node.parent]
        node.dropped = above.dropped or _beside(node, inside[node.parent])
        inside[i] = inside[node.parent] or node.semantic


# --- Points --------------------------------------------------------------------------------------


def density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def worth(node: Node) -> float:
    return node.points * (1 - density(node))


def score(page: Page) -> list[str]:
    """Lengths and points of all elements; returns each element's own text (that of blocks inside it excepted).

    A paragraph gives a point, one for each comma, and up to three for its length, less the share of its
    links: whole to its parent, half to the next ancestor, then by thirds of the level further up.
    """
    nodes = page.nodes
    home, linked = [0] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        home[i] = home[node.parent] if node.name in INLINE else i
        linked[i] = linked[node.parent] or node.name == "a"
    held: list[list[str]] = [[] for _ in nodes]
    own_linked = [0] * len(nodes)
    for i, text in page.pieces:
        if text is None or nodes[i].dropped:
            continue
        held[home[i]].append(text)
        n = len(" ".join(text.split()))
        nodes[i].length += n
        if linked[i]:
            nodes[i].linked += n
            own_linked[home[i]] += n
    for node in reversed(nodes[1:]):
        above = nodes[node.parent]
        above.length += node.length
        above.linked += node.linked
    texts = [" ".join("".join(parts).split()) for parts in held]
    for i, (node, own) in enumerate(zip(nodes, texts, strict=True)):
        if not own or node.name in HEADINGS:
            continue
        free = 1 - min(1.0, own_linked[i] / len(own))
        points = (1 + len(_COMMA.findall(own)) + min(len(own) / 100, 3)) * free
        # Loose text of a container counts for the container itself.
        at, level = (node.parent, 0) if node.name in PARAGRAPHS and node.parent >= 0 else (i, 0)
        while at >= 0 and level < 5:
            nodes[at].points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = nodes[at].parent, level + 1
    return texts


def best_container(nodes: list[Node]) -> int | None:
    """The element of most points; where it lies inside an article or main element, that one."""
    best, most = None, 0.0
    for i, node in enumerate(nodes):
        if not node.dropped and node.name not in INLINE and node.name not in PARAGRAPHS and worth(node) > most:
            best, most = i, worth(node)
    if best is None:
        # Nothing but headings and links.
        return next((i for i, node in enumerate(nodes) if node.semantic and not node.dropped), None)
    at = best
    while at >= 0:
        if nodes[at].semantic:
            return at
        at = nodes[at].parent
    return best


def _belongs(node: Node, own: str, best: Node) -> bool:
    """Whether a sibling of the best container is part of the article, too."""
    if node.dropped or not node.length or node.name in INLINE:
        return False
    if node.name in HEADINGS:
        return density(node) < 0.5
    if worth(node) > 0 and (worth(node) >= 0.2 * worth(best) or (best.marks and node.marks == best.marks)):
        return True
    return node.name == "p" and density(node) < 0.25 and (len(own) > 80 or bool(_SENTENCE_END.search(own)))


def main_text(html: str) -> str:
    """The blocks of the main text, white space inside each as one space, joined by line feeds."""
    page = parsed(html)
    nodes = page.nodes
    prune(page)
    own = score(page)
    best = best_container(nodes)
    kept = [False] * len(nodes)
    if best is None or best == 0:
        kept[0] = True
    else:
        kept[best] = True
        if not nodes[best].semantic and nodes[best].name != "body":
            for i, node in enumerate(nodes):
                if node.parent == nodes[best].parent and i != best:
                    kept[i] = _belongs(node, own[i], nodes[best])
    for i, node in enumerate(nodes[1:], 1):
        kept[i] = not node.dropped and (kept[i] or kept[node.parent])
    blocks, line = [], []
    for i, text in page.pieces:
        if text is None:
            if line:
                blocks.append(" ".join("".join(line).split()))
                line = []
        elif kept[i]:
            line.append(text)
    blocks.append(" ".join("".join(line).split()))
    return "\n".join(b for b in blocks if b)


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html or "") for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ], schema=_SCHEMA)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points of the text).

    The text is the article without menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
    styles and reader comments. Character references are decoded; a block is what stands between
    starts and ends of block elements, its white space becomes single spaces; blocks are joined by line feeds.
    A null or empty page, or one without text, gives ''. Rows are handled one by one, whole, so repeated
    rows and nulls in page_id or url need no rule; a page of many megabytes is one task's memory (many
    times its size). Other columns are ignored; an empty table gives no rows.
    """
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), "html")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
