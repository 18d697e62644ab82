"""Main text of web pages by composite text density.

Each page is parsed to a node tree. Elements that can't be article text by
their kind (scripts, navigation, forms ...) are taken out, then those that a
name marks (adverts, related pages, comments ...): containers with a small
share of the page's text, never headings, paragraphs or what holds the densest
subtree. Comments go whatever their share, as long as other text is left.
Every remaining node gets its composite density: characters per tag, adjusted
by the share of link characters and link tags and by the page's link share.
The subtree whose children's densities sum highest is the article; the lowest
density on its path to ``body`` is the threshold from which other parts of the
page are taken as well. Where the winner lies in an ``article`` or ``main``, the
innermost of these is the winner as a whole, and only the outermost is searched
for other parts. Headings right before the article are taken with it.

Pages are independent: one pass over the rows, no shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTED = "page_id long, url string, text string, n_chars long"

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "legend"}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tbody", "thead", "tr", "td", "th"}, "thead": {"tbody", "tr", "td", "th"},
    "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}} | dict.fromkeys(
    ("tr", "td", "th", "tbody", "thead", "tfoot"), {"table"})
DROPPED = set(
    "head script style noscript template title nav footer aside form button select option textarea"
    " iframe object svg canvas audio video map menu dialog".split()
)
DROPPED_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
DROPPED_NAMES = set(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion"
    " banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe"
    " subscription sidebar aside widget widgets related recommended recommendations share sharing social"
    " breadcrumb breadcrumbs nav navbar navigation menu topbar footer masthead"
    " reactions pagination pager toolbar login signup search skip".split()
)
COMMENTS = set("comment comments commentlist discussion discussions disqus replies reply respond".split())
#: A name with one of these tells of another element: has-sidebar, comments-open.
MODIFIERS = set("has with without no is open closed enabled disabled".split())
#: Elements that no name takes out.
PROSE = set("html body main p h1 h2 h3 h4 h5 h6 blockquote pre".split())
SHARE = 0.3
OTHER_CHARS = 50
HEADINGS = {"h1", "article", "main"}
TITLES = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_NAMES = re.compile(r"[a-z0-9]+").findall
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden").search


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "named", "anchor", "talk", "chars", "link_chars", "tags",
                 "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.drop = self.named = self.anchor = self.talk = False
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


class Tree(HTMLParser):
    """Node tree with the implied end tags of paragraphs, list items and cells."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("html", None)
        #: Open elements below the root, and where each kind stands among them: no tag climbs the tree.
        self.path: list[Node] = []
        self.places: dict[str, list[int]] = {}

    def _innermost(self, tags: set[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _pop_to(self, depth: int) -> None:
        while len(self.path) > depth:
            self.places[self.path.pop().tag].pop()
        self.open = self.path[-1] if self.path else self.root

    def _close_to(self, tags: set[str], scope: set[str]) -> None:
        found = self._innermost(tags)
        if found > self._innermost(scope):
            self._pop_to(found)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in CLOSES_P:
            self._close_to({"p"}, {"table", "td", "th", "button", "object"})
        if tag in CLOSED_BY:
            scope = SCOPE[tag]
            while True:
                before = self.open
                self._close_to(CLOSED_BY[tag], scope)
                if self.open is before:
                    break
        node = Node(tag, self.open)
        self.open.children.append(node)
        if attrs:
            self._mark(node, attrs)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.path))
            self.path.append(node)
            self.open = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash means nothing in HTML

    def _mark(self, node: Node, attrs: list) -> None:
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id"):
                if node.tag in PROSE:
                    continue
                for parts in map(_NAMES, value.split()):
                    if MODIFIERS.isdisjoint(parts):
                        node.talk |= not COMMENTS.isdisjoint(parts)
                        if not DROPPED_NAMES.isdisjoint(parts):
                            # A section's id is a link's aim as a rule, made from its heading.
                            node.anchor |= node.tag == "section" and name == "id"
                            node.named |= node.tag != "section" or name == "class"
            elif name == "role":
                node.drop |= value.strip() in DROPPED_ROLES
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                node.drop = True
            elif name == "style" and _HIDDEN(value):
                node.drop = True

    def handle_endtag(self, tag: str) -> None:
        if self.places.get(tag):
            self._pop_to(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        self.open.children.append(data)


def _in_order(root: Node) -> list[Node]:
    """Parents before their children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    return order


def _measure(root: Node) -> list[Node]:
    """Characters, link characters, tags and link tags of every subtree."""
    order = _in_order(root)
    for node in reversed(order):
        node.chars = node.link_chars = node.tags = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            else:
                node.chars += child.chars
                node.tags += 1 + child.tags
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars = node.chars
            node.link_tags += 1
    return order


def _plain(node: Node) -> int:
    return node.chars - node.link_chars


def _path(node: Node, root: Node) -> list[Node]:
    path = [node]
    while path[-1] is not root:
        path.append(path[-1].parent)
    return path


def _best(order: list[Node], root: Node) -> Node:
    """The node whose children's densities sum highest."""
    best = max((n for n in order if n.tag not in VOID), key=lambda n: n.total)
    return best if best.total > 0 else root


def _without_boilerplate(root: Node, share: float) -> None:
    """Take out elements that their kind, role or name marks as no article text."""
    order = _in_order(root)
    headed: set[int] = set()
    for node in reversed(order):
        if node.tag in HEADINGS and not node.talk or any(isinstance(c, Node) and id(c) in headed for c in node.children):
            headed.add(id(node))
    inside: set[int] = set()
    for node in order:
        if node.tag in ("article", "main") or node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))

    def gone(node: Node) -> bool:
        within = id(node) in inside
        if node.tag in ("html", "body", "article", "main"):
            return node.drop and node.tag in ("article", "main")
        if node.tag == "form" and not node.drop and (id(node) in headed or 2 * _plain(node) > _plain(root)):
            return False  # a form around the whole page
        if node.drop or node.tag in DROPPED or node.tag == "header" and not within:
            return True
        return (
            node.tag in ("ul", "ol", "table") and node.link_tags > 2 and node.link_chars > 0.9 * node.chars)

    for node in order:
        node.children = [c for c in node.children if isinstance(c, str) or not gone(c)]
    order = _measure(root)
    talk = [n for n in order if n.talk and id(n) not in headed and _plain(root) - _plain(n) >= OTHER_CHARS]
    for node in talk:
        node.parent.children = [c for c in node.parent.children if c is not node]
    if not any(n.named or n.anchor for n in order):
        return
    order = _densities(root, share)
    held = {id(n) for n in _path(_best(order, root), root)}

    def marked(node: Node) -> bool:
        if id(node) in headed or id(node) in held or node.tag in ("article", "main"):
            return False
        return node.named and _plain(node) <= SHARE * _plain(root) or node.anchor and node.link_chars > 0.5 * node.chars

    for node in order:
        node.children = [c for c in node.children if isinstance(c, str) or not marked(c)]


def _densities(root: Node, share: float) -> list[Node]:
    order = _measure(root)
    for node in reversed(order):
        plain = max(node.chars - node.link_chars, 1)
        links, link_tags, tags = max(node.link_chars, 1), max(node.link_tags, 1), max(node.tags, 1)
        if node.chars:
            base = math.log(math.log(node.chars / plain * node.link_chars + share * node.chars + math.e))
            gain = max(math.log(node.chars / links * tags / link_tags), 0.0)
            node.density = node.chars / tags * gain / max(base, 0.1)
        node.total = sum(c.density for c in node.children if isinstance(c, Node))
    return order


def _text(nodes: list[Node]) -> str:
    """Text of the subtrees in page order, blocks apart, white space collapsed."""
    parts: list[str] = []
    stack: list = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        if item.tag in BLOCK:
            parts.append(" ")
            stack.append(" ")
        stack.extend(reversed(item.children))
    return " ".join("".join(parts).split())


def main_text(html: str) -> str:
    """The article of one page; empty if there is none."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    root = next((n for n in _in_order(tree.root) if n.tag == "body"), tree.root)
    _measure(root)
    share = root.link_chars / max(root.chars, 1)
    _without_boilerplate(root, share)
    order = _densities(root, share)
    if not root.chars:
        return ""
    best = _best(order, root)
    path = _path(best, root)
    marked = [n for n in path if n.tag in ("article", "main")]
    whole = root if not marked else marked[-1]
    if marked:
        best = marked[0]
        path = _path(best, root)
    return _text(_picked(best, path[: path.index(whole) + 1]))


def _picked(best: Node, path: list[Node]) -> list[Node]:
    """The winner and, in page order, what else of the outermost node of its path is article text.

    That is whatever is as dense as the least dense node of the path, and the
    headings that lead up to a node of the path.
    """
    threshold, on_path, titles = min(n.density for n in path), {id(n) for n in path}, set()
    for node, above in zip(path, path[1:]):
        below = [c for c in above.children if isinstance(c, Node)]
        at = next(i for i, c in enumerate(below) if c is node)
        while at and below[at - 1].tag in TITLES:
            at -= 1
            titles.add(id(below[at]))
    picked, stack = [], [path[-1]]
    while stack:  # page order: a node, then its children from the first
        node = stack.pop()
        dense = id(node) not in on_path and node.chars and node.density >= threshold
        if node is best or dense or id(node) in titles:
            picked.append(node)
        else:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return picked


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html).

    Null html counts as empty and gives an empty text; null ids and urls are
    kept; repeated rows are extracted each; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(run, EXTRACTED)
