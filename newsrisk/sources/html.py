"""Reading list items out of one HTML page: the only Python-side step of the package.

The page becomes a flat list of nodes in document order, so that no amount of unclosed
nesting recurses.  Selectors have the form ``tag.class.class descendant`` (comma-separated
alternatives, ``[attr]`` allowed).  Everything after it - dates, cuts, filters, rejects -
happens in Spark columns.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

# Elements that never have content, and elements whose content is not text.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN = frozenset(("script", "style", "template"))
NONE: frozenset[str] = frozenset()


class Element:
    """A start tag; its content is ``nodes[start + 1 : end]``."""

    __slots__ = ("tag", "attrs", "classes", "parent", "nodes", "start", "end", "page")

    def __init__(self, tag, attrs, parent, nodes):
        self.tag = tag
        self.attrs = {k: v or "" for k, v in attrs} if attrs else {}
        self.classes = frozenset(self.attrs["class"].split()) if "class" in self.attrs else NONE
        self.parent, self.nodes = parent, nodes
        self.start = len(nodes)
        self.end = self.start + 1
        self.page: _Page | None = None  # at the root only
        nodes.append(self)

    def text(self) -> str:
        parts, skip_to = [], 0
        for i in range(self.start + 1, self.end):
            node = self.nodes[i]
            if isinstance(node, Element):
                if node.tag in HIDDEN and i >= skip_to:
                    skip_to = node.end
            elif i >= skip_to:
                parts.append(node.strip())
        return "".join(parts)

    def ancestor(self, tag: str) -> Element | None:
        return _page(self).nearest(tag)[self.start]


class _TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[Element | str] = []
        self.root = self.open = Element("", (), None, self.nodes)
        self.by_tag: dict[str, list[Element]] = {}  # the open elements of each tag
        self.text: list[str] = []  # the pieces of the last node while more text continues it

    def updatepos(self, i, j):
        return j  # line numbers are not needed, and counting them costs a fifth of the parse

    def _end_text(self):
        if self.text:
            self.nodes[-1] = "".join(self.text)
            self.text = []

    def handle_starttag(self, tag, attrs):
        self._end_text()
        node = Element(tag, attrs, self.open, self.nodes)
        if tag not in VOID:
            self.open = node
            self.by_tag.setdefault(tag, []).append(node)

    def handle_startendtag(self, tag, attrs):
        self._end_text()
        Element(tag, attrs, self.open, self.nodes)

    def handle_endtag(self, tag):
        self._end_text()
        if starts := self.by_tag.get(tag):  # an end tag without a start tag is ignored
            self._close(starts[-1].parent)

    def _close(self, until):
        # Every element is closed once, so all end tags together cost one walk.
        while self.open is not until:
            self.open.end = len(self.nodes)
            if self.open is not self.root:
                self.by_tag[self.open.tag].pop()
            self.open = self.open.parent

    def handle_comment(self, data):
        self._end_text()

    def handle_data(self, data):
        if not self.text:
            self.nodes.append("")
        self.text.append(data)

    def finish(self) -> Element:
        self.close()
        self._end_text()
        self._close(None)
        return self.root


class _Page:
    """What whole-document walks have found, so that no item walks for itself."""

    def __init__(self, nodes: list):
        self.elements = [n for n in nodes if isinstance(n, Element)]
        self.size = len(nodes)
        self.found: dict[str, tuple[list[Element], list[int]]] = {}
        self.above: dict[str, list] = {}

    def nearest(self, tag: str) -> list:
        """For the place of each element its closest ancestor with ``tag``."""
        if tag not in self.above:
            out: list = [None] * self.size
            for node in self.elements:
                if (up := node.parent) is not None:
                    out[node.start] = up if up.tag == tag else out[up.start]
            self.above[tag] = out
        return self.above[tag]

    def all(self, selector: str) -> tuple[list[Element], list[int]]:
        """The elements that match, in document order, and their places."""
        if selector not in self.found:
            hits = {}
            for chain in _compile(selector):
                # How many leading parts of the chain the ancestors satisfy, element by element.
                depth, last = [0] * self.size, len(chain) - 1
                for node in self.elements:
                    above = depth[node.parent.start] if node.parent is not None else 0
                    depth[node.start] = above + (above < last and _is(node, chain[above]))
                    if above == last and node.parent is not None and _is(node, chain[last]):
                        hits[node.start] = node
            places = sorted(hits)
            self.found[selector] = [hits[i] for i in places], places
        return self.found[selector]


def _page(node: Element) -> _Page:
    root = node.nodes[0]
    if root.page is None:
        root.page = _Page(node.nodes)
    return root.page


# Plain markup, which one pattern cuts into text and tags: an end tag, or a start tag whose
# attributes are quoted and hold no references.
_TAG = re.compile(
    r"<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)"
    r"((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9_-]*(?:=(?:\"[^\"<>&]*\"|'[^'<>&]*'))?)*+)[ \t\n]*(/?))>"
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][a-zA-Z0-9_-]*)(?:=(?:\"([^\"]*)\"|'([^']*)'))?")
# Elements whose content the standard parser reads by rules of its own.
RAW = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript plaintext svg math".split()
)


@lru_cache(maxsize=4096)
def _attributes(text: str) -> list[tuple[str, str]]:
    return [(name.lower(), double or single) for name, double, single in _ATTRIBUTE.findall(text)]


def _parse_plain(html: str) -> Element | None:
    """The tree the standard parser gives, made several times as fast; None if the page has
    markup that is not plain."""
    if "<!" in html or "<?" in html:
        return None
    parts = _TAG.split(html)
    builder = _TreeBuilder()
    nodes, void = builder.nodes, VOID
    for i in range(0, len(parts), 5):
        if text := parts[i]:
            if "<" in text:
                return None
            nodes.append(unescape(text) if "&" in text else text)
        if i + 1 == len(parts):
            break
        closed, opened, attributes, empty = parts[i + 1 : i + 5]
        if closed is not None:
            builder.handle_endtag(closed.lower())
            continue
        tag = opened.lower()
        if tag in RAW:
            return None
        node = Element(tag, _attributes(attributes) if attributes else (), builder.open, nodes)
        if not empty and tag not in void:
            builder.open = node
            builder.by_tag.setdefault(tag, []).append(node)
    builder._close(None)
    return builder.root


def parse(html: str) -> Element:
    """Root of a parsed page; unclosed and stray tags are tolerated."""
    if (root := _parse_plain(html)) is not None:
        return root
    builder = _TreeBuilder()
    builder.feed(html)
    return builder.finish()


def release(root: Element) -> None:
    """Cut the cycles of a page that is read, so that it goes at once and not in a collection."""
    root.page = None
    root.nodes.clear()


_COMPILED: dict[str, tuple] = {}  # per worker; there are as many as layouts have selectors


def _compile(selector: str) -> tuple:
    if selector in _COMPILED:
        return _COMPILED[selector]
    alternatives = []
    for part in selector.split(","):
        chain = []
        for simple in part.split():
            tag = re.match(r"[A-Za-z0-9]*", simple).group(0).lower()
            classes = frozenset(re.findall(r"\.([\w-]+)", simple))
            attrs = tuple(re.findall(r"\[([\w-]+)\]", simple))
            chain.append((tag, classes, attrs))
        alternatives.append(tuple(chain))
    _COMPILED[selector] = tuple(alternatives)
    return _COMPILED[selector]


def _is(node: Element, simple) -> bool:
    tag, classes, attrs = simple
    return (
        (not tag or node.tag == tag)
        and classes <= node.classes
        and (not attrs or all(a in node.attrs for a in attrs))
    )


def matches(root: Element, selector: str) -> Iterator[Element]:
    """Descendants that match, in document order.

    All parts of the selector may lie above ``root``, except the last one.
    """
    found, places = _page(root).all(selector)
    for i in range(bisect_right(places, root.start), len(found)):
        if places[i] >= root.end:
            return
        yield found[i]


def select(root: Element, selector: str) -> list[Element]:
    """All descendants that match, in document order."""
    return list(matches(root, selector))


def select_one(root: Element, selectors: tuple[str, ...]) -> Element | None:
    """First match of the first selector that matches anything."""
    for selector in selectors:
        for node in matches(root, selector):
            return node
    return None
