"""Per-page element list used inside the page-facts functions.

A page becomes one list of nodes in document order. Each node knows its parent and the index
just past its last descendant, so "everything below X" is a slice. Only what the extraction
rules need is here: no selector language.

Tree rules: void elements close themselves, nothing closes implicitly, an end tag closes up to
the nearest open element of that name and is ignored when there is none.

Reading markup is most of the cost of a crawl job, so regular markup is cut by one pattern and
attributes are read only when asked for. A page with anything irregular (stray ``<``, unclosed
quotes, odd comments) goes through the standard library's tolerant parser instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

# Element names that never have content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose text is not part of the visible page.
HIDING = frozenset("rp rt script style template".split())

_VALUE = r"\"[^\"]*\"|'[^']*'|[^\s\"'<>=`/]+(?=[\s>]|\Z)"
_ATTRIBUTE = re.compile(rf"([^\s\"'<>/=]+)(?:\s*=\s*({_VALUE}))?")
_MARK = re.compile(
    rf"</([a-zA-Z][a-zA-Z0-9:-]*)\s*>"
    rf"|<([a-zA-Z][a-zA-Z0-9:-]*)((?:\s+[^\s\"'<>/=]+(?:\s*=\s*(?:{_VALUE}))?)*)\s*(/?)>"
    rf"|<!--((?:(?!--)[^<>])*)-->"
    rf"|<!([dD][oO][cC][tT][yY][pP][eE][^<>\[\]\"']*)>"
)
_RAW_END = {tag: re.compile(rf"</{tag}", re.I) for tag in ("script", "style")}
# Elements whose content newer parsers read as plain text.
_TEXT_ONLY = frozenset(("textarea", "title", "iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"))


class Node:
    __slots__ = ("at", "end", "tag", "parent", "text", "hidden", "gone", "_raw", "_attrs", "_classes")

    def __init__(self, at, tag, raw, parent, text, hidden):
        self.at, self.end, self.tag, self.parent = at, at + 1, tag, parent
        self.text, self.hidden, self.gone = text, hidden, False
        self._raw, self._attrs, self._classes = raw, None, None

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            raw = self._raw
            if not raw:
                self._attrs = {}
            elif isinstance(raw, str):
                self._attrs = {k.lower(): _plain(v) for k, v in _ATTRIBUTE.findall(raw)}
            else:
                self._attrs = {k: v or "" for k, v in raw}
        return self._attrs

    def get(self, name: str) -> str | None:
        return self.attrs.get(name) if self._raw else None

    @property
    def classes(self) -> frozenset:
        if self._classes is None:
            self._classes = frozenset((self.get("class") or "").split()) if self._raw else frozenset()
        return self._classes

    def has(self, cls: str) -> bool:
        """Class test that reads attributes only where the name can occur."""
        raw = self._raw
        if not raw or (isinstance(raw, str) and cls not in raw and "&" not in raw):
            return False
        return cls in self.classes

    def ancestors(self) -> Iterator["Node"]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


def _plain(value: str) -> str:
    if value[:1] in ('"', "'"):
        value = value[1:-1]
    return unescape(value) if "&" in value else value


class Page:
    """Node list of one page; ``nodes[0]`` stands for the document."""

    def __init__(self, html: str, tolerant: bool = False):
        self._start()
        if tolerant or not self._read_regular(html):
            self._start()
            reader = _Tolerant(self)
            reader.feed(html)
            reader.close()
        self._flush()
        for node in self._open:
            node.end = len(self.nodes)

    def _start(self):
        self.nodes = [Node(0, "#document", None, None, None, False)]
        self._open = [self.nodes[0]]
        self._hiding: list[Node] = []
        self._pending: list[str] = []
        self.pruned = False

    def drop(self, node: Node):
        """Remove an element and all that is in it."""
        node.gone = self.pruned = True

    @property
    def root(self) -> Node:
        return self.nodes[0]

    def _read_regular(self, html: str) -> bool:
        """Read the page if all of its markup is regular."""
        at, size = 0, len(html)
        if "\r" in html or "\0" in html:
            return False
        while at < size:
            cut = html.find("<", at)
            if cut < 0:
                cut = size
            if cut > at:
                said = html[at:cut]
                self._pending.append(unescape(said) if "&" in said else said)
            if cut == size:
                return True
            mark = _MARK.match(html, cut)
            if mark is None:
                return False
            at = mark.end()
            end_tag, tag, raw, closed, comment, decl = mark.groups()
            if end_tag:
                self.end_tag(end_tag.lower())
            elif tag:
                tag = tag.lower()
                if tag in _TEXT_ONLY and "<" in html[at : html.find("</" + tag, at)]:
                    return False
                self.start_tag(tag, raw)
                if closed:
                    if tag in _RAW_END:
                        return False
                    if tag not in VOID:
                        self.end_tag(tag)
                elif tag in _RAW_END:
                    stop = _RAW_END[tag].search(html, at)
                    if stop is None:
                        return False
                    if stop.start() > at:
                        self._pending.append(html[at : stop.start()])
                    at = stop.start()
            else:
                self.aside(comment if comment is not None else decl)
        return True

    def _append(self, tag, raw, text, hidden) -> Node:
        node = Node(len(self.nodes), tag, raw, self._open[-1], text, hidden)
        self.nodes.append(node)
        return node

    def _flush(self):
        if self._pending:
            said = "".join(self._pending)
            self._pending.clear()
            self._append(None, None, said, bool(self._hiding))

    def said(self, text: str):
        self._pending.append(text)

    def aside(self, text: str, hidden: bool = True):
        """Comment-like text: present as a string, not part of the visible text."""
        self._flush()
        self._append(None, None, text, hidden)

    def start_tag(self, tag: str, raw):
        self._flush()
        node = self._append(tag, raw, None, False)
        if tag not in VOID:
            self._open.append(node)
            if tag in HIDING:
                self._hiding.append(node)

    def end_tag(self, tag: str):
        if tag in VOID:
            return
        self._flush()
        if self._open[-1].tag != tag and not any(node.tag == tag for node in self._open):
            return
        while True:
            node = self._open.pop()
            node.end = len(self.nodes)
            if self._hiding and self._hiding[-1] is node:
                self._hiding.pop()
            if node.tag == tag:
                return

    def below(self, top: Node) -> Iterator[Node]:
        """Remaining descendants of ``top`` in document order."""
        nodes, i = self.nodes, top.at + 1
        if not self.pruned:
            yield from nodes[i : top.end]
            return
        while i < top.end:
            node = nodes[i]
            if node.gone:
                i = node.end
            else:
                yield node
                i += 1

    def elements(self, top: Node, *tags: str) -> Iterator[Node]:
        """Elements below ``top``, of the given names when any are given."""
        for node in self.below(top):
            if node.tag is not None and (not tags or node.tag in tags):
                yield node

    def texts(self, top: Node) -> list[str]:
        """Visible text pieces, each stripped, empty ones left out."""
        own = top.tag in HIDING
        nodes = self.below(top) if self.pruned else self.nodes[top.at + 1 : top.end]
        pieces = [n.text.strip() for n in nodes if n.tag is None and (own or not n.hidden)]
        return [piece for piece in pieces if piece]

    def text(self, top: Node | None, sep: str = " ") -> str:
        return sep.join(self.texts(top)) if top is not None else ""


class _Tolerant(HTMLParser):
    """Hands the standard parser's events to a page."""

    def __init__(self, page: Page):
        super().__init__(convert_charrefs=True)
        self.page = page
        self.handle_data = page.said
        self.handle_comment = self.handle_decl = self.handle_pi = page.aside
        self.handle_starttag = page.start_tag
        self.handle_endtag = page.end_tag

    def unknown_decl(self, data):
        is_text = data[:6].upper() == "CDATA["
        self.page.aside(data[6:] if is_text else data, hidden=not is_text)


def inside(node: Node, *, tag: str | None = None, cls: str | None = None) -> bool:
    """Whether an ancestor has this name and/or class."""
    up = node.parent
    while up is not None:
        if (tag is None or up.tag == tag) and (cls is None or up.has(cls)):
            return True
        up = up.parent
    return False
