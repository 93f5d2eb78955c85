"""Block structure of an HTML page as flat node arrays.

Nodes stand in page order: block elements, and one leaf for every run of
inline content between block boundaries.  A leaf's text has its character
references decoded and its white space (line breaks included) squeezed.  Tags
of inline elements leave no node; end tags that HTML implies are supplied; a
page that ends early is closed at its end.
"""

from __future__ import annotations

import re
from html import unescape

ROOT, LEAF = "#root", "#text"

#: Elements that begin a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is no text of the page; those of RAW hold no tags.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DEAD = frozenset("button select optgroup option datalist noscript template object svg math audio video canvas map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)""",
    re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?|\Z", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: An opening tag closes open elements of these kinds, up to the barrier.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_WALLS = frozenset(("table", "td", "th", "caption"))
_TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())


def attribute_tokens(attributes: str) -> tuple[str, ...]:
    """Lower-case words of class, id, role, itemprop and aria-label."""
    values = ("".join(v) for v in _ATTRIBUTE.findall(attributes))
    return tuple(dict.fromkeys(t.lower() for v in values for t in _TOKEN.findall(v)))


class Page:
    """Arrays over the nodes of one page: tag, parent, end (one past the last
    node of the subtree), tokens, and for leaves text and link characters."""

    def __init__(self, html: str):
        self.tag, self.parent, self.end, self.tokens = [ROOT], [-1], [0], [()]
        self.text: list[str | None] = [None]
        self.link: list[int] = [0]
        self._stack, self._at, self._walls = [0], {}, []
        self._parts: list[str] = []
        self._linked = self._in_link = self._dead = 0
        self._read(html)
        self._flush()
        while self._stack:
            self._pop()

    def _node(self, tag: str, tokens: tuple, text: str | None, link: int) -> int:
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.end.append(len(self.tag))
        self.tokens.append(tokens)
        self.text.append(text)
        self.link.append(link)
        return len(self.tag) - 1

    def _flush(self) -> None:
        if self._parts:
            text = "".join(self._parts)
            if "&" in text:
                text = unescape(text)
            text = " ".join(text.split())
            if text and not self._dead:
                self._node(LEAF, (), text, min(self._linked, len(text)))
            self._parts = []
        self._linked = 0

    def _push(self, name: str, attributes: str) -> None:
        at = len(self._stack)
        self._at.setdefault(name, []).append(at)
        if name in _WALLS:
            self._walls.append(at)
        if name in DEAD:
            self._dead += 1
        self._stack.append(self._node(name, attribute_tokens(attributes) if "=" in attributes else (), None, 0))

    def _pop(self) -> None:
        node = self._stack.pop()
        self.end[node] = len(self.tag)
        name = self.tag[node]
        if node:
            self._at[name].pop()
            if name in _WALLS:
                self._walls.pop()
            if name in DEAD:
                self._dead -= 1

    def _pop_to(self, at: int) -> None:
        while len(self._stack) > at:
            self._pop()

    def _open(self, name: str, attributes: str) -> None:
        self._flush()
        top = self.tag[self._stack[-1]]
        if top == "p" or (name in _HEADINGS and top in _HEADINGS):
            self._pop()
        kinds, barrier = _CLOSES.get(name, ((), ()))
        if kinds:
            floor = max((self._at[b][-1] for b in barrier if self._at.get(b)), default=0)
            open_at = [self._at[k][-1] for k in kinds if self._at.get(k) and self._at[k][-1] > floor]
            if open_at:
                self._pop_to(min(open_at))
        self._push(name, attributes)
        if name in VOID:
            self._pop()

    def _close(self, name: str) -> None:
        at = self._at.get(name)
        wall = self._walls[-1] if self._walls and name not in _TABLE_PARTS else 0
        self._flush()
        if at and at[-1] >= wall and name not in ("body", "html"):
            self._pop_to(at[-1])

    def _read(self, html: str) -> None:
        at, find = 0, _TAG.search
        while (m := find(html, at)) is not None:
            if m.start() > at:
                self._add(html[at: m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                if name == "a":
                    self._in_link = 0
                elif name in BLOCKS or name in DEAD:
                    self._close(name)
            elif name == "br":
                self._parts.append(" ")
            elif name == "a":
                self._in_link = 1
            elif name in RAW:
                at = _RAW_END[name].search(html, at).end()
            elif name in BLOCKS or (name in DEAD and not m[3].endswith("/")):
                self._open(name, m[3])
        if at < len(html):
            self._add(html[at:])

    def _add(self, text: str) -> None:
        self._parts.append(text)
        if self._in_link:
            self._linked += len(text)
