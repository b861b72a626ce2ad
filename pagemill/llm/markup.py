"""Reading HTML as a stream of runs of text, each with the elements it stands in."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import xxhash

# Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
# An opening element ends open elements of these kinds, up to the nearest enclosing container.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")


@lru_cache(maxsize=1 << 12)
def _told(tag: str, attributes: str) -> tuple[str, str, bool, str]:
    """Role, names, whether hidden, and label, from the attributes of a tag."""
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    role = given.get("role", "").lower()
    names = " ".join(filter(None, (given.get("class", ""), given.get("id", "")))).lower()
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", given.get("style", "")))
    return role, names, hidden, tag + "".join("." + x for x in sorted(given.get("class", "").lower().split())) + (f"[{role}]" if role else "")


class Element:
    """An open element: tag, the values of class, id and role, whether it is marked as hidden, and its place.

    ``path`` is a hash of the labels from the root to it, ``parent`` that of the element around it (0: none), so that deep
    nesting costs no more than shallow.
    """

    __slots__ = ("hidden", "label", "names", "parent", "path", "role", "tag")

    def __init__(self, tag: str, attributes: str, above: Element | None) -> None:
        self.tag = tag
        self.role, self.names, self.hidden, self.label = _told(tag, attributes) if attributes else ("", "", False, tag)
        self.parent = above.path if above else 0
        self.path = xxhash.xxh3_64_intdigest(self.label, self.parent) >> 1


class _Stack(list):
    """Open elements, and where those of each tag are."""

    def __init__(self) -> None:
        super().__init__()
        self.spots: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.spots.setdefault(element.tag, []).append(len(self))
        self.append(element)

    def drop(self) -> None:
        self.spots[self.pop().tag].pop()

    def last(self, tags: set[str]) -> int:
        return max([spots[-1] for t in tags if (spots := self.spots.get(t))], default=-1)


def read(html: str) -> Iterator[tuple[str, list[Element], str]]:
    """('open' | 'close' | 'text', elements it stands in, text). Unclosed and stray tags are mended as a browser would, nearly."""
    stack = _Stack()
    at, size = 0, len(html)
    while at < size:
        sign = html.find("<", at)
        if sign < 0:
            sign = size
        if sign > at:
            yield "text", stack, unescape(html[at:sign])
        if sign == size:
            return
        piece = _PIECE.match(html, sign)
        if piece is None:
            yield "text", stack, "<"
            at = sign + 1
            continue
        at = piece.end()
        tag = (piece[2] or "").lower()
        if not tag:
            continue
        if piece[1]:
            yield from _close(stack, tag)
            continue
        if tag in BLOCK and tag not in _ENDS:
            if stack.spots.get("p"):
                yield from _end(stack, {"p"}, {"table", "button", "article", "section", "div"} - {tag})
        elif tag in _ENDS:
            yield from _end(stack, _ENDS[tag], _HOLDS[tag])
        element = Element(tag, piece[3], stack[-1] if stack else None)
        stack.push(element)
        yield "open", stack, ""
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            stop = end.start() if end else size
            if stop > at:
                yield "text", stack, html[at:stop]
            at = stop
        elif tag in VOID or piece[3].endswith("/") and tag not in BLOCK:
            yield "close", stack, ""
            stack.drop()


def _close(stack: _Stack, tag: str) -> Iterator[tuple[str, list[Element], str]]:
    """Close the nearest open element of that name and all in it; a stray end tag does nothing."""
    if spots := stack.spots.get(tag):
        yield from _cut(stack, spots[-1])


def _end(stack: _Stack, kinds: set[str], within: set[str]) -> Iterator[tuple[str, list[Element], str]]:
    """Close the nearest element of these kinds and all in it, if no container is nearer."""
    spot = stack.last(kinds)
    if spot >= 0 and spot > stack.last(within):
        yield from _cut(stack, spot)


def _cut(stack: _Stack, spot: int) -> Iterator[tuple[str, list[Element], str]]:
    while 0 <= spot < len(stack):
        yield "close", stack, ""
        stack.drop()
