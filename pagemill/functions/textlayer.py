"""The text layer of uncompressed PDFs, on Arrow batches: what is shown where.

A document is one row. Its content streams are read once from front to end, with the running state
of text that operators change: matrix, line start, font, size, leading, spacing and rise. Pages are the
page objects in the order of the page tree, so other streams (images, forms, metadata) do not count;
in a file without page objects every stream that is none of these is a page.

Defined results. NULL and files without a text layer give an empty list. A compressed stream shows nothing, a
stream without its end goes on to the end of its object. Unknown operators are passed over. A literal string without its end
goes to the end of its stream and is not shown. Strings are UTF-16 after a byte order mark, or if they are written in
hexadecimal with all upper bytes zero; else one byte is one character of the Windows Latin alphabet, which base fonts have.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import hypot

import pyarrow as pa
from pyspark.sql import Column, functions as F

# Advance widths of Helvetica and Helvetica-Bold for characters 32..126, in
# thousandths of the font size (standard font metrics).
HELVETICA = (
    "278 278 355 556 556 889 667 191 333 333 389 584 278 333 278 278 556 556 556 556 556 556 556 556 556 556 "
    "278 278 584 584 584 556 1015 667 667 722 722 667 611 778 722 278 500 667 556 833 722 778 667 778 722 667 "
    "611 722 667 944 667 667 611 278 278 278 469 556 333 556 556 500 556 556 278 556 556 222 222 500 222 833 "
    "556 556 556 556 333 500 278 556 500 722 500 500 500 334 260 334 584"
)
HELVETICA_BOLD = (
    "278 333 474 556 556 889 722 238 333 333 389 584 278 333 278 278 556 556 556 556 556 556 556 556 556 556 "
    "333 333 584 584 584 611 975 722 722 722 722 667 611 778 722 278 556 722 611 833 722 778 667 778 722 667 "
    "611 722 667 944 667 667 611 333 278 333 584 556 333 556 611 556 611 556 333 611 611 278 278 556 278 889 "
    "611 611 611 611 389 556 333 611 556 778 556 556 500 389 280 389 584"
)
# The font's descent, the width of a character outside the table, and the height of a page.
DESCENT, OTHER_WIDTH, PAGE_HEIGHT = -0.207, 556, 792.0
# A gap of this part of the font size between two strings of a line parts words.
WORD_GAP = 0.2

_NUMBERED = re.compile(rb"(?<![0-9])([0-9]++)\s++[0-9]++\s++obj\b")
_STREAM = re.compile(rb"(?<!end)stream\r?\n")
_REFERENCE = re.compile(rb"([0-9]++)\s++[0-9]++\s++R\b")
_PAGE, _CATALOG = re.compile(rb"/Type\s*+/Page(?![A-Za-z])"), re.compile(rb"/Type\s*+/Catalog(?![A-Za-z])")
_NO_PAGE = re.compile(rb"/Subtype\s*+/(?:Image|Form|XML|Type1C)|/Type\s*+/(?:XObject|Metadata|ObjStm|XRef)|/Length1\b")
_ENTRY = {name: re.compile(rb"/" + name + rb"\s*+(\[[^\]]*+\]|[0-9]++\s++[0-9]++\s++R)") for name in (b"Contents", b"Kids", b"Pages")}
_TOKEN = re.compile(
    rb"%[^\r\n]*+|\((?P<text>[^()\\]*+)\)|(?P<open>\()|<<|>>|<(?P<hex>[0-9A-Fa-f\s]*+)>|(?P<array>\[)|\]|/(?P<name>[^\s()<>\[\]{}/%]*+)"
    rb"|(?P<number>[+-]?(?:[0-9]++\.?[0-9]*+|\.[0-9]++))|(?P<op>[A-Za-z'\"][A-Za-z0-9*]*+)"
)
_EDGE = re.compile(rb"(?s)[()]|\\.")
_ESCAPE = re.compile(rb"(?s)\\(?:([0-7]{1,3})|(\r\n|.))")
_WORD = re.compile(r"\S+", re.ASCII)
# Escapes of a literal string beside octal ones; any other sign after a backslash stands for itself.
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r": b"", b"\r\n": b""}

_SHOWS = "array<struct<page: int, font: string, size: double, x: double, y: double, text: string>>"
_WORDS = "array<struct<page: int, text: string, x0: double, y0: double, x1: double, y1: double, fontname: string, fontsize: double>>"


class _Widths(dict):
    def __missing__(self, char: str) -> int:
        return OTHER_WIDTH


def _table(widths: str) -> _Widths:
    return _Widths((chr(32 + n), int(w)) for n, w in enumerate(widths.split()))


_REGULAR, _BOLD = _table(HELVETICA), _table(HELVETICA_BOLD)


def _decoded(raw: bytes) -> str:
    if raw[:2] == b"\xfe\xff":
        return raw[2:].decode("utf-16-be", "replace")
    try:
        return raw.decode("cp1252")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _literal(raw: bytes) -> str:
    if b"\\" in raw:
        raw = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1] else _ESCAPES.get(m[2], m[2]), raw)
    return _decoded(raw)


def _hexadecimal(digits: bytes) -> str:
    digits = b"".join(digits.split())
    raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    wide = len(raw) % 2 == 0 and raw and not any(raw[::2])
    return raw.decode("utf-16-be") if wide else _decoded(raw)


def _operations(stream: bytes) -> Iterator[tuple[str, list]]:
    """Operators with their operands; the items of an array are operands like others."""
    at, operands = 0, []
    while token := _TOKEN.search(stream, at):
        at, kind = token.end(), token.lastgroup
        if kind == "number":
            operands.append(float(token["number"]))
        elif kind == "text":
            operands.append(_decoded(token["text"]))
        elif kind == "hex":
            operands.append(_hexadecimal(token["hex"]))
        elif kind == "name":
            operands.append(token["name"])
        elif kind == "open":
            depth = 1
            for edge in _EDGE.finditer(stream, at):
                depth += {b"(": 1, b")": -1}.get(edge[0], 0)
                if not depth:
                    break
            if depth:
                return
            operands.append(_literal(stream[at : edge.start()]))
            at = edge.end()
        elif kind == "op":
            name = token["op"]
            if name == b"ID":
                # the data of an inline image is no text
                end = stream.find(b"EI", at)
                at = len(stream) if end < 0 else end + 2
            yield name.decode(), operands
            operands = []


@dataclass
class _Show:
    """A shown string: font, size, start of its base line, and its pieces as (x, text, width of a thousandth, extra for each character, extra for a blank)."""

    font: str
    size: float
    x: float
    y: float
    pieces: list[tuple[float, str, float, float, float]]

    @property
    def text(self) -> str:
        return "".join(piece[1] for piece in self.pieces)

    def words(self, widths: _Widths) -> Iterator[tuple[str, float, float]]:
        """Words with their left and right."""
        ends = []
        for x, text, unit, each, blank in self.pieces:
            ends.append([x + w * unit for w in accumulate(map(widths.__getitem__, text), initial=0)])
            if each or blank:
                more = accumulate((each + blank * (c == " ") for c in text), initial=0.0)
                ends[-1] = [e + m for e, m in zip(ends[-1], more)]
        if len(ends) == 1:
            lefts, rights = ends[0], ends[0][1:]
        else:
            lefts, rights = [x for e in ends for x in e[:-1]], [x for e in ends for x in e[1:]]
        for word in _WORD.finditer(self.text):
            yield word[0], lefts[word.start()], rights[word.end() - 1]


def _shown(stream: bytes, bold: frozenset[str]) -> Iterator[_Show]:
    """The strings of a page's content in order; strings without a gap between them are one."""
    font, size, leading, spacing, blank, stretch, rise = "", 0.0, 0.0, 0.0, 0.0, 1.0, 0.0
    a, b, c, d, e, f = line = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
    saved: list[tuple] = []
    open_show, end = None, 0.0
    for op, args in _operations(stream):
        numbers = [n for n in args if isinstance(n, float)]
        if op in ("'", '"'):
            if op == '"' and len(numbers) > 1:
                blank, spacing = numbers[:2]
            args = args[-1:]
        if op in ("Td", "TD", "T*", "'", '"'):
            x, y = numbers[-2:] if op in ("Td", "TD") and len(numbers) > 1 else (0.0, -leading if op not in ("Td", "TD") else 0.0)
            if op == "TD":
                leading = -y
            a, b, c, d, e, f = line
            a, b, c, d, e, f = line = (a, b, c, d, e + x * a + y * c, f + x * b + y * d)
        if op in ("Tj", "TJ", "'", '"'):
            widths = _BOLD if font in bold else _REGULAR
            for item in args:
                moved = 0.0
                if isinstance(item, float):
                    moved = -item / 1000.0 * size * stretch
                elif isinstance(item, str):
                    high, x, y = size * hypot(c, d), e + rise * c, f + rise * d
                    if not (open_show and open_show.y == y and open_show.size == high and open_show.font == font and -0.5 * high <= x - end < WORD_GAP * high):
                        if open_show:
                            yield open_show
                        open_show = _Show(font, high, x, y, [])
                    across = stretch * a
                    open_show.pieces.append((x, item, size * across / 1000.0, spacing * across, blank * across))
                    moved = (sum(map(widths.__getitem__, item)) / 1000.0 * size + spacing * len(item) + blank * item.count(" ")) * stretch
                    end = x + moved * a
                e, f = e + moved * a, f + moved * b
        elif op == "Tm" and len(numbers) > 5:
            a, b, c, d, e, f = line = tuple(numbers[-6:])
        elif op == "BT":
            a, b, c, d, e, f = line = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
        elif op == "Tf" and numbers and isinstance(args[0], bytes):
            font, size = args[0].decode("latin-1"), numbers[-1]
        elif op == "q":
            saved.append((font, size, leading, spacing, blank, stretch, rise))
        elif op == "Q" and saved:
            font, size, leading, spacing, blank, stretch, rise = saved.pop()
        elif numbers and op == "TL":
            leading = numbers[-1]
        elif numbers and op == "Tc":
            spacing = numbers[-1]
        elif numbers and op == "Tw":
            blank = numbers[-1]
        elif numbers and op == "Tz":
            stretch = numbers[-1] / 100.0
        elif numbers and op == "Ts":
            rise = numbers[-1]
    if open_show:
        yield open_show


def _body(content: bytes, head: bytes, start: int, stop: int) -> bytes:
    end = content.find(b"endstream", start, stop)
    return b"" if b"/Filter" in head else content[start : stop if end < 0 else end]


def _references(head: bytes, entry: bytes) -> list[int]:
    found = _ENTRY[entry].search(head)
    return [int(n) for n in _REFERENCE.findall(found[1])] if found else []


def _pages(content: bytes) -> list[bytes]:
    """The content of every page in order."""
    marks = list(_NUMBERED.finditer(content))
    heads, bodies = {}, {}
    for mark, after in zip(marks, [*(m.start() for m in marks[1:]), len(content)]):
        stream = _STREAM.search(content, mark.end(), after)
        number = int(mark[1])
        heads[number] = head = content[mark.end() : stream.start() if stream else after]
        bodies[number] = _body(content, head, stream.end(), after) if stream else b""
    pages = [n for n, head in heads.items() if _PAGE.search(head)]
    if not pages:
        return _loose_streams(content)
    roots = [n for head in heads.values() if _CATALOG.search(head) for n in _references(head, b"Pages")]
    ordered, seen, waiting = [], set(), roots[-1:]
    while waiting:
        number = waiting.pop()
        if number in heads and number not in seen:
            seen.add(number)
            if _PAGE.search(heads[number]):
                ordered.append(number)
            else:
                waiting += reversed(_references(heads[number], b"Kids"))

    def content_of(page: int) -> bytes:
        listed = _references(heads[page], b"Contents")
        # the entry may name an object that holds the list
        parts = [m for n in listed for m in ([n] if bodies.get(n) else [int(r) for r in _REFERENCE.findall(heads.get(n, b""))])]
        return b"\n".join(bodies.get(n, b"") for n in parts)

    return [content_of(n) for n in ordered or pages]


def _loose_streams(content: bytes) -> list[bytes]:
    found, at = [], 0
    while stream := _STREAM.search(content, at):
        head = content[at : stream.start()].rpartition(b"obj")[2]
        end = content.find(b"endstream", stream.end())
        stop = len(content) if end < 0 else end
        if not _NO_PAGE.search(head):
            found.append(_body(content, head, stream.end(), stop))
        at = stop
    return found


def _listed(kind: str, offsets: list[int], columns: list[list]) -> pa.Array:
    """The rows of a batch as one array of lists of structs."""
    types = {"int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    named = [field.strip().split(": ") for field in kind.removeprefix("array<struct<").removesuffix(">>").split(",")]
    arrays = [pa.array(column, types[t]) for column, (_, t) in zip(columns, named, strict=True)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, [n for n, _ in named]))


# Rows of all lists that go out at once: the lists of a batch of documents are far larger than the documents.
ROWS_OUT = 16_384


def _told(kind: str, documents: Iterator[pa.Array], rows_of: Callable[[bytes], Iterator[tuple]]) -> Iterator[pa.Array]:
    """A list of rows for every document, given out whenever ``ROWS_OUT`` rows have come together and at the end of a batch."""
    width = kind.count(": ")
    for batch in documents:
        offsets, rows = [0], []
        for document in batch:
            rows += rows_of(document.as_py() or b"")
            offsets.append(len(rows))
            if len(rows) >= ROWS_OUT:
                yield _listed(kind, offsets, [list(c) for c in zip(*rows)])
                offsets, rows = [0], []
        if len(offsets) > 1 or not len(batch):
            yield _listed(kind, offsets, [list(c) for c in zip(*rows)] or [[]] * width)


def shows(content: Column, bold_fonts: tuple[str, ...] = ("F2",)) -> Column:
    """All shown strings of a PDF: array of (page, font, size, x, y, text), in order."""
    bold = frozenset(bold_fonts)

    def rows_of(document: bytes) -> Iterator[tuple]:
        for number, page in enumerate(_pages(document)):
            for s in _shown(page, bold):
                yield number, s.font, s.size, s.x, s.y, s.text

    @F.arrow_udf(_SHOWS)
    def read(documents: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _told(_SHOWS, documents, rows_of)

    return read(content.cast("binary"))


def words(content: Column, bold_fonts: tuple[str, ...] = ("F2",)) -> Column:
    """Words of the text layer with their boxes, in order, with the origin at the top left."""
    bold = frozenset(bold_fonts)

    def rows_of(document: bytes) -> Iterator[tuple]:
        for number, page in enumerate(_pages(document)):
            for show in _shown(page, bold):
                heavy = show.font in bold
                top = PAGE_HEIGHT - show.y - DESCENT * show.size - show.size
                name = "Helvetica-Bold" if heavy else "Helvetica"
                bottom = top + show.size
                for word, left, right in show.words(_BOLD if heavy else _REGULAR):
                    yield number, word, left, top, right, bottom, name, show.size

    @F.arrow_udf(_WORDS)
    def read(documents: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _told(_WORDS, documents, rows_of)

    return read(content.cast("binary"))
