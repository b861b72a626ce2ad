"""Main text of web pages by deducing the template that pages of a host share.

A page is a sequence of tokens: elements, known by a hash of the labels around them, and runs of text. For
every token Spark aggregates its occurrence vector over the distinct pages of a host: how often it occurs in
which page, kept as an order-free hash next to its support. Tokens with the same vector are an
equivalence class. A class that many pages share is valid if each of its tokens stands within a token of its own class or
of a valid class around it; valid classes nest into the host's template. Text under the template's
elements is in a slot, text that is itself a token of a valid class belongs to the template.

What a slot holds is told by its statistics over the host. The holder is the narrowest box, once a page, with most of the text that varies
and is no link. Boxes beside it or around it are other slots if links make up most of them or if they hold little
text next to the holder (adverts, notices, bylines, footers, teasers); in the holder those that are links alone are. All other slots are
extracted, the template's own text only if it is most of the article. Tags, roles, classes and ids
that say that an element is something else (menus, headers and footers of the page, sidebars, notices, adverts, forms, comments) are
a hint that alone decides on hosts with too few distinct pages for a template. A class or id says so only by its head
word or as a whole, and never of an element that holds the page's article.

Defined results. Null html or a page without text gives ''. A null or unreadable URL has no host and thus no template.
Copies of a page count once for the template and give the same text each. A fixed text is left out of an article only
if most of the article is not fixed, and a page that would lose most of its text by its host's slots is read without them.
Character references are decoded, white space (also no-break) in a
block becomes one space, blocks are joined by two line feeds. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, attach, small, stored, whole_text
from .markup import BLOCK, Element, read

# Pages of a host from which a template is deduced, the share of them that a class must be in, and the share
# that a fixed text must be in.
MIN_PAGES = 3
SUPPORT = 0.5
FIXED_SUPPORT = 0.9
# A box beside the holder with less than this share of its text is another slot; so is one in it with this share of links.
SLOT_SHARE = 0.15
LINK_SHARE = 0.9
# A page keeps at least this share of its text, or is read without its host's slots.
KEPT_SHARE = 0.4
# Bytes that a template takes in a broadcast, beside its lists.
TEMPLATE_BYTES = 200
# Text in paragraphs and headings is taken for fixed from so many distinct pages on; a few may be revisions of one article.
MIN_PROSE_PAGES = 10

# Elements, roles and words of class or id that say what is not main text.
ASIDE_TAGS = frozenset(
    "nav footer aside form script style noscript template button select textarea input label iframe svg canvas object video audio dialog menu head title".split()
)
NO_TEXT_TAGS = frozenset("script style noscript template button select textarea input label iframe svg canvas object video audio head title".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe "
    "subscription signup login comment comments disqus respond replies share sharing social related recommended recommendations "
    "widget toolbar pagination pager search copyright disclaimer outbrain taboola adsense adsbygoogle doubleclick".split()
)
# Words that say so as the last of a name, whatever is before them, but for words that deny it.
HEAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor promo banner sidebar nav navbar menu navigation breadcrumb breadcrumbs footer masthead "
    "cookie cookies consent notice notices notification popup modal newsletter comment comments disqus replies toolbar pagination pager widget widgets".split()
)
DENIALS = frozenset("has with no without not hide hides".split())
# Words that may stand beside one of these in a name without telling anything else.
PLACE_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content element entries entry form group header icon icons inner item items js "
    "label latest layer leaderboard left link links list main media outer page panel popular post posts article articles recent region right row section site slot story "
    "stories sub text thread title top unit user warning widgets wrap wrapper zone".split()
)
_HOLDERS = BLOCK - frozenset("p li tr pre blockquote h1 h2 h3 h4 h5 h6".split())
_WHOLE = frozenset(("html", "body", "main", "article"))
_PROSE = re.compile(r"(?:p|h[1-6])(?:[.\[]|$)")
_SIZE = re.compile(r"\d+(?:x\d+)?")
_NAMES = re.compile(r"[^a-z0-9]+")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*+://(?:[^/?#@]*+@)?+([^/?#:]++)", 1))


@lru_cache(maxsize=1 << 14)
def _name_says_aside(name: str) -> bool:
    """Whether a class or id says so as a whole or by its last word: sidebar-left and user-comments do, has-sidebar and notice-period do not."""
    words = [w for w in _NAMES.split(name) if len(w) > 1 and not _SIZE.fullmatch(w)]
    if not words or words[0] in DENIALS:
        return False
    return words[-1] in HEAD_WORDS or any(w in ASIDE_WORDS for w in words) and all(w in ASIDE_WORDS or w in PLACE_WORDS for w in words)


def _is_aside(element: Element, above: list[Element], hints: bool) -> bool:
    """Whether tag, role or attributes say so, whatever the element holds."""
    if not hints:
        return element.tag in NO_TEXT_TAGS
    if element.tag in ASIDE_TAGS or element.role in ASIDE_ROLES or element.hidden:
        return True
    # of the page, not of the article
    return element.tag == "header" and not any(e.tag in ("article", "main") for e in above)


@dataclass
class Page:
    """What is read of a page: ('open' | 'close' | 'text', number of the innermost element, text), and of each element what it stands in."""

    found: list[tuple[str, int, str]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    aside: list[bool] = field(default_factory=list)
    linked: list[bool] = field(default_factory=list)

    def inherited(self, paths: frozenset[int]) -> list[bool]:
        """Of each element whether it or one around it has one of the paths."""
        out: list[bool] = []
        for element, outer in zip(self.elements, self.above, strict=True):
            out.append(element.path in paths or outer >= 0 and out[outer])
        return out


@lru_cache(maxsize=2)
def page_of(html: str, hints: bool = True) -> Page:
    """The page, with what its tags, roles and names say about its elements (without ``hints``: which hold no text at all).

    A name says nothing about an element that holds the page's article: a main or h1, an article with most of the text
    outside links, or without any of these most of that text itself.
    """
    page = Page()
    elements, above, aside, linked = page.elements, page.above, page.aside, page.linked
    chars: list[int] = []
    holds: list[bool] = []
    inside: list[int] = [-1]
    for kind, stack, text in read(html):
        if kind == "open":
            element, outer = stack[-1], inside[-1]
            inside.append(len(elements))
            elements.append(element)
            above.append(outer)
            aside.append(outer >= 0 and aside[outer] or _is_aside(element, stack[:-1] if element.tag == "header" else [], hints))
            linked.append(outer >= 0 and linked[outer] or element.tag == "a")
            chars.append(0)
            holds.append(not aside[-1] and (element.tag in ("main", "h1") or element.role == "main"))
        elif kind == "text" and inside[-1] >= 0 and not aside[inside[-1]] and not linked[inside[-1]]:
            chars[inside[-1]] += len(text.strip())
        page.found.append((kind, inside[-1], text))
        if kind == "close":
            inside.pop()
    if not hints:
        return page
    total = sum(chars)
    for i in range(len(elements) - 1, -1, -1):
        if above[i] >= 0:
            chars[above[i]] += chars[i]
    most = [2 * n > total for n in chars]
    holds = [h or m and e.tag == "article" for h, m, e in zip(holds, most, elements, strict=True)]
    if not any(holds):
        holds = most
    for i in range(len(elements) - 1, -1, -1):
        if holds[i] and above[i] >= 0:
            holds[above[i]] = True
    for i, element in enumerate(elements):
        named = not holds[i] and element.names and element.tag not in _WHOLE and any(_name_says_aside(x) for x in element.names.split())
        aside[i] = aside[i] or bool(named) or above[i] >= 0 and aside[above[i]]
    return page


def _spaced(text: str) -> str:
    """White space of any kind as single spaces, none at the ends."""
    return " ".join(text.split())


def text_token(path: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(text, path) >> 1


# --- template -----------------------------------------------------------------------------


def tokens_of(html: str, hints: bool = True) -> dict[int, list]:
    """Token -> [path around it, label of an element or None, number, characters that could be main text, those of them in links].

    Characters are an element's own and, for a text, its own.
    """
    page, found = page_of(html, hints), {}
    for kind, at, text in page.found:
        if at < 0 or kind == "close":
            continue
        element = page.elements[at]
        if kind == "open":
            entry = found.get(element.path)
            if entry is None:
                found[element.path] = [element.parent, element.label, 1, 0, 0]
            else:
                entry[2] += 1
        elif text := _spaced(text):
            chars = 0 if page.aside[at] else len(text)
            links = chars if page.linked[at] else 0
            own = found.setdefault(text_token(element.path, text), [element.path, None, 0, 0, 0])
            own[2] += 1
            for entry in (own, found[element.path]):
                entry[3] += chars
                entry[4] += links
    return found


@dataclass(frozen=True)
class Template:
    """Path of the box with the article (0: not known), paths of other slots, and tokens of the template's own texts."""

    holder: int = 0
    others: tuple[int, ...] = ()
    fixed: tuple[int, ...] = ()


def template_of(pages: int, tokens: list[tuple[int, int, str | None, str, int, int, int, int]]) -> Template:
    """The template of a host from its frequent tokens.

    ``tokens``: token, path around it, label, class, support, total, characters, those in links. They are at most 1 / SUPPORT times as
    many as a page has on average, as each is in that share of the pages.
    """
    classes: dict[str, list[tuple]] = defaultdict(list)
    for token in tokens:
        classes[token[3]].append(token)
    # the elements of classes nest; a text is held by an element of another class where that occurs more often
    valid: dict[int, tuple] = {}
    pending = {name: elements for name, members in classes.items() if (elements := {t[0]: t for t in members if t[2] is not None})}
    nested = True
    while nested:
        nested = [name for name, elements in pending.items() if all(t[1] == 0 or t[1] in valid or t[1] in elements for t in elements.values())]
        for name in nested:
            valid |= pending.pop(name)
    fixed, mass, links, total = [], defaultdict(int), defaultdict(int), 0
    for path, t in valid.items():
        mass[path] += t[6] - t[7]
        links[path] += t[7]
        total += t[6] - t[7]
    for name, members in classes.items():
        for t in members:
            label = valid[t[1]][2] if t[1] in valid else ""
            if t[2] is None and t[1] in valid and name not in pending and (pages >= MIN_PROSE_PAGES or not _PROSE.match(label)):
                fixed.append(t[0])
                mass[t[1]] -= t[6] - t[7]
    # where little varies, as in revisions of one article, what is fixed may be the article
    if 2 * sum(mass.values()) <= total:
        return Template(fixed=tuple(sorted(fixed)))
    return Template(*_slots(valid, mass, links), tuple(sorted(fixed)))


def _slots(valid: dict[int, tuple], mass: dict[int, int], links: dict[int, int]) -> tuple[int, tuple[int, ...]]:
    """The holder and the slots that hold something else, by the sums of varying text and of links in and below each path."""
    below: dict[int, list[int]] = defaultdict(list)
    for path, t in valid.items():
        below[t[1]].append(path)
    order, depth = [p for p in below[0]], dict.fromkeys(below[0], 0)
    for path in order:
        for child in below[path]:
            depth[child] = depth[path] + 1
            order.append(child)
    text, link = {p: mass[p] for p in order}, {p: links[p] for p in order}
    heads = {p: _tag(valid[p]) == "h1" for p in order}
    for path in reversed(order):
        outer = valid[path][1]
        if outer:
            text[outer] += text[path]
            link[outer] += link[path]
            heads[outer] = heads[outer] or heads[path]
    whole = sum(mass[p] for p in order)

    def box(path: int) -> bool:
        return _tag(valid[path]) in _HOLDERS

    once = [p for p in order if box(p) and valid[p][5] <= 1.1 * valid[p][4] and 2 * text[p] >= whole]
    if not once:
        return 0, ()
    holder = max(once, key=lambda p: (depth[p], text[p], p))
    others, chain, path = [], set(), holder
    while path:
        chain.add(path)
        path = valid[path][1]
    for path in order:
        outer = valid[path][1]
        if path in chain or not box(path):
            continue
        if outer in chain and outer != holder:  # beside the holder or an element around it
            if not heads[path] and (link[path] > text[path] or text[path] < SLOT_SHARE * text[holder]):
                others.append(path)
        elif depth[path] > depth[holder] and link[path] and link[path] >= LINK_SHARE * (link[path] + text[path]):
            others.append(path)
    return holder, tuple(sorted(others))


def _tag(token: tuple) -> str:
    return re.split(r"[.\[]", token[2], maxsplit=1)[0]


def templates(pages: DataFrame, hints: bool = True) -> DataFrame:
    """(host, holder, others, fixed) of every host with enough distinct pages, from (page_id, host, html).

    Of copies the page with the smallest id is read. Beyond a broadcast, pages are joined to the list of those to read by shuffle,
    but for pages with very many copies, whose facts are broadcast.
    """
    hashed = pages.filter("host <> ''").withColumn("h", F.xxhash64("host", "html"))
    chosen = stored(hashed.groupBy("h").agg(F.min("page_id").alias("chosen"), F.first("host").alias("of"), F.count(F.lit(1)).alias("n")))
    sums = chosen.agg(F.count(F.lit(1)), F.sum("n")).first()
    listed = chosen.select("h", "chosen", "n")
    if sums[0] * 64 <= BROADCAST_BYTES:
        joined = hashed.join(F.broadcast(listed), "h")
    else:
        joined = attach(hashed, listed, "h", "n", sums[1])
    distinct = joined.filter(F.col("page_id").eqNullSafe(F.col("chosen"))).select("host", "h", "html")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in range(8)]
            for host, h, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for token, (parent, label, number, chars, links) in tokens_of(html, hints).items():
                    mark = xxhash.xxh3_64_intdigest(f"{h} {number}") >> 1
                    for column, value in zip(columns, (host, token, parent, label, number, chars, links, mark), strict=True):
                        column.append(value)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
            names = ["host", "token", "parent", "label", "number", "chars", "links", "mark"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    seen = distinct.mapInArrow(emit, "host string, token long, parent long, label string, number long, chars long, links long, mark long")
    vectors = seen.groupBy("host", "token").agg(
        F.first("parent").alias("parent"), F.first("label").alias("label"), F.count(F.lit(1)).alias("support"), F.sum("number").alias("total"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.bit_xor("mark").alias("vector"),
    )
    sizes = stored(chosen.groupBy(F.col("of").alias("host")).agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= MIN_PAGES))
    needed = F.when(F.col("label").isNull(), FIXED_SUPPORT).otherwise(SUPPORT) * F.col("pages")
    frequent = vectors.filter("support > 1").join(small(sizes, sizes.count(), 2 * TEMPLATE_BYTES), "host").filter(F.col("support") >= needed)
    name = F.concat_ws(" ", "support", "total", "vector")
    token = F.struct("token", "parent", "label", name.alias("class"), "support", "total", "chars", "links")
    gathered = frequent.groupBy("host", "pages").agg(F.collect_list(token).alias("tokens"))

    def deduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for n, tokens in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                made.append(template_of(n, sorted((tuple(t.values()) for t in tokens), key=lambda t: t[0])))
            lists = [pa.array([list(m) for m in some], pa.list_(pa.int64())) for some in ([m.others for m in made], [m.fixed for m in made])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.holder for m in made], pa.int64()), *lists], names=["host", "holder", "others", "fixed"])

    return gathered.mapInArrow(deduce, "host string, holder long, others array<long>, fixed array<long>")


# --- extraction ---------------------------------------------------------------------------


def main_text(html: str, template: Template = Template(), hints: bool = True) -> str:
    """Blocks of main text, joined by two line feeds.

    Outside the holder text that the template has is left out, and what its other slots hold: a page may have slots that few others have.
    """
    page, fixed = page_of(html, hints), frozenset(template.fixed)
    other = page.inherited(frozenset(template.others)) if template.others else None
    found = _blocks(page, other if other and _keeps_enough(page, other) else None)
    if template.holder:
        held = page.inherited(frozenset((template.holder,)))
        found = [b for b in found if not (b[1] and b[1] <= fixed and not (b[2] >= 0 and held[b[2]]))]
    if fixed:
        plain = [b for b in found if not b[1] & fixed]
        if 2 * sum(len(t) for t, *_ in plain) > sum(len(t) for t, *_ in found):
            found = plain
    return "\n\n".join(t for t, *_ in found)


def _keeps_enough(page: Page, other: list[bool]) -> bool:
    """Whether the page has enough of its text, links apart, outside its host's other slots."""
    chars = [0, 0]
    for kind, at, text in page.found:
        if kind == "text" and at >= 0 and not page.aside[at] and not page.linked[at]:
            chars[other[at]] += len(text.strip())
    return chars[0] >= KEPT_SHARE * sum(chars)


def _blocks(page: Page, other: list[bool] | None) -> list[tuple[str, set[int], int]]:
    """(text, tokens of its runs, element of the first) of every block that is neither aside nor in other slots."""
    blocks: list[tuple[str, set[int], int]] = []
    parts: list[str] = []
    tokens: set[int] = set()
    first = -1

    def flush() -> None:
        if parts:
            if text := _spaced("".join(parts)):
                blocks.append((text, set(tokens), first))
            parts.clear()
            tokens.clear()

    for kind, at, text in page.found:
        if kind == "text":
            if at < 0 or not page.aside[at] and not (other and other[at]):
                parts.append(text)
                if clean := _spaced(text):
                    first = first if tokens else at
                    tokens.add(text_token(page.elements[at].path if at >= 0 else 0, clean))
            continue
        tag = page.elements[at].tag
        if tag in BLOCK:
            flush()
        elif tag in ("br", "td", "th", "img"):
            parts.append(" ")
    flush()
    return blocks


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", hints: bool = True) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text. Without ``hints`` the template alone decides."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), whole_text(F.col(html_col)).alias("html"))
    known = stored(templates(rows.select("page_id", "host", "html"), hints))
    size = known.agg(F.sum(F.length("host") + 8 * (F.size("fixed") + F.size("others")) + TEMPLATE_BYTES)).first()
    if (size[0] or 0) <= BROADCAST_BYTES // 2:
        joined = rows.join(F.broadcast(known), "host", "left")
    else:
        counts = stored(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).join(known, "host", "left"))
        joined = attach(rows, counts, "host", "n", rows.count())
    joined = joined.select("page_id", "url", "html", F.coalesce("holder", F.lit(0)).alias("holder"), "others", "fixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [
                    main_text(html, Template(holder, tuple(others or ()), tuple(fixed or ())), hints)
                    for html, holder, others, fixed in zip(*(part.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kinds = dict(joined.dtypes)
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
