"""Parsers: content of a document -> pages and elements (``schemas.PARSED``).

Each parser is one expression on the row that holds the document, so parsing needs no
shuffle and works the same in batch and streaming. ``pages`` and positions come from the
content itself: a text is cut by line count, a PDF by its page objects, HTML is one page.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import PARSED
from . import textlayer
from .binding import indices, let, runs
from .text import not_blank


def _element(i: Column, kind: Column, content: Column, description: Column | None, coord: Column, page: Column) -> Column:
    return F.struct(
        i.alias("id"),
        kind.alias("type"),
        content.alias("content"),
        (F.lit(None).cast("string") if description is None else description).alias("description"),
        F.array(F.struct(coord.cast("array<int>").alias("coord"), page.cast("int").alias("page_id"))).alias("bbox"),
    )


def _document(elements: Column, n_pages: Column, image_prefix: Column | None) -> Column:
    def page(p: Column) -> Column:
        uri = F.lit(None).cast("string") if image_prefix is None else F.concat(image_prefix, F.lit("#page="), p)
        return F.struct(p.alias("id"), uri.alias("image_uri"))

    pages = F.transform(indices(n_pages), page)
    return F.struct(F.struct(pages.alias("pages"), elements.alias("elements")).alias("document")).cast(PARSED)


def plain_text(text: Column, lines_per_page: int = 50, image_prefix: Column | None = None) -> Column:
    """One element per line, the first one the title."""

    def elements(lines: Column) -> Column:
        def element(line: Column, i: Column) -> Column:
            page = F.floor(i / lines_per_page).cast("int")
            row = i - page * lines_per_page
            box = F.array(F.lit(0), row, F.length(line), row + 1)
            return _element(i, F.when(i == 0, F.lit("title")).otherwise(F.lit("text")), line, None, box, page)

        n_pages = F.floor((F.size(lines) + (lines_per_page - 1)) / lines_per_page).cast("int")
        return _document(F.transform(lines, element), n_pages, image_prefix)

    return let(F.split(F.coalesce(text, F.lit("")), "\n", -1), elements)


# --- PDF text layer ---------------------------------------------------------------

# Roles of the font sizes.
TITLE_SIZE, HEADING_SIZE = 16.0, 12.0


def _role(size: Column) -> Column:
    return (
        F.when(size >= TITLE_SIZE, F.lit("title")).when(size >= HEADING_SIZE, F.lit("section_header")).otherwise(F.lit("text"))
    )


def pdf_text(content: Column, image_prefix: Column | None = None) -> Column:
    """Role by font size; body lines without a gap between them form one paragraph, and strings at one height one line."""

    def new_block(before: Column, line: Column) -> Column:
        # a line of n points sits n + 4 below the last one; anything wider is a gap, and a line further up a new column
        fall = before["y"] - line["y"]
        apart = (line["size"] >= HEADING_SIZE) | (fall > before["size"] * 1.5) | (fall < 0)
        return (before["page"] != line["page"]) | (before["size"] != line["size"]) | ((fall != 0) & apart)

    def joined(block: Column) -> Column:
        def piece(show: Column, i: Column) -> Column:
            parted = F.when(F.get(block, i - 1)["y"] == show["y"], F.lit(" ")).otherwise(F.lit("\n"))
            return F.when(i == 0, show["text"]).otherwise(F.concat(parted, show["text"]))

        return F.array_join(F.transform(block, piece), "")

    def element(block: Column, i: Column) -> Column:
        first = F.get(block, F.lit(0))
        last = F.element_at(block, -1)
        box = F.array(
            first["x"],
            F.lit(textlayer.PAGE_HEIGHT) - first["y"] - first["size"],
            F.lit(textlayer.PAGE_HEIGHT),
            F.lit(textlayer.PAGE_HEIGHT) - last["y"],
        )
        return _element(
            i, _role(first["size"]), joined(block), None, box, first["page"]
        )

    def document(shows: Column) -> Column:
        n_pages = F.coalesce(F.array_max(F.transform(shows, lambda s: s["page"])) + 1, F.lit(0))
        return _document(F.transform(runs(shows, new_block), element), n_pages, image_prefix)

    return let(textlayer.shows(content), document)


def pdf_words(content: Column, bold_fonts: tuple[str, ...] = ("F2",)) -> Column:
    """Words of the text layer with their boxes (top-left origin): array of (page, word)."""
    return textlayer.words(content, bold_fonts)


# --- HTML --------------------------------------------------------------------------

_CUT, _TAG, _END = "\u0001", "\u0002", "\u0003"
# What is not text. A page that leaves one of the first three open is closed at its end, so
# that they always match; a navigation block ends at the next one at the latest. Either way
# no opening tag makes the pattern run to the end of the page in vain.
_HIDDEN = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"|<nav\b[^<]*+(?:<(?!/?nav\b)[^<]*+)*+</nav\s*>|<meta\b[^<>]*>"
)
_CLOSERS = "--></script></style>"
_BLOCKS = "title|h1|h2|h3|h4|h5|h6|p|li|table|figure|header|footer|div|article|section|body|head|html|ul|ol|br"
# Character references decoded in text.
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def html_text(html: Column, image_prefix: Column | None = None) -> Column:
    """Block tags cut the page into elements; what stands in an unclosed one is kept.

    A table stays one element with cells split by `` | `` and rows by new lines; a figure
    takes its picture's ``alt`` text as description.
    """
    source = F.concat(F.translate(F.coalesce(html, F.lit("")), _CUT + _TAG + _END, "   "), F.lit(_END + _CLOSERS))
    text = F.substring_index(F.regexp_replace(source, _HIDDEN, ""), _END, 1)
    text = F.regexp_replace(text, r"(?is)</t[dh]\s*>\s*<t[dh]\b[^<>]*>", " | ")
    text = F.regexp_replace(text, r"(?is)</tr\s*>\s*<tr\b[^<>]*>", "\n")
    text = F.regexp_replace(text, rf"(?is)<({_BLOCKS})\b([^<>]*)>", f"{_CUT}$1{_TAG}")
    text = F.regexp_replace(text, rf"(?is)</({_BLOCKS})\s*>", f"{_CUT}{_TAG}")
    text = F.regexp_replace(text, r'(?is)<img\b[^<>]*\balt="([^"<>]*)"[^<>]*>', f"{_TAG}$1{_TAG}")
    text = F.regexp_replace(text, r"(?s)<[^<>]*>", "")

    def decoded(value: Column) -> Column:
        for reference, char in _REFERENCES:
            value = F.replace(value, F.lit(reference), F.lit(char))
        return F.btrim(value, F.lit(" \t\r\n"))

    def block(piece: Column) -> Column:
        # tag, text, or for a figure: tag, text before the picture, alt text, text after it
        parts = F.split(piece, _TAG, -1)
        return let(
            parts,
            lambda p: F.struct(
                F.lower(F.get(p, F.lit(0))).alias("tag"),
                decoded(F.concat_ws("", F.get(p, F.lit(1)), F.get(p, F.lit(3)))).alias("content"),
                decoded(F.get(p, F.lit(2))).alias("description"),
            ),
        )

    def kind(tag: Column) -> Column:
        return (
            F.when(tag == "title", F.lit("title"))
            .when(tag.rlike("^h[1-6]$"), F.lit("section_header"))
            .when(tag == "header", F.lit("page_header"))
            .when(tag == "footer", F.lit("page_footer"))
            .when(tag == "li", F.lit("list_item"))
            .when(tag.isin("table", "figure"), tag)
            .otherwise(F.lit("text"))
        )

    blocks = F.filter(
        F.transform(F.split(text, _CUT, -1), block),
        lambda b: not_blank(b["content"]) | (b["tag"] == "figure") & not_blank(b["description"]),
    )

    def elements(found: Column) -> Column:
        return F.transform(
            found,
            lambda b, i: _element(
                i, kind(b["tag"]), b["content"], b["description"],
                F.array(F.lit(0), i, F.length(b["content"]), i + 1), F.lit(0),
            ),
        )

    return _document(elements(blocks), F.lit(1), image_prefix)
