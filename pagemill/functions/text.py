"""Text expressions: names, words, element formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.split() and str.strip() treat as white space.
_SPACE = (
    r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = f"[^{_SPACE}]+"
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# The same characters for Java, which tests the parts of a class one by one: common ones first.
_FAST_WORD = rf"[!-~\x{{a1}}-\x{{167f}}[^{_SPACE}]]+"
# A token is compared without anything but letters, digits, and _ @ . -
TOKEN_NOISE = r"[^\p{L}\p{N}_@.\-]"
LETTERS_DIGITS = r"[\p{L}\p{N}]"


def decoded(path: Column) -> Column:
    """A path as the file source gives it, without URL encoding; a plus sign is no blank there."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+$", 0)


def base_name(name: Column) -> Column:
    """File name without folder and extension: 'a/b.pdf' and 'b.enc' agree."""
    return F.regexp_replace(file_name(name), r"\.[^.]*$", "")


def words(text: Column) -> Column:
    """What stands between white space. A pattern for words takes several times as long as a split at blanks."""
    blanks = F.translate(text, _SPACES, " " * len(_SPACES))
    return F.array_remove(F.split(blanks, " ", -1), "")


def word_count(text: Column) -> Column:
    return F.size(words(F.coalesce(text, F.lit(""))))


def not_blank(text: Column) -> Column:
    """Something other than white space of any kind; SQL ``trim`` strips spaces only."""
    return text.rlike(_FAST_WORD)


def token_key(token: Column) -> Column:
    return F.lower(F.regexp_replace(token, TOKEN_NOISE, ""))


def stars(text: Column) -> Column:
    """Every letter and digit becomes ``*``; the length stays."""
    return F.regexp_replace(text, LETTERS_DIGITS, "*")


def format_element(kind: Column, content: Column, description: Column) -> Column:
    """Markdown-like form of one element; NULL content counts as empty."""
    role = F.lower(F.trim(kind))
    body = F.coalesce(content, F.lit(""))
    boxed = F.concat(F.lit("["), F.upper(F.trim(kind)), F.lit("]\n"), body)
    described = F.concat(boxed, F.lit("\n[Description: "), description, F.lit("]"))
    return (
        F.when(role == "title", F.concat(F.lit("# "), body))
        .when(role.contains("header"), F.concat(F.lit("## "), body))
        .when(role.isin("table", "figure"), F.when(F.trim(description) != "", described).otherwise(boxed))
        .otherwise(body)
    )


def has_text(formatted: Column) -> Column:
    return F.trim(formatted) != ""
