"""Personal data in text: what it looks like and how it is masked.

One alternation of all asked-for classes runs over the text. The leftmost match wins,
and at one position the earlier class, so matches never overlap and come in text order.

Patterns are written with ``<`` and ``>`` for the edge of a word. ``alternation`` spells
them with ``\b`` only, so that any SQL engine reads them. ``fast_alternation`` finds the
same matches in Java at a fraction of the cost: it looks at the next character before it
tries a class, and never starts an address in the middle of a run it has already scanned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from .binding import let
from .text import stars

_NAME = r"\p{Lu}[\p{L}'\-]+(?: \p{Lu}\.)?[ \n]\p{Lu}[\p{L}'\-]+(?: \p{Lu}[\p{L}'\-]+)?"
# Repetitions of one class of characters have no upper count: a value is taken whole. They stay
# linear, as each begins at a place where nothing of its own class stands before.
_CODE = r"[A-Za-z\-]*[0-9][A-Za-z0-9\-]*"
_MONTH = r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_DATE = rf"[0-9]+[/.\-][0-9]+[/.\-][0-9]+|{_MONTH}\.?[ \n][0-9]+,?[ \n][0-9]+|[0-9]+\.?[ \n]{_MONTH}\.?,?[ \n][0-9]+"
_FIRM = r"\p{Lu}[\p{L}&\-]+(?: \p{Lu}[\p{L}&\-]+)*"
_NO = r"(?: number| no\.?)?"
# White space of any length may stand between a cue and its value, a line break too.
_GAP = r"[ \t\r\n\f]*"
_SEP = f"[:#]?{_GAP}"

# The fifteen classes. Order is priority where two classes start together.
ORDER = (
    "EMAIL", "IP_ADDRESS", "DATE_OF_BIRTH", "DRIVER_LICENSE", "PASSPORT_NUMBER", "BANK_ACCOUNT",
    "MEDICAL_RECORD_NUMBER", "NATIONAL_ID", "AGE", "ORGANIZATION", "PERSON_NAME", "CREDIT_CARD",
    "SSN", "PHONE_NUMBER", "ADDRESS",
)

# Classes known by their own shape.
SHAPES: dict[str, str] = {
    "EMAIL": r"[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}.\-]+\.\p{L}{2,}",
    "IP_ADDRESS": r"<(?:[0-9]{1,3}\.){3}[0-9]{1,3}>",
    # fourteen digits without signs between them are mostly something else
    "CREDIT_CARD": (
        r"<(?:[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}|[0-9]{4}[ \-]?[0-9]{6}[ \-]?[0-9]{5}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{4})>"
    ),
    "SSN": r"<[0-9]{3}[\- ][0-9]{2}[\- ][0-9]{4}>",
    "PHONE_NUMBER": (
        r"(?:(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{3}\) ?|[0-9]{3}[\-. ])|\([0-9]{3}\) ?"
        r"|<(?:1[\-. ])?[0-9]{3}[\-. ])[0-9]{3}[\-. ][0-9]{4}>|\+[0-9]{1,3}(?:[ .\-][0-9]{2,4}){2,5}>)"
    ),
    "ADDRESS": (
        r"<[0-9]+[ \n](?:\p{Lu}[\p{L}'\-]*\.?[ \n])+"
        r"(?:Street|Road|Avenue|Boulevard|Lane|Drive|Court|Way|Place|Parkway|St|Rd|Ave|Blvd|Ln|Dr|Ct|Pl|Pkwy)>\.?"
        r"(?:,?[ \n](?:Apt|Suite|Unit|No)\.?[ \n][0-9A-Za-z]+)?"
        r"(?:,[ \n]\p{Lu}[\p{L}'\-]*(?: \p{Lu}[\p{L}'\-]*)*,[ \n][A-Z]{2}[ \n][0-9]{5}(?:-[0-9]{4})?)?"
    ),
}

# Classes known by a cue word in front: (cue words in any case, what separates, the value).
CUES: dict[str, tuple[tuple[str, ...], str, str]] = {
    "DATE_OF_BIRTH": (("date of birth", "birth date", "dob", "born(?: on)?"), _SEP, _DATE),
    "DRIVER_LICENSE": ((r"driver'?s? licen[cs]e" + _NO,), _SEP, _CODE),
    "PASSPORT_NUMBER": (("passport" + _NO,), _SEP, _CODE),
    "BANK_ACCOUNT": (
        ("bank account" + _NO, "bank routing" + _NO, "account" + _NO, "routing" + _NO), _SEP, r"[0-9]{6,}"
    ),
    "MEDICAL_RECORD_NUMBER": (("mrn", "medical record" + _NO), _SEP, _CODE),
    "NATIONAL_ID": (("national id" + _NO, "national identity" + _NO), _SEP, _CODE),
    "AGE": (("aged", "age"), _SEP, r"[0-9]{1,3}>"),
    "ORGANIZATION": (("employer", "company", "organi[sz]ation"), f"[:#]{_GAP}", _FIRM),
    "PERSON_NAME": (
        (
            "candidate", "employee", "applicant", "patient", "customer", "card ?member", "card ?holder", "analyst", "author",
            "contact", "manager", "partner", "examiner", "(?:prepared|reviewed|submitted|approved) by", "full name", "name",
        ),
        f":{_GAP}",
        _NAME,
    ),
}
# Forms of address need no colon.
_SURNAME = r"\p{Lu}[\p{L}'\-]+"
_TITLES = rf"(?:Mr|Mrs|Ms|Dr)\.? (?:{_NAME}|{_SURNAME})"

# A text without any of these characters and titles cannot hold a match of any class.
_HINT = "[0-9@:#]|M[rs]|Dr"

# The classes masked by replacement in published pages.
PUBLISHED = ("EMAIL", "PERSON_NAME", "CREDIT_CARD", "SSN", "PHONE_NUMBER", "ADDRESS")
# Classes that keep their last four digits at the same length.
KEEP_LAST_FOUR = ("PHONE_NUMBER", "CREDIT_CARD", "DRIVER_LICENSE", "PASSPORT_NUMBER", "SSN")
_WORD_STARTS = r"(?<![\p{L}\p{N}_])"
_WORD_ENDS = r"(?![\p{L}\p{N}_])"

# A letter behind the first of the last four digits is hidden like any other.
LETTERS = r"\p{L}"

LAST_FOUR = r"[0-9][^0-9]*[0-9][^0-9]*[0-9][^0-9]*[0-9][^0-9]*$"

_MARK = "\u0001"


def pattern_of(name: str, edges: tuple[str, str] = (r"\b", r"\b")) -> str:
    """One class as a regular expression, with its cue words if it has any."""
    if name in SHAPES:
        spelled = SHAPES[name]
    else:
        cues, sep, value = CUES[name]
        spelled = f"<(?i:{'|'.join(cues)}){sep}(?:{value})"
        if name == "PERSON_NAME":
            spelled = f"(?:{spelled}|<{_TITLES})"
    return _edges(spelled, edges)


def _edges(spelled: str, edges: tuple[str, str]) -> str:
    # every ">" closes a word; "<" opens one
    return spelled.replace("<", "\0").replace(">", edges[1]).replace("\0", edges[0])


def value_pattern(name: str) -> str:
    # behind a form of address a surname is enough
    return f"{_NAME}|{_SURNAME}" if name == "PERSON_NAME" else _edges(CUES[name][2], ("", ""))


def alternation(classes: Sequence[str] = ORDER) -> str:
    return "|".join(f"(?:{pattern_of(c)})" for c in ORDER if c in classes)


_JAVA_EDGES = ("(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])")


def _first_letters(cue: str) -> set[str]:
    """What a cue can begin with: its first letter, or those of the words in a group at its head."""
    return {word[0] for word in cue[3 : cue.index(")")].split("|")} if cue.startswith("(?:") else {cue[0]}


def fast_alternation(classes: Sequence[str] = ORDER) -> str:
    """Same matches as ``alternation``, for Java only.

    Addresses are tried at the start of a run only (or where the last match ended), digit-led
    classes at a digit, cue words by their first letter. Branches of different first
    characters cannot start at one place, so grouping them keeps the priority.
    """
    wanted = [c for c in ORDER if c in classes]
    branches = []
    if "EMAIL" in wanted:
        local, domain = SHAPES["EMAIL"].split("@")
        branches.append(rf"(?:\G|(?<!{local.rstrip('+')})){local}+@{domain}")
    digit_led = [f"(?:{pattern_of(c, _JAVA_EDGES)})" for c in wanted if c in SHAPES and c != "EMAIL"]
    if digit_led:
        branches.append(f"(?=[0-9+(])(?:{'|'.join(digit_led)})")
    by_letter: dict[str, list[str]] = {}
    for name in wanted:
        if name in CUES:
            cues, sep, value = CUES[name]
            for letter in sorted({letter for c in cues for letter in _first_letters(c)}):
                own = "|".join(c for c in cues if letter in _first_letters(c))
                by_letter.setdefault(letter, []).append(_edges(f"(?:(?i:{own}){sep}(?:{value}))", _JAVA_EDGES))
    if "PERSON_NAME" in wanted:
        for letter in "dm":
            by_letter.setdefault(letter, []).append(f"(?:{_TITLES})")
    if by_letter:
        letters = "".join(sorted(by_letter))
        led = "|".join(f"(?=[{x}{x.upper()}])(?:{'|'.join(alts)})" for x, alts in sorted(by_letter.items()))
        branches.append(f"(?=[{letters}{letters.upper()}]){_JAVA_EDGES[0]}(?:{led})")
    return "|".join(branches)


def full(pattern: str) -> str:
    return f"^(?:{pattern})$"


def segments(text: Column, pattern: str) -> Column:
    """Text cut at the matches: even places are the gaps, odd places the matches.

    One pass of the pattern sets a mark around each match; a text that already holds
    the mark is cut by a second pass instead.
    """
    marked = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    woven = F.flatten(
        F.zip_with(gaps, found, lambda gap, hit: F.when(hit.isNull(), F.array(gap)).otherwise(F.array(gap, hit)))
    )
    return F.when(~text.contains(_MARK), marked).otherwise(woven)


def cut(text: Column, classes: Sequence[str] = ORDER) -> Column:
    """``segments`` for the classes; cheap tests first keep most texts from the full pattern."""
    rest = [c for c in classes if c != "EMAIL"]
    found = segments(text, fast_alternation(classes))
    if len(rest) < len(classes) and rest:
        found = F.when(text.contains("@"), found).otherwise(segments(text, fast_alternation(rest)))
    return F.when(text.rlike(_HINT), found).otherwise(F.array(text))


def category_of(hit: Column, classes: Sequence[str] = ORDER) -> Column:
    chosen = F.lit(None).cast("string")
    for name in reversed([c for c in ORDER if c in classes]):
        chosen = F.when(hit.rlike(full(pattern_of(name, _JAVA_EDGES))), F.lit(name)).otherwise(chosen)
    return chosen


def value_of(hit: Column, category: Column) -> Column:
    """The personal value inside a match: all of it, or what follows the cue word."""
    value = hit
    for name in CUES:
        value = F.when(category == name, F.regexp_extract(hit, f"(?:{value_pattern(name)})$", 0)).otherwise(value)
    return value


def mask_same_length(original: Column, category: Column) -> Column:
    """Stars for letters and digits, with the class's own exceptions; punctuation stays."""
    tail = F.regexp_extract(original, LAST_FOUR, 0)
    head = F.left(original, F.length(original) - F.length(tail))
    at = F.instr(original, "@")
    number = F.regexp_extract(original, r"^[0-9]+", 0)
    return (
        F.when(category.isin(*KEEP_LAST_FOUR), F.concat(stars(head), F.regexp_replace(tail, LETTERS, "*")))
        .when(category == "EMAIL", F.concat(stars(F.left(original, at)), F.substr(original, at + 1)))
        .when(category == "ADDRESS", F.concat(stars(number), F.substr(original, F.length(number) + 1)))
        .otherwise(stars(original))
    )


def mask_replace(original: Column, category: Column) -> Column:
    """The published form of a value."""
    tail = F.regexp_extract(original, LAST_FOUR, 0)
    head = F.left(original, F.length(original) - F.length(tail))
    digits = "[0-9]"
    return (
        F.when(category == "PERSON_NAME", F.lit("[[NAME]]"))
        .when(category == "EMAIL", F.concat(F.lit("***"), F.substr(original, F.instr(original, "@"))))
        .when(category == "PHONE_NUMBER", F.concat(F.regexp_replace(head, digits, "*"), tail))
        .when(category == "SSN", F.lit("<<SSN>>"))
        .when(category == "CREDIT_CARD", F.regexp_replace(original, digits, "*"))
        .when(category == "ADDRESS", F.lit("[ADDRESS]"))
        .otherwise(original)
    )


def force_same_length(original: Column, masked: Column) -> Column:
    """Trust a mask of the right length, rebuild any other from the original."""
    return F.when(F.length(masked) == F.length(original), masked).otherwise(stars(original))


def entities_in(
    parts: Column,
    classes: Sequence[str] = ORDER,
    mask: Callable[[Column, Column], Column] = mask_same_length,
) -> Column:
    """Entities of a cut text, in text order."""
    hits = F.filter(parts, lambda part, i: i % 2 == 1)

    def entity(hit: Column) -> Column:
        return let(
            F.struct(hit.alias("hit"), category_of(hit, classes).alias("category")),
            lambda h: let(
                F.struct(value_of(h["hit"], h["category"]).alias("value"), h["category"].alias("category")),
                lambda v: F.struct(
                    v["value"].alias("original"),
                    mask(v["value"], v["category"]).alias("masked"),
                    v["category"].alias("category"),
                ),
            ),
        )

    return F.transform(hits, entity)


def masked_text(
    parts: Column,
    classes: Sequence[str] = PUBLISHED,
    mask: Callable[[Column, Column], Column] = mask_replace,
) -> Column:
    """The cut text put together again with every match masked in place."""

    def swap(part: Column) -> Column:
        return let(
            category_of(part, classes),
            lambda category: let(
                value_of(part, category),
                lambda value: F.concat(
                    F.left(part, F.length(part) - F.length(value)), mask(value, category)
                ),
            ),
        )

    return F.array_join(
        F.transform(parts, lambda part, i: F.when(i % 2 == 1, swap(part)).otherwise(part)), ""
    )


def known_masked(text: Column, known: Column) -> Column:
    """Every occurrence of the known values as whole words masked: one pass for each distinct mask.

    The values of one mask are one pattern, longest first, with the edge of a word on either side.
    """
    longest_first = F.array_sort(known, lambda a, b: F.length(b["original"]) - F.length(a["original"]))

    def swap(acc: Column, mask: Column, values: Column) -> Column:
        own = F.transform(F.filter(values, lambda e: e["masked"] == mask), lambda e: F.concat(F.lit("\\Q"), e["original"], F.lit("\\E")))
        pattern = F.concat(F.lit(f"{_WORD_STARTS}(?:"), F.array_join(own, "|"), F.lit(f"){_WORD_ENDS}"))
        return F.regexp_replace(acc, pattern, F.regexp_replace(mask, r"([\\$])", r"\\$1"))

    return let(
        longest_first,
        lambda values: F.aggregate(F.array_distinct(F.transform(values, lambda e: e["masked"])), text, lambda acc, mask: swap(acc, mask, values)),
    )


def mask_in_text(
    text: Column,
    classes: Sequence[str] = PUBLISHED,
    mask: Callable[[Column, Column], Column] = mask_replace,
    everywhere: Sequence[str] = ("PERSON_NAME", "ADDRESS"),
    also: Column | None = None,
) -> Column:
    """Mask every match; names and addresses also where they stand without their cue.

    ``also`` are entities known from elsewhere, such as other pages of the file; they are masked where they stand.
    """

    def whole(parts: Column) -> Column:
        masked = masked_text(parts, classes, mask)
        spread_over = [c for c in everywhere if c in classes]
        if not spread_over:
            return masked
        known = F.array_distinct(
            F.filter(entities_in(parts, classes, mask), lambda e: e["category"].isin(*spread_over))
        )
        return known_masked(masked, known)

    own = let(cut(text, classes), lambda parts: F.when(F.size(parts) > 1, whole(parts)).otherwise(text))
    return own if also is None else let(own, lambda masked: F.when(F.size(also) > 0, known_masked(masked, also)).otherwise(masked))


def spreading(text: Column, everywhere: Sequence[str] = ("PERSON_NAME", "ADDRESS"), mask: Callable[[Column, Column], Column] = mask_replace) -> Column:
    """The distinct entities of a text that are masked without a cue too: array of (original, masked, category)."""
    return F.array_distinct(entities_in(cut(text, everywhere), everywhere, mask))
