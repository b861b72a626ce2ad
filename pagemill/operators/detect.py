"""Personal data on pages: native detection, or the answers of a model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import pii
from ..functions.binding import empty_array, items, only
from ..functions.text import not_blank
from ..schemas import ENTITY


def with_entities(pages: DataFrame, text: str = "page_content", classes: Sequence[str] = pii.ORDER) -> DataFrame:
    """Pages with ``entities``: an array of (original, masked, category) in text order."""
    return pages.withColumn("entities", pii.entities_in(pii.cut(F.col(text), classes), classes))


def entity_rows(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per entity, numbered within its page."""
    return items(pages, keys, "entities", "entity", "ord").select(*keys, "ord", "entity.*")


def entity_counts(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entities per page, for the pages that have any; no grouping, the page knows its own."""
    return pages.select(*keys, only(F.size("entities").cast("bigint"), lambda n: n > 0).alias("n_entities"))


def answered(response: Column) -> Column:
    """Entities of a model's answer: what stands between the first ``[`` and the last ``]``.

    Items are read one by one, so that one that is no object does not spoil the others.
    Items without a text for both sides are dropped, and an answer that is no JSON has none.
    """
    listed = F.from_json(F.regexp_extract(response, r"(?s)\[.*\]", 0), "array<string>")
    items = F.transform(listed, lambda item: F.from_json(item, ENTITY))
    usable = F.filter(items, lambda e: e["original"].isNotNull() & e["masked"].isNotNull())
    named = F.transform(
        usable,
        lambda e: F.struct(
            e["original"].alias("original"),
            pii.force_same_length(e["original"], e["masked"]).alias("masked"),
            F.coalesce(e["category"], F.lit("UNKNOWN")).alias("category"),
        ),
    )
    return F.coalesce(named, empty_array(ENTITY))


# What a model is asked for.
RULES = (
    "Find all personal data in the text. Classes: {classes}.\n"
    'Answer with a JSON array of {{"original", "masked", "category"}} and nothing else; [] if there is none.\n'
    "masked has the length of original: letters and digits become *, punctuation and blanks stay.\n"
    "Phone, card, licence and passport numbers and SSN keep the last four digits; e-mail addresses keep\n"
    "their domain; of an address only the house number is masked.\n\nText:\n"
)


def prompt(text: Column, classes: Sequence[str] = pii.ORDER) -> Column:
    return F.concat(F.lit(RULES.format(classes=", ".join(classes))), text)


def detection_input(pages: DataFrame, keys: Sequence[str], text: str = "page_content") -> DataFrame:
    """What goes to a model: pages that are not blank, with their prompt."""
    filled = pages.select(*keys, only(F.col(text), not_blank).alias(text))
    return filled.withColumn("prompt", prompt(F.col(text)))


def pages_with_entities(pages: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The pages some entity row belongs to."""
    return pages.join(rows.select(*keys), list(keys), "left_semi")


def attach_entities(pages: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entity rows back onto their pages; pages without any get an empty array.

    Grouping is by page, so a group is as large as one page's own entities.
    """
    grouped = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ord", "original", "masked", "category"))).alias("found")
    )
    packed = grouped.select(
        *keys,
        F.transform("found", lambda e: F.struct(e["original"], e["masked"], e["category"])).cast(f"array<{ENTITY}>").alias("entities"),
    )
    return pages.join(packed, list(keys), "left").withColumn(
        "entities", F.coalesce("entities", empty_array(ENTITY))
    )
