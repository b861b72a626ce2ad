"""Elements to page text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import crypto
from ..functions.binding import let, only, runs
from ..functions.text import format_element, has_text
from ..schemas import PAGE_KEY


def _shaped() -> Column:
    return format_element(F.col("element_type"), F.col("content"), F.col("description"))


def formatted(elements: DataFrame) -> DataFrame:
    """Elements with ``formatted_content``; those without text are dropped."""
    return elements.select("*", only(_shaped(), has_text).alias("formatted_content"))


def pages(elements: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pages of an element table, by aggregation.

    Elements of one file leave one task of the scan together, so the map-side aggregate
    already holds whole pages and the shuffle moves about one row per page.
    """
    piece = F.struct("element_id", F.col("formatted_content").alias("text"))
    return (
        formatted(elements)
        .groupBy(*PAGE_KEY, *keep)
        .agg(
            F.concat_ws("\n\n", F.array_sort(F.collect_list(piece))["text"]).alias("page_content"),
            F.count("*").alias("element_count"),
            F.array_join(F.array_sort(F.collect_set("element_type")), ", ").alias("element_types"),
            F.min_by("image_uri", "element_id").alias("image_uri"),
            F.max("extracted_at").alias("extracted_at"),
        )
        .withColumn("aggregated_at", F.current_timestamp())
    )


def pages_of(docs: DataFrame) -> DataFrame:
    """The same pages straight from parsed documents, without any shuffle.

    All elements of a file are in one row, so the row's own array is sorted and cut into
    pages. A file of any size costs n log n of its own elements, whatever the others hold.
    """
    doc = F.col("parsed_doc.document")

    def keep(e: Column) -> Column:
        text = format_element(e["type"], e["content"], e["description"])
        return F.struct(
            F.get(e["bbox"], F.lit(0))["page_id"].alias("page_id"),
            e["id"].alias("element_id"),
            text.alias("text"),
            e["type"].alias("type"),
        )

    shaped = F.filter(F.transform(doc["elements"], keep), lambda e: has_text(e["text"]))
    by_page = runs(F.array_sort(shaped), lambda a, b: ~a["page_id"].eqNullSafe(b["page_id"]))
    page = F.transform(
        by_page,
        lambda run: let(
            F.get(run, F.lit(0))["page_id"],
            lambda number: F.struct(
                number.alias("page_id"),
                F.concat_ws("\n\n", run["text"]).alias("page_content"),
                F.size(run).cast("bigint").alias("element_count"),
                F.array_join(F.array_sort(F.array_distinct(run["type"])), ", ").alias("element_types"),
                F.get(doc["pages"], number)["image_uri"].alias("image_uri"),
            ),
        ),
    )
    return docs.select(
        "file_name", "file_path", "document_type", F.inline(page)
    ).withColumns({"extracted_at": F.current_timestamp(), "aggregated_at": F.current_timestamp()})


def sealed_pages(clear: DataFrame, key: bytes, keep: Sequence[str] = ()) -> DataFrame:
    """The stored form of pages."""
    return clear.select(
        *PAGE_KEY,
        crypto.seal(F.col("page_content"), key).alias("encrypted_page_content"),
        "element_count", "element_types", "image_uri", "extracted_at", "aggregated_at", *keep,
    )


def unsealed_pages(stored: DataFrame, key: bytes) -> DataFrame:
    return stored.select(
        *PAGE_KEY,
        crypto.unseal(F.col("encrypted_page_content"), key).alias("page_content"),
        "element_count", "element_types", "image_uri", "extracted_at", "aggregated_at",
    )


def in_order(clear: DataFrame) -> DataFrame:
    """For reading: global order. Stored pages carry none, a range shuffle would buy nothing."""
    return clear.orderBy("file_name", "page_id")
