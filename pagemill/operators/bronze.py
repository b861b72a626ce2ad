"""Encrypted files to parsed documents to elements."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify, crypto, text
from ..functions.binding import only
from ..schemas import CATEGORIES, PARSED
from ..sources.files import MAX_FILE_BYTES

Parser = Callable[[Column], Column]


def opened(files: DataFrame, key: bytes, on_error: str = "fail") -> DataFrame:
    """Files with ``content`` decrypted.

    What cannot be opened fails the job (``fail``), is left out (``quarantine``) or keeps
    its row with NULL content (``mark``).
    """
    if on_error == "fail":
        return files.withColumn("content", crypto.decrypt_bytes(F.col("content"), key))
    if on_error == "mark":
        return files.withColumn("content", crypto.try_decrypt_bytes(F.col("content"), key))
    if on_error != "quarantine":
        raise ValueError(f"on_error must be fail, quarantine or mark, not {on_error!r}")
    plain = only(crypto.try_decrypt_bytes(F.col("content"), key), lambda c: c.isNotNull())
    return files.select(*[c for c in files.columns if c != "content"], plain.alias("content"))


def quarantined(files: DataFrame, key: bytes, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """The files ``opened`` leaves out, with the reason."""
    reason = (
        F.when(F.col("content").isNull() & (F.col("length") > max_bytes), F.lit("not read: too large"))
        .when(F.col("content").isNull(), F.lit("no content"))
        .when(F.octet_length("content") < crypto.OVERHEAD, F.lit("shorter than nonce and tag"))
        .otherwise(F.lit("authentication failed"))
    )
    return files.filter(crypto.try_decrypt_bytes(F.col("content"), key).isNull()).select(
        text.file_name(F.col("path")).alias("file_name"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        reason.alias("reason"),
    )


def parsed(
    files: DataFrame,
    key: bytes,
    parser: Parser,
    labels: Sequence[str] = tuple(CATEGORIES),
    on_error: str = "fail",
) -> DataFrame:
    """One row per file with the parse as a struct; feeds the stages fused in one job."""
    name = text.file_name(F.col("path"))
    return opened(files, key, on_error).select(
        name.alias("file_name"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        classify.by_name(name, tuple(labels)).alias("document_type"),
        F.when(F.col("content").isNotNull(), parser(F.col("content"))).alias("parsed_doc"),
        F.current_timestamp().alias("ingested_at"),
    )


def sealed_docs(docs: DataFrame, key: bytes) -> DataFrame:
    """The stored form of ``parsed``: the parse as encrypted JSON."""
    return docs.select(
        "file_name", "file_path", "file_size", "document_type",
        crypto.seal(F.to_json("parsed_doc"), key).alias("encrypted_parsed_doc"),
        "ingested_at",
    )


def unsealed_docs(stored: DataFrame, key: bytes) -> DataFrame:
    """``parsed`` again from its stored form; JSON that cannot be read gives a NULL parse."""
    return stored.select(
        "file_name", "file_path", "file_size", "document_type",
        F.from_json(crypto.unseal(F.col("encrypted_parsed_doc"), key), PARSED).alias("parsed_doc"),
        "ingested_at",
    )


def failed(stored: DataFrame) -> DataFrame:
    """Rows of the stored documents that ``mark`` kept without a parse."""
    return stored.filter(F.col("encrypted_parsed_doc").isNull()).select(
        "file_name", "file_path", "file_size", "document_type", "ingested_at"
    )


def explode_elements(docs: DataFrame) -> DataFrame:
    """One row per element in clear; a document without any keeps one row of NULLs.

    The page list travels as a reference inside the row, and the image is looked up by
    position in it, so no join is needed.
    """
    document = F.col("parsed_doc.document")
    flat = docs.select(
        "file_name", "file_path", "document_type",
        document["pages"].alias("pages"),
        F.explode_outer(document["elements"]).alias("element"),
    )
    box = F.get(F.col("element.bbox"), F.lit(0))
    return flat.select(
        "file_name", "file_path", "document_type",
        F.col("element.id").alias("element_id"),
        F.col("element.type").alias("element_type"),
        F.col("element.content").alias("content"),
        F.col("element.description").alias("description"),
        box["page_id"].alias("page_id"),
        F.get(F.col("pages"), box["page_id"])["image_uri"].alias("image_uri"),
        F.to_json("element.bbox").alias("bbox_json"),
        F.current_timestamp().alias("extracted_at"),
    )


def sealed_elements(elements: DataFrame, key: bytes, seal_description: bool = True) -> DataFrame:
    """The stored form of elements: content encrypted, and the description unless told not to."""
    description = crypto.seal(F.col("description"), key) if seal_description else F.col("description")
    return elements.select(
        "file_name", "file_path", "document_type", "element_id", "element_type",
        crypto.seal(F.col("content"), key).alias("encrypted_content"),
        description.alias("description"),
        "page_id", "image_uri", "bbox_json", "extracted_at",
    )


def unsealed_elements(stored: DataFrame, key: bytes, sealed_description: bool = True) -> DataFrame:
    description = crypto.unseal(F.col("description"), key) if sealed_description else F.col("description")
    return stored.select(
        "file_name", "file_path", "document_type", "element_id", "element_type",
        crypto.unseal(F.col("encrypted_content"), key).alias("content"),
        description.alias("description"),
        "page_id", "image_uri", "bbox_json", "extracted_at",
    )
