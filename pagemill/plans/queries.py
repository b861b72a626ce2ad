"""The registered queries: every operator over the whole driver tables.

``documents`` plays the part of a folder of encrypted files, ``pages`` of parsed HTML,
``conversations`` of an evaluation set with its answers, ``benchmark`` of questions.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import classify, crypto, parse, pii, text, textlayer
from ..functions.binding import indices, items, let, only
from ..operators import bronze, detect, evaluate, gold, modelhook, redact, silver, vectors
from ..schemas import CATEGORIES, ELEMENTS, ENTITY, FILES, PARSED_DOCS
from ..session import ephemeral_key, forget, shared_dir, spread, stored
from ..sources import buckets, evalset, files, versions
from ..sources.tables import table, text_table
from ..streaming import ingest

# Lines of a text that make a page, lines of a generated PDF page.
LINES_PER_PAGE = 5
PDF_LINES = 40
DIM = 64
TOP_K = 5

# What the file names of a source end in. Other sources have no category.
SOURCE_SUFFIX = {
    "_hr": ("src0", "src1", "src2", "src3"),
    "_finance": ("src4", "src5", "src6"),
    "_tax_audit": ("src7", "src8", "src9"),
    "_engineering": ("src10", "src11", "src12", "src13"),
    "_support": ("src14", "src15", "src16"),
}
OTHER_SUFFIX = "_memo"


# --- inputs -------------------------------------------------------------------------------


def document_path() -> Column:
    suffix = F.lit(OTHER_SUFFIX)
    for ending, sources in SOURCE_SUFFIX.items():
        suffix = F.when(F.col("source").isin(*sources), F.lit(ending)).otherwise(suffix)
    return F.concat(F.lit("/landing/"), "source", F.lit("/"), "doc_id", suffix, F.lit(".enc"))


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return text_table(spark, sf, "documents", *columns)


def document_files(spark: SparkSession, sf: str, key: bytes, rows: DataFrame | None = None) -> DataFrame:
    rows = documents(spark, sf, "doc_id", "source", "text") if rows is None else rows
    return ingest.documents_as_files(rows, document_path(), key)


def text_parser(content: Column) -> Column:
    return parse.plain_text(content.cast("string"), LINES_PER_PAGE)


def parsed_documents(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> tuple[DataFrame, bytes]:
    """All documents, or those of ``rows``."""
    key = ephemeral_key(spark)
    docs = bronze.parsed(document_files(spark, sf, key, rows), key, text_parser)
    return docs.withColumn("parsed_doc", _with_images(F.col("parsed_doc"))), key


def _with_images(doc: Column) -> Column:
    """Pages named after their file, as a parser that renders pages would name them."""
    pages = F.transform(
        doc["document"]["pages"],
        lambda p: F.struct(p["id"].alias("id"), F.concat(F.col("file_path"), F.lit("#page="), p["id"]).alias("image_uri")),
    )
    return F.struct(F.struct(pages.alias("pages"), doc["document"]["elements"].alias("elements")).alias("document"))


def clear_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of all documents, without a stored step in between."""
    return silver.pages_of(parsed_documents(spark, sf)[0])


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def html_pages(spark: SparkSession, sf: str) -> DataFrame:
    page = text_table(spark, sf, "pages", "page_id", "url", "html")
    return page.select(
        text.file_name(F.col("url")).alias("file_name"),
        F.col("page_id").cast("string").alias("file_path"),
        F.lit(None).cast("string").alias("document_type"),
        parse.html_text(F.col("html")).alias("parsed_doc"),
    )


# --- sources, crypto, bronze ----------------------------------------------------------------


def file_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.file_name(F.col("url")).alias("file_name"))


def crypto_roundtrip(spark, sf):
    key = ephemeral_key(spark)
    sealed = documents(spark, sf, "doc_id", "text").select(
        "doc_id", "text", crypto.encrypt_bytes(F.col("text").cast("binary"), key).alias("cipher")
    )
    return sealed.select(
        "doc_id",
        F.octet_length("text").alias("plain_bytes"),
        F.octet_length("cipher").alias("encrypted_bytes"),
        (crypto.decrypt_bytes(F.col("cipher"), key).cast("string") == F.col("text")).alias("same"),
    )


def input_size_summary(spark, sf):
    key = ephemeral_key(spark)
    plain = documents(spark, sf, "doc_id", "source", "text").select(
        document_path().alias("path"), F.octet_length("text").cast("bigint").alias("length"), F.col("text").cast("binary").alias("content")
    )
    return files.size_summary(files.encrypted(plain, key))


def tampered_quarantine(spark, sf):
    """Spanish texts have their last byte flipped, French ones are cut below nonce and tag."""
    key = ephemeral_key(spark)
    source = documents(spark, sf, "doc_id", "source", "lang", "text")
    cipher = only(crypto.encrypt_bytes(F.col("text").cast("binary"), key), lambda c: c.isNotNull())
    sealed = source.select(document_path().alias("path"), "lang", cipher.alias("content"))
    size = F.octet_length("content")
    last = F.substring(F.hex(F.substr("content", size, F.lit(1))), 1, 2)
    flipped = F.concat(F.substr("content", F.lit(1), size - 1), F.when(last == "00", F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))))
    broken = sealed.select(
        "path",
        F.when(F.col("lang") == "es", flipped)
        .when(F.col("lang") == "fr", F.substr("content", F.lit(1), F.lit(10)))
        .otherwise(F.col("content")).alias("content"),
    ).select("path", F.octet_length("content").cast("bigint").alias("length"), "content")
    return bronze.quarantined(broken, key).select("file_path", "file_name", "reason")


def encrypted_files_roundtrip(spark, sf):
    """Texts written as ``.enc`` files, found and opened again by the file source."""
    key, folder = ephemeral_key(spark), scratch(spark, "enc")
    plain = documents(spark, sf, "doc_id", "source", "text").select(
        document_path().alias("path"), F.octet_length("text").cast("bigint").alias("length"), F.col("text").cast("binary").alias("content")
    )
    folders = -(-table(spark, sf, "documents").count() // files.FOLDER_FILES)
    files.write_files(files.encrypted(plain, key), folder, max(1, folders)).write.mode("overwrite").parquet(f"{folder}_written")
    return opened_files(spark, folder, max(1, folders), key)


def opened_files(spark, folder, folders, key, at_once=files.LISTED_FOLDERS):
    """The documents of files dealt to many folders, of a bounded number of folders at a time: the driver never lists all files."""
    written, opened = spark.read.parquet(f"{folder}_written"), scratch(spark, "opened")

    def store(paths):
        found = files.read_files(spark, paths) if paths else spark.createDataFrame([], FILES)
        docs = bronze.parsed(found, key, text_parser).select("file_name", "file_size", "document_type", _n_elements())
        docs.write.mode("append").parquet(opened)
        return docs.schema

    for paths in files.folder_groups(written, folder, folders, at_once) or [[]]:
        schema = store(paths)
        forget()
    return spark.read.schema(schema).parquet(opened)


def _n_elements() -> Column:
    return F.size("parsed_doc.document.elements").alias("n_elements")


def json_props(spark, sf):
    value = F.try_parse_json("props")
    return table(spark, sf, "events").select("event_id", F.try_variant_get(value, "$.k", "int").alias("k"))


def bronze_docs(spark, sf):
    docs, key = parsed_documents(spark, sf)
    stored = bronze.unsealed_docs(bronze.sealed_docs(docs, key), key)
    return stored.select(
        "file_name", "file_path", "file_size", "document_type",
        F.size("parsed_doc.document.pages").alias("n_pages"), _n_elements(),
    )


def elements_text(spark, sf):
    docs, key = parsed_documents(spark, sf)
    elements = bronze.explode_elements(bronze.unsealed_docs(bronze.sealed_docs(docs, key), key))
    return bronze.unsealed_elements(bronze.sealed_elements(elements, key), key).drop("extracted_at", "description")


def elements_html(spark, sf):
    return bronze.explode_elements(html_pages(spark, sf)).select(
        "file_path", "element_id", "element_type", "content", "page_id"
    )


def page_image_lookup(spark, sf):
    docs, _ = parsed_documents(spark, sf)
    return bronze.explode_elements(docs).select("file_path", "element_id", "page_id", "image_uri")


def empty_documents(spark, sf):
    """Conversations as documents of their assistant turns: one without any keeps a row of NULLs."""
    turns = table(spark, sf, "conversations")
    element = F.when(
        F.col("role") == "assistant",
        F.struct(
            F.col("turn").cast("int").alias("id"), F.lit("text").alias("type"), F.col("text").alias("content"),
            F.lit(None).cast("string").alias("description"),
            F.array(F.struct(F.array().cast("array<int>").alias("coord"), F.lit(0).alias("page_id"))).alias("bbox"),
        ),
    )
    # one row per turn, each its own document: grouping a conversation would collect it
    docs = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("file_name"),
        F.concat_ws("/", "conv_id", "turn").alias("file_path"),
        F.lit(None).cast("string").alias("document_type"),
        F.struct(
            F.struct(
                F.array().cast("array<struct<id: int, image_uri: string>>").alias("pages"),
                F.array_compact(F.array(element)).alias("elements"),
            ).alias("document")
        ).alias("parsed_doc"),
    )
    return bronze.explode_elements(docs).select("file_path", "element_id", "element_type", "content", "page_id")


def classify_by_name(spark, sf):
    name = text.file_name(document_path())
    return table(spark, sf, "documents").select(
        "doc_id", name.alias("file_name"), classify.by_name(name, tuple(CATEGORIES)).alias("document_type")
    )


def classify_language(spark, sf):
    return documents(spark, sf, "doc_id", "lang", "text").select(
        "doc_id", "lang", classify.language(F.col("text")).alias("predicted")
    )


def classify_confusion(spark, sf):
    return classify_language(spark, sf).groupBy("lang", "predicted").agg(F.count("*").alias("n"))


# --- PDF text layer ---------------------------------------------------------------------------


def document_pdfs(spark: SparkSession, sf: str) -> DataFrame:
    """Each text as the bytes of an uncompressed PDF: one stream per page, one show per line."""

    def show(line: Column, i: Column) -> Column:
        # the sign of a pound and the letter u with two dots are written as octal escapes, lines with signs beyond Latin-1 in UTF-16
        escaped = F.regexp_replace(F.regexp_replace(F.regexp_replace(line, r"[\\()]", r"\\$0"), "\u00a3", r"\\243"), "\u00fc", r"\\374")
        wide = F.concat(F.lit("<FEFF"), F.hex(F.encode(line, "UTF-16BE")), F.lit(">"))
        shown = F.when(line.rlike(r"[^\x{20}-\x{7e}\x{a0}-\x{ff}]"), wide).otherwise(F.concat(F.lit("("), escaped, F.lit(")")))
        first = i == 0
        return F.concat(
            F.lit("BT /"), F.when(first, F.lit("F2 18")).otherwise(F.lit("F1 10")), F.lit(" Tf "),
            F.when(first, F.lit("72")).otherwise(F.lit("82")), F.lit(" "),
            (F.lit(750) - (i % PDF_LINES) * 14).cast("string"), F.lit(" Td "), shown, F.lit(" Tj ET"),
        )

    def streams(lines: Column) -> Column:
        shows = F.transform(lines, show)
        n = F.floor((F.size(lines) + (PDF_LINES - 1)) / PDF_LINES).cast("int")
        return let(
            shows,
            lambda ops: F.transform(
                indices(n),
                lambda p: F.concat(
                    F.lit(" 0 obj\n<< >>\nstream\n"),
                    F.array_join(F.slice(ops, p * PDF_LINES + 1, F.lit(PDF_LINES)), "\n"),
                    F.lit("\nendstream\nendobj\n"),
                ),
            ),
        )

    body = F.array_join(let(F.split("text", "\n", -1), streams), "")
    pdf = F.encode(F.concat(F.lit("%PDF-1.4\n"), body, F.lit("%%EOF\n")), "ISO-8859-1")
    return documents(spark, sf, "doc_id", "text").select("doc_id", pdf.alias("content"))


def pdf_elements(spark, sf):
    found = parse.pdf_text(F.col("content"))["document"]["elements"]
    rows = document_pdfs(spark, sf).select("doc_id", F.explode(found).alias("e"))
    return rows.select(
        "doc_id", F.col("e.id").alias("element_id"), F.col("e.type").alias("element_type"),
        F.col("e.content").alias("content"), F.get("e.bbox", F.lit(0))["page_id"].alias("page_id"),
    )


def state_pdfs(spark: SparkSession, sf: str) -> DataFrame:
    """Each text as a PDF whose objects stand in reverse order with a picture between them; lines are set by matrix and leading, in two strings each."""
    escaped = lambda part: F.regexp_replace(part, r"[\\()]", r"\\$0")
    number = lambda page, n: (page * 3 + (10 + n)).cast("string")

    def show(line: Column) -> Column:
        half = F.floor(F.length(line) / 2).cast("int")
        left, right = F.substr(line, F.lit(1), half), F.substr(line, half + 1)
        wide = F.concat(F.lit("<FEFF"), F.hex(F.encode(line, "UTF-16BE")), F.lit("> Tj"))
        plain = F.concat(F.lit("[("), escaped(left), F.lit(") -20 ("), escaped(right), F.lit(")] TJ"))
        return F.when(line.rlike(r"[^\x{20}-\x{7e}\x{a0}-\x{ff}]"), wide).otherwise(plain)

    def objects(page: Column, lines: Column) -> Column:
        body = F.array_join(F.transform(F.slice(lines, page * PDF_LINES + 1, F.lit(PDF_LINES)), show), " T*\n")
        return F.concat(
            number(page, 2), F.lit(" 0 obj\n<< /Subtype /Image >>\nstream\nBT /F1 9 Tf 1 1 Td (picture) Tj ET\nendstream\nendobj\n"),
            number(page, 1), F.lit(" 0 obj\n<< /Length 0 >>\nstream\nq /F1 10 Tf BT 14 TL 1 0 0 1 82 750 Tm\n"), body, F.lit("\nET Q\nendstream\nendobj\n"),
            number(page, 0), F.lit(" 0 obj\n<< /Type /Page /Parent 2 0 R /Contents ["), number(page, 1), F.lit(" 0 R] >>\nendobj\n"),
        )

    def whole(lines: Column) -> Column:
        pages = indices(F.floor((F.size(lines) + (PDF_LINES - 1)) / PDF_LINES).cast("int"))
        kids = F.array_join(F.transform(pages, lambda p: F.concat(number(p, 0), F.lit(" 0 R"))), " ")
        tree = F.concat(F.lit("1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj\n2 0 obj\n<< /Type /Pages /Kids ["), kids, F.lit("] >>\nendobj\n"))
        return F.concat(F.lit("%PDF-1.4\n"), F.array_join(F.reverse(F.transform(pages, lambda p: objects(p, lines))), ""), tree, F.lit("%%EOF\n"))

    return documents(spark, sf, "doc_id", "text").select("doc_id", F.encode(let(F.split("text", "\n", -1), whole), "ISO-8859-1").alias("content"))


def pdf_text_state(spark, sf):
    """Every shown line with its place, from the page tree and the running state of text."""
    shown = items(state_pdfs(spark, sf), ["doc_id"], textlayer.shows(F.col("content")), "s").select("doc_id", "s.*")
    line = F.round((F.lit(750.0) - F.col("y")) / 14.0).cast("int")
    return shown.select("doc_id", F.col("page").alias("page_id"), line.alias("line_no"), "x", "y", "size", F.col("text").alias("shown"))


def pdf_words(spark, sf):
    rows = document_pdfs(spark, sf).select("doc_id", F.posexplode(parse.pdf_words(F.col("content"))).alias("pos", "w"))
    return rows.select(
        "doc_id", "pos", F.col("w.page").alias("page_id"), F.col("w.text").alias("word"),
        *[F.round(f"w.{c}", 3).alias(c) for c in ("x0", "y0", "x1", "y1")], F.col("w.fontname").alias("fontname"),
    )


# --- silver -------------------------------------------------------------------------------------


def format_elements(spark, sf):
    return silver.formatted(bronze.explode_elements(html_pages(spark, sf))).select(
        "file_path", "element_id", "formatted_content"
    )


_PAGE_COLUMNS = ["file_name", "file_path", "document_type", "page_id", "page_content", "element_count", "element_types", "image_uri"]


def silver_pages(spark, sf):
    """By aggregation, from stored elements to stored pages."""
    docs, key = parsed_documents(spark, sf)
    elements = bronze.unsealed_elements(bronze.sealed_elements(bronze.explode_elements(docs), key), key)
    return silver.unsealed_pages(silver.sealed_pages(silver.pages(elements), key), key).select(*_PAGE_COLUMNS)


def silver_pages_fused(spark, sf):
    """Straight from the parsed documents: no shuffle."""
    return clear_pages(spark, sf).select(*_PAGE_COLUMNS)


def stream_pages(spark, sf):
    """The ingest streams over the documents table, started anew and run until nothing is left."""
    key, target = ephemeral_key(spark), scratch(spark, "stream")
    source = table(spark, sf, "documents")
    # a glob, because a stream reads folders and the table may be a single file
    found = spark.readStream.schema(source.schema).option("pathGlobFilter", "*.parquet")
    name = f"{sf}/documents.parque[t]"
    rows = found.parquet(name).select("doc_id", "source", "text")
    ingest.ingest_docs(spark, ingest.documents_as_files(rows, document_path(), key), target, key, text_parser)
    ingest.ingest_elements(spark, target, key)
    ingest.ingest_pages(spark, target, key)
    stored = spark.read.parquet(f"{target}/{ingest.PAGES}")
    return silver.unsealed_pages(stored, key).select(*[c for c in _PAGE_COLUMNS if c != "image_uri"])


def stream_files(spark, sf):
    """Texts as ``.enc`` files, streamed from their folders in two runs; the second finds only what is new."""
    key, folder, target = ephemeral_key(spark), scratch(spark, "inbox"), scratch(spark, "bronze")
    source = documents(spark, sf, "doc_id", "source", "text")
    folders = files.folders_for(table(spark, sf, "documents"), document_path())
    globs = files.folder_globs(folder, folders)
    for half in (0, 1):
        plain = source.filter(F.pmod("doc_id", F.lit(2)) == half).select(
            document_path().alias("path"), F.octet_length("text").cast("bigint").alias("length"), F.col("text").cast("binary").alias("content")
        )
        files.write_files(files.encrypted(plain, key), folder, folders).write.mode("append").parquet(f"{target}/written")
        ingest.each_share(spark, globs, target, lambda glob, into: ingest.ingest_docs(spark, glob, into, key, text_parser))
    docs = bronze.unsealed_docs(ingest.shared_docs(spark, target, len(globs)), key)
    return docs.select("file_name", "file_size", "document_type", _n_elements())


def stream_files_archived(spark, sf):
    """The same in three runs over a landing folder; what a run has read goes to an archive in the next one."""
    key, folder, target = ephemeral_key(spark), scratch(spark, "landing"), scratch(spark, "bronze")
    archive = scratch(spark, "archive")
    source = documents(spark, sf, "doc_id", "source", "text")
    folders = files.folders_for(table(spark, sf, "documents"), document_path())
    globs = files.folder_globs(folder, folders)
    for third in (0, 1, 2):
        plain = source.filter(F.pmod("doc_id", F.lit(3)) == third).select(
            document_path().alias("path"), F.octet_length("text").cast("bigint").alias("length"), F.col("text").cast("binary").alias("content")
        )
        files.write_files(files.encrypted(plain, key), folder, folders).write.mode("append").parquet(f"{target}/written")
        ingest.each_share(spark, globs, target, lambda glob, into: ingest.ingest_docs(spark, glob, into, key, text_parser, archive=archive))
    docs = bronze.unsealed_docs(ingest.shared_docs(spark, target, len(globs)), key)
    there = listed_files(spark, folder, folders, spark.read.parquet(f"{target}/written")).select(F.col("path").alias("file_path"), F.lit(True).alias("left"))
    told = docs.join(there, "file_path", "left").withColumn("left_in_inbox", F.coalesce("left", F.lit(False)))
    return told.select("file_name", "file_size", "document_type", "left_in_inbox")


def listed_files(spark, folder, folders, written, at_once=files.LISTED_FOLDERS):
    """The paths of the files that are in the folders now, of a bounded number of folders at a time."""
    listed = scratch(spark, "listed")
    for paths in files.folder_groups(written, folder, folders, at_once):
        files.read_files(spark, paths).select("path").write.mode("append").parquet(listed)
        forget()
    return spark.read.schema("path STRING").parquet(listed) if versions.exists(spark, listed) else spark.createDataFrame([], "path STRING")


def stream_view(spark, sf):
    """Elements that arrive in two runs, half of each page at a time, and the page view kept in step; the last batch is played twice."""
    docs, key = parsed_documents(spark, sf)
    target, into = scratch(spark, "elements"), scratch(spark, "view")
    folder = f"{target}/{ingest.ELEMENT_TABLE}"
    elements = bronze.sealed_elements(bronze.explode_elements(docs), key)
    for half in (0, 1):
        elements.filter(F.pmod("element_id", F.lit(2)) == half).write.mode("append").parquet(folder)
        ingest.maintain_pages(spark, target, key, into)
    ingest.renew_pages(spark.read.schema(ELEMENTS).parquet(folder), buckets.last_batch(spark, into), target, key, into)
    return silver.unsealed_pages(ingest.maintained_pages(spark, into), key).select(*_PAGE_COLUMNS)


def pages_in_order(spark, sf):
    """The sorted view, and whether each page stands behind the one before it in its partition."""
    shown = silver.in_order(clear_pages(spark, sf)).select("file_name", "page_id").withColumn("at", F.monotonically_increasing_id())
    before = Window.partitionBy(F.shiftright("at", 33)).orderBy("at")
    place = F.struct("file_name", "page_id")
    return shown.select("file_name", "page_id", F.coalesce(F.lag(place).over(before) <= place, F.lit(True)).alias("in_order"))


# --- personal data -----------------------------------------------------------------------------


def detected(spark: SparkSession, sf: str) -> DataFrame:
    return detect.with_entities(documents(spark, sf, "doc_id", "text"), "text")


def pii_entities(spark, sf):
    return detect.entity_rows(detected(spark, sf), ["doc_id"])


def pii_counts(spark, sf):
    return detect.entity_counts(detected(spark, sf), ["doc_id"])


def pii_by_category(spark, sf):
    rows = items(detected(spark, sf), [], "entities.category", "category")
    return rows.groupBy("category").agg(F.count("*").alias("n_entities"))


def documents_with_pii(spark, sf):
    found = detect.with_entities(documents(spark, sf, "doc_id", "source", "text"), "text")
    return detect.entity_counts(found, ["doc_id", "source"]).drop("n_entities")


def mask_replace(spark, sf):
    return documents(spark, sf, "doc_id", "text").select("doc_id", pii.mask_in_text(F.col("text")).alias("masked"))


def _mask_one(category: str):
    def query(spark, sf):
        masked = pii.mask_in_text(F.col("text"), (category,))
        return documents(spark, sf, "doc_id", "text").select("doc_id", masked.alias("masked"))

    return query


def mask_same_length(spark, sf):
    masked = pii.mask_in_text(F.col("text"), pii.ORDER, pii.mask_same_length, everywhere=())
    return documents(spark, sf, "doc_id", "text").select("doc_id", masked.alias("masked"))


def parse_response(spark, sf):
    """Model answers of every kind, made from the documents: well formed, noisy, broken, none."""
    lang = F.col("lang")
    response = (
        F.when(
            lang == "en",
            F.concat(
                F.lit('Found: [{"original": "'), "source",
                F.lit('", "masked": "****", "category": "CODE"}, "noise", {"x": 1}, {"original": null, "masked": "*"}] as asked'),
            ),
        )
        .when(lang == "de", F.concat(F.lit('[{"original": '), "doc_id", F.lit(', "masked": "*"}]')))
        .when(lang == "fr", F.lit("nothing found"))
        .otherwise(F.concat(F.lit('[{"original": "'), "doc_id", F.lit('", ]')))
    )
    answers = table(spark, sf, "documents").select("doc_id", detect.answered(response).alias("entities"))
    return detect.entity_rows(answers, ["doc_id"])


def detection_inputs(spark, sf):
    """What a model is asked to detect in: Spanish texts are blanked first, and blank pages are not asked about."""
    docs = documents(spark, sf, "doc_id", "lang", "text")
    blank = F.when(F.col("lang") == "es", F.lit(" \n\t ")).otherwise(F.col("text"))
    asked = detect.detection_input(docs.select("doc_id", blank.alias("page_content")), ["doc_id"])
    return asked.select("doc_id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("prompt_chars"))


def _mapped(spark: SparkSession, sf: str, **options) -> DataFrame:
    return redact.with_redactions(redact.with_words(detected(spark, sf), "text"), **options)


def map_words(spark, sf):
    return redact.redaction_rows(_mapped(spark, sf), ["doc_id"])


def split_mask(spark, sf):
    """Masks without blanks have too few tokens, so they are cut by the lengths of the words."""
    pages = redact.with_words(detected(spark, sf), "text")
    tight = F.transform(
        "entities",
        lambda e: F.struct(e["original"], F.replace(e["masked"], F.lit(" "), F.lit("")).alias("masked"), e["category"]),
    ).cast(f"array<{ENTITY}>")
    return redact.redaction_rows(redact.with_redactions(pages.withColumn("entities", tight)), ["doc_id"])


def redacted_text(spark, sf):
    return redact.redacted_text(_mapped(spark, sf), "text").select("doc_id", "redacted")


def redaction_total(spark, sf):
    return redact.redaction_count(_mapped(spark, sf))


def leak_check(spark, sf):
    """Leaks left by masking the first run of each entity only."""
    done = redact.redacted_text(_mapped(spark, sf), "text")
    return redact.leaks(done, ["doc_id"])


def leak_check_safe(spark, sf):
    """Per document with personal data: what the safe choices leave."""
    done = redact.redact(detected(spark, sf), "text")
    shown = F.size(redact.leaked(F.col("redacted"), F.col("entities")))
    found = F.explode(F.filter(F.array(F.struct(F.size("entities").alias("n"), shown.alias("left"))), lambda c: c["n"] > 0))
    return done.select("doc_id", found.alias("c")).select(
        "doc_id", F.col("c.n").cast("bigint").alias("n_entities"), F.col("c.left").cast("bigint").alias("n_leaks")
    )


def leak_control(spark, sf):
    """The check on text that was never redacted: it must find every entity."""
    return redact.leaks(detected(spark, sf), ["doc_id"], "text")


def documents_with_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every document followed by a record made from its id: all fifteen classes, and a name once more without its cue."""
    n = F.col("doc_id").cast("string")
    four = F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0")
    record = F.concat(
        F.lit("\nContact: Ann Lee\nMobile 415-555-"), four, F.lit(", SSN 219-09-"), four, F.lit(", mail u"), n, F.lit("@post.example.net, host 10.0.0."),
        (F.col("doc_id") % 250).cast("string"), F.lit("\nDOB:     1/2/1977, age "), (F.col("doc_id") % 70 + 20).cast("string"),
        F.lit(", passport no. K"), F.lpad(n, 7, "3"), F.lit("XY, driver licence no. D-"), F.lpad(n, 6, "8"), F.lit("\nAccount number:\n"), F.lpad(n, 20, "7"),
        F.lit(", MRN: Q"), n, F.lit(", national id N"), n, F.lit("\nCompany: Nordic Lamp\ncard 5105 1051 0510 "), four,
        F.lit(", at 6 Mill Lane, Portland, OR 97205 with Ann Lee"),
    )
    return documents(spark, sf, "doc_id", "text").withColumn("text", F.concat("text", record))


def pii_all_classes(spark, sf):
    return detect.entity_rows(detect.with_entities(documents_with_records(spark, sf), "text"), ["doc_id"])


def pii_forms(spark, sf):
    """Spellings of the classes on a record of their own, made from each id."""
    n = F.col("doc_id").cast("string")
    four = F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0")
    record = F.concat(
        F.lit("J\u00f6rg wrote from j\u00f6rg"), n, F.lit("@m\u00fcller.example.de about Dr. Okoro,\nwho called +44 20 7946 "), four, F.lit(" from "), n,
        F.lit("234567 Oak Tree Hill Park View Street, New Port Saint Mary Bay, ME 04101; id 412 55 "), four, F.lit(", card 3056 930902 "), four, F.lit("."),
    )
    return detect.entity_rows(detect.with_entities(documents(spark, sf, "doc_id").select("doc_id", record.alias("text")), "text"), ["doc_id"])


def pii_all_by_category(spark, sf):
    rows = items(detect.with_entities(documents_with_records(spark, sf), "text"), [], "entities.category", "category")
    return rows.groupBy("category").agg(F.count("*").alias("n_entities"))


def leak_check_records(spark, sf):
    """Names that stand twice leak when only their first run is masked."""
    found = redact.with_words(detect.with_entities(documents_with_records(spark, sf), "text"), "text")
    return redact.leaks(redact.redacted_text(redact.with_redactions(found), "text"), ["doc_id"])


def leak_check_many(spark, sf):
    """Thousands of entities a page: every 24th place of a page's html gives one of seven characters; the output hides digits."""
    places = indices(F.floor(F.length("html") / 24).cast("int"))
    original = F.array_distinct(F.transform(places, lambda n: F.substr("html", n * 24 + 1, F.lit(7))))
    entities = F.transform(original, lambda o: F.struct(o.alias("original"), F.lit("x").alias("masked"), F.lit("ANY").alias("category")))
    html = text_table(spark, sf, "pages", "page_id", "html").filter(F.length("html") >= 24)
    pages = html.select("page_id", F.regexp_replace("html", "[0-9]", "#").alias("redacted"), entities.alias("entities"))
    shown = F.size(redact.leaked(F.col("redacted"), F.col("entities"))).cast("bigint")
    return pages.select("page_id", F.size("entities").cast("bigint").alias("n_entities"), shown.alias("n_leaks"))


def model_masked_gold(spark, sf):
    """Gold by a masking step on batches; the stand-in for a model hides digits."""
    hide = lambda batch: [re.sub("[0-9]", "#", asked.split("Text:\n", 1)[1]) for asked in batch]
    return gold.masked_pages(clear_pages(spark, sf), masked=lambda pages: modelhook.masked(pages, hide)).select("chunk_id", "page_content_masked")


def model_entities(spark, sf):
    """Entities from a model's answers; the stand-in finds the first number and names it, or answers no JSON at all."""

    def answer(asked: str) -> str:
        found = re.search("[0-9]+", asked.rsplit("Text:\n", 1)[1])
        return f'Sure: [{{"original": "{found[0]}", "masked": "{"*" * len(found[0])}", "category": "NUMBER"}}]' if found else "none"

    pages = documents(spark, sf, "doc_id", "text").withColumnRenamed("text", "page_content")
    return detect.entity_rows(modelhook.entities(pages, lambda batch: [answer(a) for a in batch]), ["doc_id"])


def model_judged(spark, sf):
    """A judge's verdicts; the stand-in says yes to answers longer than their question, and nothing usable to very long ones."""

    def verdict(case: str) -> str:
        told = json.loads(case)
        return "It depends" if len(told["answer"]) > 2000 else " Yes" if len(told["answer"]) > len(told["question"]) else "no"

    judged = modelhook.judged(conversation_rows(spark, sf), "longer", lambda batch: [verdict(c) for c in batch], ("question", "answer"))
    return judged.select("conv_id", "turn", "longer")


def model_classified(spark, sf):
    """Documents classified by a model from their names; the stand-in knows endings, and one label that is not asked for."""
    names = documents(spark, sf, "doc_id", "source").select("doc_id", text.file_name(document_path()).alias("file_name"))
    told = modelhook.classified(names, lambda batch: [" HR" if "_hr." in n else "memo" if "_memo." in n else "support" if "_support." in n else None for n in batch], CATEGORIES)
    return told.select("doc_id", "file_name", "document_type")


def model_embedded(spark, sf):
    """An index whose vectors a model makes, built and synced; the stand-in counts characters and words."""
    folder = scratch(spark, "index")
    call = lambda batch: [[float(len(t)), float(len(t.split(" ")))] for t in batch]

    def rows(source: DataFrame) -> DataFrame:
        hashed = source.withColumn("content_hash", vectors.content_hash(F.col("page_content_masked")))
        return modelhook.embedded(hashed, call, "page_content_masked")

    for changed in (False, True):
        vectors.sync_index(_chunks(spark, sf, changed), folder, rows=rows)
    return vectors.read_index(spark, folder).select("chunk_id", F.get("embedding", F.lit(0)).alias("chars"), F.get("embedding", F.lit(1)).alias("words"))


def model_requests(spark, sf):
    """Texts asked about in two runs over one table of answers. The stand-in fails on French at first, so only those are asked again."""
    docs = documents(spark, sf, "doc_id", "lang", "text").withColumn("request", F.concat_ws(" ", "lang", F.length("text").cast("string")))
    folder = scratch(spark, "answers")

    def call(batch, broken: bool):
        if broken and any(r.startswith("fr") for r in batch):
            raise RuntimeError("no French today")
        return [r.upper() for r in batch]

    first = modelhook.asked(docs, folder, lambda batch: call(batch, True), "request", "answer", batch_rows=1)
    failed = first.filter("error IS NOT NULL").groupBy("lang").agg(F.countDistinct("request").alias("failed"))
    failed.write.parquet(f"{folder}_failed")
    second = modelhook.asked(docs, folder, lambda batch: call(batch, False), "request", "answer")
    told = modelhook.answers(spark, folder).agg(F.count("*").alias("n_requests")).crossJoin(spark.read.parquet(f"{folder}_failed"))
    return second.join(F.broadcast(told), "lang", "left").select("doc_id", "answer", "error", "failed", "n_requests")


def model_batches(spark, sf):
    """The model hook with a stand-in model that tells the number of characters."""
    rows = documents(spark, sf, "doc_id", "text")
    told = modelhook.map_batches(rows, lambda s: s.str.len().tolist(), "text", "n_chars", "bigint")
    return told.select("doc_id", "n_chars", F.col("error").isNull().alias("answered"))


# --- gold ----------------------------------------------------------------------------------------


def gold_pages(spark, sf):
    docs, key = parsed_documents(spark, sf)
    stored = silver.sealed_pages(silver.pages_of(docs), key)
    return gold.masked_pages(silver.unsealed_pages(stored, key))


def gold_summary(spark, sf):
    return gold.summary(gold.masked_pages(clear_pages(spark, sf)))


def gold_unrouted(spark, sf):
    return gold.unrouted(clear_pages(spark, sf))


def gold_published(spark, sf):
    """Written by category and summed up from what was written."""
    folder = scratch(spark, "gold")
    gold.publish(gold.masked_pages(clear_pages(spark, sf)), folder)
    return gold.summary(gold.published(spark, folder))


def gold_tables(spark, sf):
    """One view per published category, each read by its name."""
    names = gold.publish_tables(gold.masked_pages(clear_pages(spark, sf)), scratch(spark, "gold"), "gold")
    shown = [spark.table(n).groupBy(F.lit(n).alias("name")).agg(F.count("*").alias("n_pages"), F.max("document_type").alias("document_type")) for n in names]
    return reduce(DataFrame.unionByName, shown)


def gold_file_names(spark, sf):
    """A name told by a cue on a file's first page and without one behind its last line."""
    name = F.concat(F.lit("Zara Quill"), F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij"))
    key = ephemeral_key(spark)
    docs = documents(spark, sf, "doc_id", "source", "text").withColumn("text", F.concat(F.lit("Contact: "), name, F.lit("\n"), "text", F.lit("\nas "), name, F.lit(" said")))
    pages = silver.pages_of(bronze.parsed(ingest.documents_as_files(docs, document_path(), key), key, text_parser))
    return gold.masked_files(pages).select("chunk_id", "page_id", "page_content_masked")


def gold_incremental(spark, sf):
    """Gold kept in step over three runs: of English pages, of all with German files moved to support, and of all but Spanish ones."""
    # languages go with the texts, which a join would shuffle; only rows that share an id are joined, each with the languages of all
    ids = table(spark, sf, "documents").select("doc_id", "lang")
    shared = ids.join(ids.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "doc_id", "left_semi")
    shared = stored(shared.select("doc_id", F.col("lang").alias("other"), F.lit(True).alias("shared")), "shared")
    rows = documents(spark, sf, "doc_id", "source", "lang", "text").filter("doc_id IS NOT NULL AND source IS NOT NULL").join(shared, "doc_id", "left")
    spoken = rows.withColumn("lang", F.when(F.col("shared"), F.col("other")).otherwise(F.col("lang")))

    def pages(which: str) -> DataFrame:
        return silver.pages_of(parsed_documents(spark, sf, spoken.filter(which))[0])

    moved = pages("lang = 'de'").withColumn("document_type", F.lit("support"))
    folder = scratch(spark, "gold")
    for kept in (pages("lang = 'en'"), moved.unionByName(pages("lang IS NULL OR lang <> 'de'")), moved.unionByName(pages("lang NOT IN ('de', 'es')"))):
        gold.sync(kept, folder, "stand-in for a secret")
    return gold.published(spark, folder)


# --- vectors --------------------------------------------------------------------------------------


def _chunks(spark: SparkSession, sf: str, changed: bool) -> DataFrame:
    """Documents as an indexed source: before and after French ones came, Spanish ones went and German ones changed."""
    docs = documents(spark, sf, "doc_id", "source", "lang", "text")
    kept = docs.filter(F.col("lang") != ("es" if changed else "fr"))
    body = F.when(F.col("lang") == "de", F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text")) if changed else F.col("text")
    return kept.select(gold.chunk_id(document_path(), F.lit(0)).alias("chunk_id"), body.alias("page_content_masked"))


def _embed(value: Column) -> Column:
    return vectors.embed_hashed(value, DIM, "md5")


def index_diff(spark, sf):
    index = _chunks(spark, sf, False).select("chunk_id", vectors.content_hash(F.col("page_content_masked")).alias("content_hash"))
    return vectors.index_diff(_chunks(spark, sf, True), index)


def index_synced(spark, sf):
    """Created, then synced with the changed source; read from where it was written."""
    folder = scratch(spark, "index")
    vectors.sync_index(_chunks(spark, sf, False), folder, _embed)
    vectors.sync_index(_chunks(spark, sf, True), folder, _embed)
    return vectors.read_index(spark, folder).select("chunk_id", "content_hash", F.size("embedding").alias("dim"))


def index_synced_buckets(spark, sf):
    """The change feed of an index over three syncs, of which the last changes nothing."""
    folder = scratch(spark, "index")
    for changed in (False, True, True):
        vectors.sync_index(_chunks(spark, sf, changed), folder, _embed)
    return vectors.read_changes(spark, folder)


def index_precondition(spark, sf):
    """Per category: ready for an index, or the error."""
    pages, told = gold.masked_pages(clear_pages(spark, sf)), []
    for category in CATEGORIES:
        try:
            vectors.source_ready(pages.filter(F.col("document_type") == category), category)
            told.append((category, "ready"))
        except ValueError as error:
            told.append((category, str(error)))
    return spark.createDataFrame(told, "document_type string, state string")


def index_synced_nulls(spark, sf):
    """Three syncs with pages that have no text: English ones never, German ones from the second on."""
    folder = scratch(spark, "index")
    source = documents(spark, sf, "doc_id", "source", "lang", "text").withColumn("chunk_id", gold.chunk_id(document_path(), F.lit(0)))
    for blank in (["en"], ["en", "de"], ["en", "de"]):
        body = F.when(~F.col("lang").isin(blank), F.col("text"))
        vectors.sync_index(source.select("chunk_id", body.alias("page_content_masked")), folder, _embed)
    return vectors.read_index(spark, folder).select("chunk_id", "content_hash", F.size("embedding").alias("dim"))


def embed_hashed(spark, sf):
    vector = documents(spark, sf, "doc_id", "text").select("doc_id", _embed(F.col("text")).alias("vector"))
    return items(vector, ["doc_id"], "vector", "weight", "place").filter(F.col("weight") > 0).select("doc_id", "place", F.round(F.col("weight").cast("double"), 5).alias("weight"))


def _centroids(spark: SparkSession, sf: str) -> DataFrame:
    """The mean vector of each label: sums per label and place, combined before the shuffle."""
    cells = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("place", "value"))
    means = cells.groupBy("label", "place").agg(F.avg(F.col("value").cast("double")).alias("mean"))
    return means.groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("place", "mean")))["mean"].alias("embedding")
    )


def knn_topk(spark, sf):
    """The vectors nearest to the mean of each label."""
    found = vectors.knn(table(spark, sf, "embeddings"), _centroids(spark, sf), TOP_K, query=("label", "embedding"))
    return _shown(found)


def knn_topk_blocks(spark, sf):
    """The same, as if the queries were too many to be handed to every executor."""
    found = vectors.knn(
        spread(table(spark, sf, "embeddings")), _centroids(spark, sf), TOP_K, query=("label", "embedding"),
        broadcast_bytes=2048,
    )
    return _shown(found)


def _shown(found: DataFrame) -> DataFrame:
    return found.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def retrieve_documents(spark, sf):
    """The documents closest to each benchmark text."""
    index = documents(spark, sf, "doc_id", "text").select("doc_id", _embed(F.col("text")).alias("embedding"))
    asked = table(spark, sf, "benchmark").select("item_id", _embed(F.col("text")).alias("embedding"))
    return _shown(vectors.knn(index, asked, TOP_K, ("doc_id", "embedding"), ("item_id", "embedding")))


# --- evaluation -----------------------------------------------------------------------------------


def conversation_rows(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.conversation_pairs(table(spark, sf, "conversations"))


def eval_pairs(spark, sf):
    shaped = evaluate.pairs(conversation_rows(spark, sf))
    message = F.get("inputs.input", F.lit(0))
    return shaped.select(
        "conv_id", "turn", message["role"].alias("role"), message["content"].alias("question"),
        F.col("expectations.expected_response").alias("expected"),
    )


def eval_csv_roundtrip(spark, sf):
    folder = scratch(spark, "eval")
    rows = conversation_rows(spark, sf).select(
        F.concat_ws("-", "conv_id", "turn").alias("filename"), "question", "answer"
    )
    evalset.write_eval_csv(rows, folder)
    return evalset.read_eval_csv(spark, folder)


def concise_response(spark, sf):
    turns = table(spark, sf, "conversations").filter("role = 'assistant'")
    return turns.select("conv_id", "turn", evaluate.concise(F.col("text")).alias("concise_response"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """The turn before the question is its context; without expected answers the question stands in."""
    turns = table(spark, sf, "conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("context"))
    rows = conversation_rows(spark, sf).join(before, ["conv_id", "turn"], "left")
    return evaluate.scored(rows.withColumn("expected", F.col("question")), ["conv_id", "turn"])


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of which some answers evade, some expected answers are the question, the answer or another's question, and some contexts hold the answer."""
    rows = conversation_rows(spark, sf)
    other = rows.select((F.col("conv_id") + 1).alias("conv_id"), "turn", F.col("question").alias("other"))
    kind = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3))
    answer = F.when(F.pmod("conv_id", F.lit(5)) == 0, F.concat(F.lit("I cannot help. "), F.col("question"))).otherwise(F.col("answer"))
    expected = F.when(kind == 0, F.col("question")).when(kind == 1, F.col("answer")).otherwise(F.col("other"))
    context = F.when(F.pmod("conv_id", F.lit(2)) == 0, F.concat_ws(" ", "question", "answer", "other")).otherwise(F.col("other"))
    return rows.join(other, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "question", expected.alias("expected"), context.alias("context"), answer.alias("answer")
    )


def eval_scores_mixed(spark, sf):
    keys = ["conv_id", "turn"]
    return evaluate.long_form(evaluate.scored(_mixed(spark, sf), keys), keys)


def eval_metrics_mixed(spark, sf):
    table_ = evaluate.scored(_mixed(spark, sf), ["conv_id", "turn"])
    return evaluate.metrics(table_, ["conv_id", "turn"]).withColumn("share_yes", F.round("share_yes", 6))


def eval_scores(spark, sf):
    return evaluate.long_form(_scored(spark, sf), ["conv_id", "turn"])


def eval_metrics(spark, sf):
    return evaluate.metrics(_scored(spark, sf), ["conv_id", "turn"]).withColumn("share_yes", F.round("share_yes", 6))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "file_names": file_names,
    "crypto_roundtrip": crypto_roundtrip,
    "input_size_summary": input_size_summary,
    "tampered_quarantine": tampered_quarantine,
    "encrypted_files_roundtrip": encrypted_files_roundtrip,
    "json_props": json_props,
    "bronze_docs": bronze_docs,
    "elements_text": elements_text,
    "elements_html": elements_html,
    "page_image_lookup": page_image_lookup,
    "empty_documents": empty_documents,
    "classify_by_name": classify_by_name,
    "classify_language": classify_language,
    "classify_confusion": classify_confusion,
    "pdf_elements": pdf_elements,
    "pdf_words": pdf_words,
    "pdf_text_state": pdf_text_state,
    "format_elements": format_elements,
    "silver_pages": silver_pages,
    "silver_pages_fused": silver_pages_fused,
    "stream_pages": stream_pages,
    "stream_files": stream_files,
    "stream_files_archived": stream_files_archived,
    "stream_view": stream_view,
    "pages_in_order": pages_in_order,
    "detection_inputs": detection_inputs,
    "pii_entities": pii_entities,
    "pii_counts": pii_counts,
    "pii_by_category": pii_by_category,
    "documents_with_pii": documents_with_pii,
    "mask_replace": mask_replace,
    "mask_emails": _mask_one("EMAIL"),
    "mask_cards": _mask_one("CREDIT_CARD"),
    "mask_phones": _mask_one("PHONE_NUMBER"),
    "mask_same_length": mask_same_length,
    "parse_response": parse_response,
    "map_words": map_words,
    "split_mask": split_mask,
    "redacted_text": redacted_text,
    "redaction_total": redaction_total,
    "leak_check": leak_check,
    "leak_check_safe": leak_check_safe,
    "leak_control": leak_control,
    "pii_all_classes": pii_all_classes,
    "pii_all_by_category": pii_all_by_category,
    "pii_forms": pii_forms,
    "leak_check_records": leak_check_records,
    "leak_check_many": leak_check_many,
    "model_batches": model_batches,
    "model_masked_gold": model_masked_gold,
    "model_entities": model_entities,
    "model_requests": model_requests,
    "model_judged": model_judged,
    "model_classified": model_classified,
    "model_embedded": model_embedded,
    "gold_pages": gold_pages,
    "gold_summary": gold_summary,
    "gold_unrouted": gold_unrouted,
    "gold_published": gold_published,
    "gold_tables": gold_tables,
    "gold_incremental": gold_incremental,
    "gold_file_names": gold_file_names,
    "index_diff": index_diff,
    "index_synced": index_synced,
    "index_synced_nulls": index_synced_nulls,
    "index_synced_buckets": index_synced_buckets,
    "index_precondition": index_precondition,
    "embed_hashed": embed_hashed,
    "knn_topk": knn_topk,
    "knn_topk_blocks": knn_topk_blocks,
    "retrieve_documents": retrieve_documents,
    "eval_pairs": eval_pairs,
    "eval_csv_roundtrip": eval_csv_roundtrip,
    "concise_response": concise_response,
    "eval_scores": eval_scores,
    "eval_metrics": eval_metrics,
    "eval_scores_mixed": eval_scores_mixed,
    "eval_metrics_mixed": eval_metrics_mixed,
}
