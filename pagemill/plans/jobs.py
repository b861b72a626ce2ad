"""The three jobs, each a chain of stages with a table at the ends that are stored."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import crypto, parse, pii
from ..functions.binding import items, runs
from ..operators import detect, evaluate, gold, redact, silver, vectors
from ..operators.bronze import Parser
from ..sources import evalset, files, versions
from ..streaming import ingest

INDEXED_CATEGORY = "finance"

# A step of a job: pages in, pages with one more column out.
Stage = Callable[[DataFrame], DataFrame]

REDACTED_ROWS = (
    "path STRING, page_id INT, redacted STRING, reason STRING, boxes ARRAY<STRUCT<ent: INT, pos: INT, x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, "
    "y1: DOUBLE, fontname: STRING, fontsize: DOUBLE, category: STRING, masked: STRING>>, leaks ARRAY<STRING>, sealed_page STRING"
)


@dataclass
class Published:
    """Where a run left its results."""

    pages: DataFrame
    gold_path: str
    summary: DataFrame
    unrouted: DataFrame
    index_version: int | None


def with_words_entities(pages: DataFrame) -> DataFrame:
    return detect.with_entities(pages)


def build_gold(spark: SparkSession, pages: DataFrame, key: bytes, path: str, masked: Stage | None = None) -> DataFrame:
    """Masked pages of all categories, of which only new and changed ones are masked and written; returns what is published.

    ``masked`` is a model's step: it adds ``page_content_masked`` and ``error``. What failed is not
    published; ``unmasked`` gives it from the same step.
    """
    gold.sync(silver.unsealed_pages(pages, key), path, hashlib.sha256(b"gold" + key).hexdigest(), masked=masked)
    return gold.published(spark, path)


def files_to_index(
    spark: SparkSession,
    source: str,
    target: str,
    key: bytes,
    parser: Parser = parse.pdf_text,
    embed: Callable[[Column], Column] = vectors.embed_hashed,
    category: str = INDEXED_CATEGORY,
    masked: Stage | None = None,
) -> Published:
    """New files to bronze and silver, silver to gold, one category of gold to its index."""
    pages = ingest.refresh(spark, source, target, key, parser)
    gold_path = f"{target}/gold"
    published = build_gold(spark, pages, key, gold_path, masked)
    indexed = gold.category_pages(spark, gold_path, category)
    version = vectors.sync_index(indexed, f"{target}/index_{category}", embed, f"gold {category}")
    clear = silver.unsealed_pages(pages, key)
    return Published(pages, gold_path, gold.summary(published), gold.unrouted(clear), version)


def redact_folder(
    spark: SparkSession, source: str, target: str, glob: str = "*.pdf", repeat: bool = True, loose: bool = True,
    gate: bool = True, entities: Stage = with_words_entities, key: bytes | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """PDFs of a folder to redacted page text, boxes and leaks, keyed by document and page.

    Stored once under ``target`` without any raw text: redacted text, masks with their boxes, and the classes of
    what still shows. With a ``key`` the raw page is stored too, sealed. A document without readable
    words keeps a row with the reason. ``gate`` withholds the text of pages that leak. ``entities``
    finds the personal data of pages; a model takes its place as ``modelhook.entities`` does.
    """
    found = files.read_files(spark, source, glob).select(
        "path", "length", F.col("content").isNull().alias("unread"), F.explode_outer(_pages_with_boxes(parse.pdf_words(F.col("content")))).alias("page")
    )
    none = F.array().cast(found.schema["page"].dataType["boxes"].dataType)
    boxes = F.coalesce("page.boxes", none)
    pages = found.select(
        "path",
        F.col("page.page_id").alias("page_id"),
        boxes.alias("boxes"),
        boxes["text"].alias("words"),
        F.array_join(boxes["text"], " ").alias("page_content"),
        F.when(F.col("unread"), F.lit("not read: too large")).when(F.col("page").isNull(), F.lit("no readable text layer")).alias("reason"),
    )
    hits = redact.with_redactions(entities(pages), "words", repeat, loose, keep_punctuation=True)
    done = redact.with_leaked(redact.redacted_text(hits, "page_content")).withColumn("leaks", F.col("leaked")["category"])
    raw = F.lit(None).cast("string") if key is None else crypto.seal(F.to_json(F.struct("page_content", "entities", "boxes")), key)
    shown = F.when(F.lit(not gate) | (F.size("leaks") == 0), F.col("redacted"))
    reason = F.when(shown.isNull(), F.lit("withheld: personal data still shows")).otherwise(F.col("reason"))
    kept = done.select("path", "page_id", shown.alias("redacted"), reason.alias("reason"), redact.boxes_of(done).alias("boxes"), "leaks", raw.alias("sealed_page"))
    versions.write_next(kept, target)
    stored = versions.read_latest(spark, target, REDACTED_ROWS)
    keys = ["path", "page_id"]
    box = items(stored, keys, "boxes", "b", "n").select(*keys, "b.*").filter((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))
    return stored.select(*keys, "redacted", "reason"), box, items(stored, keys, "leaks", "category", "n").drop("n")


def _pages_with_boxes(found: Column) -> Column:
    """Words of a document, in order, cut into its pages."""
    return F.transform(
        runs(found, lambda a, b: a["page"] != b["page"]),
        lambda page: F.struct(F.get(page, F.lit(0))["page"].alias("page_id"), page.alias("boxes")),
    )


def redact_texts(
    pages: DataFrame, text: str = "page_content", repeat: bool = True, loose: bool = True
) -> DataFrame:
    """Pages of text with ``entities`` and ``redacted``."""
    return redact.redact(detect.with_entities(pages, text), text, repeat, loose)


def evaluate_answers(
    spark: SparkSession, eval_csv: str, answers: DataFrame, context: DataFrame | None = None, judges: Stage | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per-answer scores and their metrics for an evaluation set and a table of given answers.

    ``answers`` holds (question, outputs), ``context`` (question, context) with a ``rank`` if there is one.
    Scores are keyed by file, question and answer. ``judges`` adds yes/no columns of a model, see ``modelhook.judged``.
    """
    rows = evaluate.with_answers(evalset.read_eval_csv(spark, eval_csv), answers, context)
    kind = dict(rows.dtypes)["outputs"]
    given = evaluate.answer_text(F.col("outputs"), kind)
    ready = rows.select(
        "filename", "question", "answer_id", given.alias("answer"), F.col("answer").alias("expected"),
        (F.col("context") if context is not None else F.lit("")).alias("context"),
    )
    keys = ["filename", "question", "answer_id"]
    chosen = evaluate.scorers()
    if judges is not None:
        before = set(ready.columns)
        ready = judges(ready)
        chosen |= {c: F.col(c) for c in ready.columns if c not in before and not c.endswith("_error")}
    table = evaluate.scored(ready, keys, chosen)
    return evaluate.long_form(table, keys), evaluate.metrics(table, keys)


def retrieve(
    questions: DataFrame, index: DataFrame, k: int, embed: Callable[[Column], Column] = vectors.embed_hashed
) -> DataFrame:
    """Best pages of an index for (query_id, question): (query_id, id, score, rank)."""
    asked = questions.select("query_id", embed(F.col("question")).alias("embedding"))
    return vectors.knn(index, asked, k, vec=("chunk_id", "embedding"))


def masked_everywhere(text: Column) -> Column:
    """Publish mask over all fifteen classes, the same-length style for those without one of their own."""
    mask = lambda value, category: F.when(
        category.isin(*pii.PUBLISHED), pii.mask_replace(value, category)
    ).otherwise(pii.mask_same_length(value, category))
    return pii.mask_in_text(text, pii.ORDER, mask)
