"""Masked pages, published by category."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import pii
from ..functions.binding import items, only
from ..schemas import CATEGORIES, GOLD, GOLD_ROWS
from ..session import stored
from ..sources import buckets, versions

# Folders of a category in a gold table that is kept in step with its pages.
BUCKETS = 16
_PARTS = ["document_type", "bucket"]
_SYNCED = f"{GOLD_ROWS}, source_hash STRING, bucket INT"


def chunk_id(path: Column, page: Column) -> Column:
    """Stable key of a page, so that an index can tell a changed page from a new one."""
    return F.sha2(F.concat(path, F.lit("#"), F.coalesce(page.cast("string"), F.lit(""))), 256)


def masked_pages(
    pages: DataFrame,
    categories: Sequence[str] = tuple(CATEGORIES),
    mask: Callable[[Column], Column] = pii.mask_in_text,
    masked: Callable[[DataFrame], DataFrame] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Published columns of the pages that belong to a category; the raw text stays behind.

    ``masked`` is a whole step in place of ``mask``, such as a model's: a page for which it gives
    no text although there is one is an error and not published, see ``unmasked``.
    """
    routed = pages.filter(F.col("document_type").isin(*categories)).withColumn("chunk_id", chunk_id(F.col("file_path"), F.col("page_id")))
    if masked is None:
        return routed.withColumn("page_content_masked", mask(F.col("page_content"))).select(*GOLD, *keep)
    told = masked(routed).select(*GOLD, *keep, "error")
    return told.select(only(F.struct(*told.columns), lambda r: r["error"].isNull()).alias("r")).select(*[f"r.{c}" for c in (*GOLD, *keep)])


def masked_files(pages: DataFrame, categories: Sequence[str] = tuple(CATEGORIES)) -> DataFrame:
    """``masked_pages`` with names and addresses masked on all pages of the file in which one page tells them by a cue.

    Found values are aggregated per file, each task sending every value of a file once, and joined back to its pages; a file with a
    large share of all pages is split by the adaptive skew join. Files without any keep what their pages have.
    """
    routed = pages.filter(F.col("document_type").isin(*categories))
    cued = items(routed.select("file_path", pii.spreading(F.col("page_content")).alias("found")), ["file_path"], "found", "e").select("file_path", "e")
    told = cued.distinct().groupBy("file_path").agg(F.collect_list("e").alias("told"))
    joined = routed.join(told, "file_path", "left").withColumn("chunk_id", chunk_id(F.col("file_path"), F.col("page_id")))
    known = F.coalesce("told", F.array().cast(told.schema["told"].dataType))
    return joined.withColumn("page_content_masked", pii.mask_in_text(F.col("page_content"), also=known)).select(*GOLD)


def unmasked(pages: DataFrame, masked: Callable[[DataFrame], DataFrame], categories: Sequence[str] = tuple(CATEGORIES)) -> DataFrame:
    """(file_path, page_id, error) of the pages that a masking step could not do."""
    told = masked(pages.filter(F.col("document_type").isin(*categories))).select("file_path", "page_id", "error")
    return told.select("file_path", "page_id", only(F.col("error"), lambda e: e.isNotNull()).alias("error"))


def unrouted(pages: DataFrame, categories: Sequence[str] = tuple(CATEGORIES)) -> DataFrame:
    """Pages per type that no category takes."""
    kind = F.col("document_type")
    return (
        pages.filter(kind.isNull() | ~kind.isin(*categories)).groupBy("document_type").agg(F.count("*").alias("n_pages"))
    )


def publish(gold: DataFrame, path: str, compact: bool = False) -> int:
    """All categories in one pass, one folder each, as a new version; a category without rows gets none.

    Every task writes its own files, so a category that holds most of the pages is
    written by as many tasks as it has. ``compact`` adds one adaptive exchange that merges
    small pieces of a category and splits large ones.
    """
    out = gold.hint("rebalance", "document_type") if compact else gold
    return versions.write_next(out, path, "document_type")


def sync(
    pages: DataFrame,
    path: str,
    secret: str,
    categories: Sequence[str] = tuple(CATEGORIES),
    mask: Callable[[Column], Column] = pii.mask_in_text,
    masked: Callable[[DataFrame], DataFrame] | None = None,
    count: int = BUCKETS,
) -> int:
    """Bring the gold table at ``path`` in step with the pages; returns its version.

    A keyed hash of all that a published page is made from is kept beside it. Hashes are compared by page, in one shuffle of keys and
    hashes; only pages that are new or differ are masked, and only folders (a category's buckets) with a changed page are read
    and written. Pages that are gone go. What a model could not mask is not published and counts as new in the next run. Without
    changes nothing is written. ``path/changes`` has the changes of each version.
    """
    spark = pages.sparkSession
    made_from = F.struct("file_name", "file_path", "document_type", "page_id", "page_content", "element_count", "element_types", "image_uri")
    hashed = F.sha2(F.concat(F.lit(secret), F.to_json(made_from, {"ignoreNullFields": "false"})), 256)
    routed = pages.filter(F.col("document_type").isin(*categories)).withColumns(
        {"chunk_id": chunk_id(F.col("file_path"), F.col("page_id")), "source_hash": hashed, "bucket": buckets.bucket(F.col("file_path"), count)}
    )
    known = buckets.manifest(spark, path)
    if known is None:
        buckets.replace(spark.createDataFrame([], _SYNCED), path, _PARTS, [])
    old = buckets.read(spark, path, _SYNCED)

    def state(rows: DataFrame, name: str) -> DataFrame:
        # pages that share a key are told by their number and their hashes
        sums = [F.count(F.lit(1)), F.min("source_hash"), F.max("source_hash")]
        return rows.groupBy("chunk_id").agg(F.struct(*sums).alias(name), F.collect_set(buckets.part(_PARTS)).alias(f"{name}_parts"))

    action = F.when(F.col("old").isNull(), F.lit("insert")).when(F.col("new").isNull(), F.lit("delete")).otherwise(F.lit("update"))
    both = state(routed, "new").join(state(old, "old"), "chunk_id", "full_outer").filter(~F.col("new").eqNullSafe(F.col("old")))
    none = F.array().cast("array<string>")
    parts = F.array_union(F.coalesce("new_parts", none), F.coalesce("old_parts", none))
    changes = stored(both.select("chunk_id", action.alias("action"), parts.alias("parts")), "changes")
    if changes.isEmpty():
        return versions.latest(spark, f"{path}/manifest")
    touched = [r.p for r in changes.select(F.explode("parts").alias("p")).distinct().collect()]
    # texts are joined to the changes only where there are texts on either side
    parts_of = []
    if known:
        same = buckets.read(spark, path, _SYNCED, touched).join(changes.select("chunk_id"), "chunk_id", "left_anti")
        parts_of.append(same.select(*GOLD, "source_hash", "bucket"))
    wanted = changes.filter("action <> 'delete'").select("chunk_id")
    if not wanted.isEmpty():
        fresh = routed.join(wanted, "chunk_id", "left_semi") if known else routed.filter("chunk_id IS NOT NULL")
        parts_of.append(masked_pages(fresh, categories, mask, masked, ("source_hash", "bucket")))
    version = buckets.replace(reduce(DataFrame.unionByName, parts_of), path, _PARTS, touched)
    versions.write_next(changes.select("chunk_id", "action"), f"{path}/changes")
    buckets.prune(spark, path)
    return version


def published(spark: SparkSession, path: str) -> DataFrame:
    """All categories of the newest version, columns in their order."""
    synced = buckets.read(spark, path, _SYNCED)
    if synced is not None:
        return synced.select(*GOLD)
    newest = versions.read_latest(spark, path, GOLD_ROWS)
    if newest is None:
        raise ValueError(f"nothing has been published at {path}")
    return newest.select(*GOLD)


def publish_tables(gold: DataFrame, path: str, prefix: str, categories: Sequence[str] = tuple(CATEGORIES)) -> list[str]:
    """``publish``, then one table name per category that has pages."""
    publish(gold, path)
    spark = gold.sparkSession
    names = []
    for category in categories:
        part = category_pages(spark, path, category)
        if not part.isEmpty():
            part.createOrReplaceTempView(f"{prefix}_{category}")
            names.append(f"{prefix}_{category}")
    return names


def category_pages(spark: SparkSession, path: str, category: str) -> DataFrame:
    """One category of the published set; only its folder is read."""
    return published(spark, path).filter(F.col("document_type") == category)


def summary(gold: DataFrame) -> DataFrame:
    """Rows and distinct documents per category."""
    return gold.groupBy("document_type").agg(
        F.count("*").alias("n_pages"), F.countDistinct("file_name").alias("n_documents")
    )
