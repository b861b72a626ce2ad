"""Files to bronze to silver as streams that take what is new and stop.

Each step is stateless: a file is one row, its elements and pages come from that row, so
a page is complete within the micro-batch that holds its file and append mode needs
neither watermark nor state. The Parquet sinks keep a commit log, and a step reads the
log of the one before, so a restart after a lost driver neither drops nor doubles a file.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.binding import only
from ..functions.crypto import encrypt_bytes
from ..operators import bronze, silver
from ..operators.bronze import Parser
from ..schemas import CATEGORIES, ELEMENTS, PAGE_ROWS, PARSED_DOCS
from ..session import few_listing_tasks, forget, gathered, stored
from ..sources import buckets, files, versions

DOCS, ELEMENT_TABLE, PAGES = "bronze_docs", "bronze_elements", "silver_pages"


def append(stream: DataFrame, target: str, name: str) -> None:
    """Run a stream over everything that is there, into ``target/name``."""
    run(
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{target}/_checkpoints/{name}")
        .option("path", f"{target}/{name}"),
        stream.sparkSession,
    )


def run(writer: DataStreamWriter, spark: SparkSession) -> None:
    """Take what is there, and stop."""
    try:
        with few_listing_tasks(spark):
            writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        forget()


def stream_table(spark: SparkSession, target: str, name: str, schema: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{target}/{name}")


def ingest_docs(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    key: bytes,
    parser: Parser,
    labels: Sequence[str] = tuple(CATEGORIES),
    on_error: str = "mark",
    max_files: int = 10_000,
    archive: str | None = None,
) -> None:
    """Step 1: new ``*.enc`` files (or any stream of path, length, content) to stored documents; what has been read goes to ``archive``, if given."""
    stream = source if isinstance(source, DataFrame) else files.stream_files(spark, source, max_files=max_files, archive=archive)
    append(bronze.sealed_docs(bronze.parsed(stream, key, parser, labels, on_error), key), target, DOCS)


# Streams that run side by side: while the driver prepares a micro-batch of one, the cores work on those of the others.
STREAMS = 2


def share(target: str, n: int) -> str:
    """Where the tables of one stream lie, if a landing folder is read by several, each over its own folders in it."""
    return f"{target}/share={n:06d}"


def each_share(spark: SparkSession, sources: Sequence[str], target: str, step: Callable[[str, str], None], at_once: int = STREAMS) -> None:
    """Run ``step(source, its target)`` for all sources, a few at a time. An error ends the run when those that have begun are done."""
    # set once around the threads, whose settings are the session's
    with few_listing_tasks(spark), ThreadPoolExecutor(at_once) as pool:
        done = [pool.submit(step, source, share(target, n)) for n, source in enumerate(sources)]
        try:
            for one in done:
                one.result()
        except BaseException:
            pool.shutdown(wait=True, cancel_futures=True)
            raise


def shared_docs(spark: SparkSession, target: str, shares: int) -> DataFrame:
    """The stored documents of all shares, each as its stream has committed them."""
    read = lambda n: spark.read.schema(PARSED_DOCS).parquet(f"{share(target, n)}/{DOCS}")
    return gathered(reduce(DataFrame.unionByName, map(read, range(shares))))


def ingest_elements(spark: SparkSession, target: str, key: bytes) -> None:
    """Step 2: new documents to stored elements."""
    docs = stream_table(spark, target, DOCS, PARSED_DOCS)
    append(bronze.sealed_elements(bronze.explode_elements(bronze.unsealed_docs(docs, key)), key), target, ELEMENT_TABLE)


def ingest_pages(spark: SparkSession, target: str, key: bytes) -> None:
    """Step 3: new documents to stored pages, page by page from the document's own row."""
    docs = stream_table(spark, target, DOCS, PARSED_DOCS)
    append(silver.sealed_pages(silver.pages_of(bronze.unsealed_docs(docs, key)), key), target, PAGES)


def refresh_pages(spark: SparkSession, target: str, key: bytes, into: str) -> None:
    """The page table as a view over all elements, computed anew as its next version."""
    stored = spark.read.schema(ELEMENTS).parquet(f"{target}/{ELEMENT_TABLE}")
    pages = silver.sealed_pages(silver.pages(bronze.unsealed_elements(stored, key)), key)
    versions.write_next(pages, into)


VIEW_BUCKETS = 32
# Files of a micro-batch whose names are broadcast.
FEW_FILES = 100_000
_VIEW_ROWS = f"{PAGE_ROWS}, bucket INT"


def maintain_pages(spark: SparkSession, target: str, key: bytes, into: str, max_files: int = 1000, count: int = VIEW_BUCKETS) -> None:
    """The page table as a view over all elements that is kept in step: each micro-batch of new elements renews the pages of its files.

    The checkpoint lies beside the view, so that batch numbers and view belong together.
    """
    stream = stream_table(spark, target, ELEMENT_TABLE, ELEMENTS, max_files)
    renewed = stream.writeStream.foreachBatch(lambda batch, number: renew_pages(batch, number, target, key, into, count))
    run(renewed.option("checkpointLocation", f"{into}/_checkpoint"), spark)


def renew_pages(batch: DataFrame, number: int, target: str, key: bytes, into: str, count: int = VIEW_BUCKETS) -> None:
    """Compute the pages of a batch's files anew from all their elements, and replace the buckets they are in.

    A batch that is played again after a failure finds its number in the view and does nothing.
    """
    spark = batch.sparkSession
    if number <= buckets.last_batch(spark, into):
        return
    named = stored(batch.select("file_path").distinct().withColumn("bucket", buckets.bucket("file_path", count)), "files")
    touched = [r.p for r in named.select("bucket").distinct().select(buckets.part(["bucket"]).alias("p")).collect()]
    few = named.count() <= FEW_FILES

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(4 * count, "bucket")

    def joined(rows: DataFrame, files: DataFrame, how: str) -> DataFrame:
        # either side is dealt by bucket at most once, and nothing else is shuffled
        keys = ["bucket", "file_path"]
        return dealt(rows.join(F.broadcast(files), keys, how)) if few else dealt(rows).join(dealt(files), keys, how)

    clear = bronze.unsealed_elements(spark.read.schema(ELEMENTS).parquet(f"{target}/{ELEMENT_TABLE}"), key)
    theirs = joined(clear.withColumn("bucket", buckets.bucket("file_path", count)), named, "left_semi")
    pages = silver.sealed_pages(silver.pages(theirs, ["bucket"]), key, ["bucket"])
    before = buckets.read(spark, into, _VIEW_ROWS, touched)
    if before is not None:
        # told by paths alone whether any page stays
        others = before.select("file_path", "bucket").distinct().join(named, ["bucket", "file_path"], "left_anti")
        if not others.isEmpty():
            pages = joined(before, named, "left_anti").select(*pages.columns).unionByName(pages)
    buckets.replace(pages, into, ["bucket"], touched, number, dealt=True)


def maintained_pages(spark: SparkSession, into: str) -> DataFrame:
    """The view as of its last finished batch; none before the first."""
    view = buckets.read(spark, into, _VIEW_ROWS)
    return spark.createDataFrame([], PAGE_ROWS) if view is None else view.drop("bucket", "version")


def refresh(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    key: bytes,
    parser: Parser,
    with_elements: bool = True,
    **options,
) -> DataFrame:
    """All steps in order; returns the stored pages."""
    ingest_docs(spark, source, target, key, parser, **options)
    if with_elements:
        ingest_elements(spark, target, key)
    ingest_pages(spark, target, key)
    return stored_pages(spark, target)


def stored_pages(spark: SparkSession, target: str) -> DataFrame:
    """The pages so far; none if nothing has been ingested yet."""
    path = f"{target}/{PAGES}"
    return spark.read.schema(PAGE_ROWS).parquet(path) if versions.exists(spark, path) else spark.createDataFrame([], PAGE_ROWS)


def each_batch(
    stream: DataFrame, target: str, name: str, build: Callable[[DataFrame], DataFrame]
) -> None:
    """For a stage that is no plain append: its result per micro-batch in a folder of its own.

    The folder is named by the batch and overwritten, so a batch that is played again
    after a failure replaces what it had written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{target}/{name}/batch_id={batch_id}")

    run(stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{target}/_checkpoints/{name}"), stream.sparkSession)


def read_batches(spark: SparkSession, target: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{target}/{name}").drop("batch_id")


def documents_as_files(documents: DataFrame, path, key: bytes) -> DataFrame:
    """A table of texts as the rows the file source gives: (path, length, content encrypted).

    Encryption draws a nonce, so content has to be one value for all later stages, not an
    expression each of them may evaluate anew.
    """
    content = only(encrypt_bytes(F.col("text").cast("binary"), key), lambda c: c.isNotNull())
    sealed = documents.select(path.alias("path"), content.alias("content"))
    return sealed.select("path", F.octet_length("content").cast("bigint").alias("length"), "content")
