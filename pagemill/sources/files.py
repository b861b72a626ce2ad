"""Binary files in, encrypted files out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.crypto import encrypt_bytes
from ..functions.text import base_name, decoded
from ..schemas import FILES
from ..session import few_listing_tasks, gathered

# One file is one row. A larger file is a row without content, and the stages after tell so.
MAX_FILE_BYTES = 512 * 1024 * 1024
# Files that a folder gets on average, if they are dealt to several: tasks that write into one folder wait for each other.
FOLDER_FILES = 1000
# Folders read at once: the driver holds the list of their files.
LISTED_FOLDERS = 64
# The same for one stream. What comes into so many folders at a time mostly fits into one micro-batch.
STREAM_FOLDERS = 24


def read_files(spark: SparkSession, path: str | Sequence[str], glob: str = "*.enc", max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(path, length, content) of the files of one folder or several. A file over the limit is there with NULL content, which is never read."""
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path if isinstance(path, str) else list(path))
    return _limited(files, max_bytes)


def _limited(files: DataFrame, max_bytes: int) -> DataFrame:
    """Two scans by the listed size, which parts the files before any is opened; that of the large files reads no content."""
    size = F.col("_metadata.file_size")
    whole = files.filter(size <= max_bytes).select("path", "length", "content")
    large = files.filter(size > max_bytes).select("path", "length", F.lit(None).cast("binary").alias("content"))
    return gathered(whole).unionByName(gathered(large))


def oversized(spark: SparkSession, path: str, glob: str = "*.enc", max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.filter(F.col("length") > max_bytes).select("path", "length")


def stream_files(
    spark: SparkSession,
    path: str,
    glob: str = "*.enc",
    max_files: int = 10_000,
    max_bytes: int = MAX_FILE_BYTES,
    archive: str | None = None,
) -> DataFrame:
    """The same as a stream: every file once, large ones too. File identity is its path.

    With ``archive`` files are moved there, under their whole path, once the batch that read them is committed, so that a
    long-lived landing folder is listed at the cost of what is new. The files of a run's last batch are
    moved by the next run with new files, and a move that a lost driver prevented leaves its file where it is; neither is read again.
    """
    reader = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _limited(reader.load(path), max_bytes)


def encrypted(files: DataFrame, key: bytes) -> DataFrame:
    """Files with content encrypted and the name they get on the other side; this table is the result to keep."""
    return files.select(
        F.concat(base_name(decoded(F.col("path"))), F.lit(".enc")).alias("name"),
        F.col("path"),
        F.col("length").alias("plain_bytes"),
        encrypt_bytes(F.col("content"), key).alias("content"),
    ).withColumn("encrypted_bytes", F.octet_length("content").cast("bigint"))


def folder_of(name: Column, folders: int) -> Column:
    """The folder that a file is dealt to: by its name, so that a later file of one name replaces the earlier."""
    return F.lpad(F.pmod(F.crc32(name.cast("binary")), F.lit(folders)).cast("string"), 6, "0")


def folder_groups(written: DataFrame, folder: str, folders: int, at_once: int = LISTED_FOLDERS) -> list[list[str]]:
    """The folders that ``write_files`` has put files into, as many in a group as are to be listed at once."""
    dealt = written.filter("reason IS NULL").select(folder_of(F.col("name"), folders).alias("part")).distinct()
    paths = sorted(f"{folder}/{r.part}" for r in dealt.collect())
    return [paths[at : at + at_once] for at in range(0, len(paths), at_once)]


def folders_for(rows: DataFrame, name: Column) -> int:
    """Folders for files of these names, so that each gets some ``FOLDER_FILES``; rows of one name are one file."""
    return max(1, -(-rows.agg(F.approx_count_distinct(name)).first()[0] // FOLDER_FILES))


def folder_globs(folder: str, folders: int, at_once: int = STREAM_FOLDERS) -> list[str]:
    """All folders that ``write_files`` deals to, there yet or not, as one glob for as many as are to be listed at once.

    A stream over each keeps the driver from holding all files: it lists, and remembers, those of its own glob.
    """
    names = [f"{n:06d}" for n in range(folders)]
    return [f"{folder}/{{{','.join(names[at : at + at_once])}}}" for at in range(0, folders, at_once)]


def write_files(rows: DataFrame, folder: str, folders: int | None = None) -> DataFrame:
    """Write ``name, content`` rows as one file each; returns (name, bytes, reason), with a reason for what was not written.

    The folder is taken as Spark takes it: without a scheme it is on the default file system. With ``folders`` the files
    are dealt to so many in it, see ``folder_of``.

    Runs in the tasks, over any file system Arrow can open. A file appears under its name
    only when complete, and a task that is run again replaces it.
    Lazy: the files are written when the result is consumed, so consume it once.
    """

    target = qualified(rows.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import uuid

        from pyarrow import fs

        remote, root = fs.LocalFileSystem(), target.removeprefix("file:")
        if not target.startswith("file:"):
            remote, root = fs.FileSystem.from_uri(target)
        root = "/" + root.lstrip("/") if target.startswith("file:") else root
        remote.create_dir(root, recursive=True)
        made = {""}
        for batch in batches:
            names, parts = batch.column("name").to_pylist(), batch.column("part").to_pylist()
            sizes, reasons = [], []
            for name, part_folder, content in zip(names, parts, batch.column("content"), strict=True):
                if not content.is_valid:
                    sizes.append(None)
                    reasons.append("no content")
                    continue
                data = content.as_buffer()
                reasons.append(None)
                into = os.path.join(root, part_folder)
                if part_folder not in made:
                    remote.create_dir(into, recursive=True)
                    made.add(part_folder)
                part = os.path.join(into, f"_{uuid.uuid4().hex}.part")
                with remote.open_output_stream(part) as out:
                    out.write(data)
                remote.move(part, os.path.join(into, name))
                sizes.append(data.size)
            yield pa.RecordBatch.from_pydict({"name": names, "bytes": pa.array(sizes, pa.int64()), "reason": pa.array(reasons, pa.string())})

    dealt = F.lit("") if folders is None else folder_of(F.col("name"), folders)
    return rows.select("name", "content", dealt.alias("part")).mapInArrow(write, "name string, bytes bigint, reason string")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark would read it with."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return path.getFileSystem(conf).makeQualified(path).toString()


def encrypt_folder(spark: SparkSession, source: str, target: str, key: bytes, glob: str = "*.pdf") -> DataFrame:
    """Every file of a folder as ``<base name>.enc`` in another; returns (name, bytes, reason).

    Two files that would get the same name are an error, not a silent loss.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source).select(base_name(decoded(F.col("path"))).alias("name"))
    doubled = names.groupBy("name").count().filter("count > 1").select("name").first()
    if doubled:
        raise ValueError(f"several files would become {doubled['name']}.enc")
    return write_files(encrypted(read_files(spark, source, glob), key), target)


def size_summary(files: DataFrame) -> DataFrame:
    """Files, plain and encrypted bytes."""
    return files.agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("plain_bytes"), F.lit(0)).alias("plain_bytes"),
        F.coalesce(F.sum("encrypted_bytes"), F.lit(0)).alias("encrypted_bytes"),
    )
