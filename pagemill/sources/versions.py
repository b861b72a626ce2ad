"""A table as a folder of finished versions.

A run writes ``version=<n>`` beside the ones before and readers take the newest that is
complete. A run that dies leaves the table as it was, and a reader that has begun keeps
its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _all(spark: SparkSession, path: str) -> dict[int, bool]:
    """Version -> whether it is complete."""
    make, fs, root = _folder(spark, path)
    if not fs.exists(root):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return {n: fs.exists(make(f"{path}/version={n}/_SUCCESS")) for n in numbers}


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, root = _folder(spark, path)
    return fs.exists(root)


def complete(spark: SparkSession, path: str) -> list[int]:
    return sorted(n for n, done in _all(spark, path).items() if done)


def latest(spark: SparkSession, path: str) -> int | None:
    return max(complete(spark, path), default=None)


def read_latest(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The newest complete version, or None before the first. A version without rows needs the schema to be read."""
    version = latest(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return None if version is None else reader.parquet(f"{path}/version={version}")


def write_next(rows: DataFrame, path: str, *partition_by: str) -> int:
    """Write a new version after all that exist, complete or not; returns its number."""
    version = max(_all(rows.sparkSession, path), default=-1) + 1
    writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
    writer.mode("errorifexists").parquet(f"{path}/version={version}")
    return version


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` complete versions, and what never got complete before them."""
    versions = _all(spark, path)
    done = sorted(n for n, complete in versions.items() if complete)
    if not done:
        return []
    kept = done[-keep:]
    old = sorted(n for n in versions if n < done[-1] and n not in kept)
    delete(spark, [f"{path}/version={n}" for n in old])
    return old


def delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        make, fs, _ = _folder(spark, folder)
        fs.delete(make(folder), True)
