"""A table of folders that are replaced one by one.

Rows are dealt into folders (a bucket of their key, a category and a bucket). A change writes the folders it touches, under a
new version, and then a manifest: which version of which folder counts now. Readers take the newest manifest that is complete, so a
run that dies leaves the table as it was, and what has not changed is neither read nor written.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import versions

MANIFEST = "part STRING, version INT, batch BIGINT"
_PLAIN = re.compile(r"[A-Za-z0-9_\-]+")


def bucket(key: str | Column, count: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(count)).cast("int")


def part(by: Sequence[str]) -> Column:
    """Name of the folder of a row."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in by])


def manifest(spark: SparkSession, path: str) -> dict[str, int] | None:
    """Folder -> version that counts, or None before the first change. One entry per folder: categories times buckets."""
    newest = versions.read_latest(spark, f"{path}/manifest", MANIFEST)
    return None if newest is None else {r.part: r.version for r in newest.filter("part IS NOT NULL").collect()}


def last_batch(spark: SparkSession, path: str) -> int:
    """Number of the micro-batch that the newest manifest came from, -1 if from none."""
    newest = versions.read_latest(spark, f"{path}/manifest", MANIFEST)
    found = None if newest is None else newest.agg(F.max("batch")).first()[0]
    return -1 if found is None else found


def read(spark: SparkSession, path: str, schema: str, parts: Sequence[str] | None = None) -> DataFrame | None:
    """The table, or only some of its folders; None before the first change."""
    known = manifest(spark, path)
    if known is None:
        return None
    wanted = known if parts is None else [p for p in parts if p in known]
    folders = [f"{path}/data/version={known[p]}/{p}" for p in sorted(wanted)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)


def replace(rows: DataFrame, path: str, by: Sequence[str], touched: Sequence[str], batch: int | None = None, dealt: bool = False) -> int:
    """Make ``rows`` all that the touched folders hold; returns the number of the manifest.

    A folder that gets no row is left out of the manifest. ``by`` are columns of ``rows``; their values are plain words or numbers.
    Rows that are ``dealt`` by them already are written as they are.
    """
    spark = rows.sparkSession
    for name in touched:
        if not all(_PLAIN.fullmatch(x) for piece in name.split("/") for x in piece.split("=", 1)):
            raise ValueError(f"{name!r} cannot be the name of a folder")
    known = manifest(spark, path) or {}
    kept = {p: v for p, v in known.items() if p not in set(touched)}
    if touched:
        version = versions.write_next(rows if dealt else rows.hint("rebalance", *by), f"{path}/data", *by)
        schema = rows.schema
        filled = spark.read.schema(schema).parquet(f"{path}/data/version={version}").select(part(by).alias("p")).distinct()
        kept |= {r.p: version for r in filled.collect()}
    listed = [(p, v, batch) for p, v in sorted(kept.items())] or [(None, None, batch)]
    return versions.write_next(spark.createDataFrame(listed, MANIFEST).coalesce(1), f"{path}/manifest")


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the newest ``keep`` manifests names; returns them."""
    old = versions.complete(spark, f"{path}/manifest")
    tables = {n: spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={n}").filter("part IS NOT NULL") for n in old}
    named = {n: {(r.part, r.version) for r in t.collect()} for n, t in tables.items()}
    live = reduce(set.union, (named[n] for n in old[-keep:]), set())
    gone = sorted({f"data/version={v}/{p}" for n in old[:-keep] for p, v in named[n] - live})
    versions.delete(spark, [f"{path}/{folder}" for folder in gone])
    versions.prune(spark, f"{path}/manifest", keep)
    return gone
