"""Vectors of pages: embed, keep an index table in step with its source, search."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from ..session import stored
from ..sources import buckets, versions

# Most bytes of query vectors that are handed to every executor as one broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# Most scores a task holds at a time.
SCORES_AT_ONCE = 8_000_000

CHANGES = "chunk_id STRING, action STRING"
INDEX = "chunk_id STRING, content_hash STRING, embedding ARRAY<FLOAT>, bucket INT"
BUCKETS = 32
# Scores are compared at this many digits, so that the order of summation cannot decide a rank.
SCORE_DIGITS = 10


# --- embedding -----------------------------------------------------------------------


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def bucket(token: Column, dim: int, hasher: str = "xxhash64") -> Column:
    """Place of a token in the vector. ``md5`` is slower and can be recomputed by any SQL engine."""
    if hasher == "md5":
        return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % dim).cast("int")
    return F.pmod(F.xxhash64(token), F.lit(dim)).cast("int")


def _densify(dim: int):
    @F.arrow_udf(f"array<float>")
    def densify(places: pa.Array) -> pa.Array:
        lengths = np.asarray(places.value_lengths().fill_null(0))
        row = np.repeat(np.arange(len(places)), lengths)
        flat = np.asarray(places.flatten())
        counts = np.bincount(row * dim + flat, minlength=len(places) * dim).reshape(len(places), dim)
        norm = np.sqrt((counts.astype("float64") ** 2).sum(axis=1, keepdims=True))
        unit = np.divide(counts, norm, out=np.zeros(counts.shape), where=norm > 0).astype("float32")
        offsets = pa.array(np.arange(0, (len(places) + 1) * dim, dim, dtype="int32"))
        return pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()))

    return densify


def embed_hashed(text: Column, dim: int = 256, hasher: str = "xxhash64") -> Column:
    """Unit vector of the hashed tokens of a text.

    Tokens are hashed in the JVM; a batch of texts is then counted with one ``bincount``.
    Nothing is exploded or shuffled.
    """
    return _densify(dim)(F.transform(tokens(text), lambda t: bucket(t, dim, hasher)))


# --- index table ------------------------------------------------------------------------


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def source_ready(source: DataFrame, name: str = "source") -> DataFrame:
    """The source, or an error: an index is not built over nothing."""
    if source.isEmpty():
        raise ValueError(f"{name} is missing or empty, no index can be built from it")
    return source


def index_diff(source: DataFrame, index: DataFrame) -> DataFrame:
    """(chunk_id, action) for every key that differs: insert, update or delete.

    Only keys and hashes are shuffled; texts and vectors stay where they are.
    """
    new = source.select("chunk_id", content_hash(F.col("page_content_masked")).alias("new_hash"), F.lit(True).alias("in_source"))
    old = index.select("chunk_id", F.col("content_hash").alias("old_hash"), F.lit(True).alias("in_index"))
    # a page without text has no hash, so the hashes do not tell which side has the key
    action = (
        F.when(F.col("in_index").isNull(), F.lit("insert"))
        .when(F.col("in_source").isNull(), F.lit("delete"))
        .when(~F.col("old_hash").eqNullSafe(F.col("new_hash")), F.lit("update"))
    )
    return (
        new.join(old, "chunk_id", "full_outer")
        .select("chunk_id", action.alias("action"))
        .filter(F.col("action").isNotNull())
    )


def index_rows(source: DataFrame, embed: Callable[[Column], Column] = embed_hashed) -> DataFrame:
    """A fresh index over the whole source."""
    return source.select(
        "chunk_id",
        content_hash(F.col("page_content_masked")).alias("content_hash"),
        embed(F.col("page_content_masked")).alias("embedding"),
    )


def synced(
    source: DataFrame, index: DataFrame, changes: DataFrame, embed: Callable[[Column], Column] = embed_hashed
) -> DataFrame:
    """The index after the changes ``index_diff`` found; only new and changed texts are embedded.

    The changes hold keys only. While they are few, Spark sends them to both large sides,
    and neither texts nor vectors are shuffled.
    """
    fresh = source.join(changes.filter("action <> 'delete'").select("chunk_id"), "chunk_id", "left_semi")
    same = index.join(changes.select("chunk_id"), "chunk_id", "left_anti")
    return same.select("chunk_id", "content_hash", "embedding").unionByName(index_rows(fresh, embed))


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The index as of its last finished sync, or None before the first."""
    index = buckets.read(spark, path, INDEX)
    return None if index is None else index.drop("bucket", "version")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The change feed: (chunk_id, action, version) of every sync that changed something, the first one's inserts included."""
    feed = f"{path}/changes"
    known = [spark.read.schema(CHANGES).parquet(f"{feed}/version={n}").withColumn("version", F.lit(n)) for n in versions.complete(spark, feed)]
    return reduce(DataFrame.unionByName, known) if known else spark.createDataFrame([], f"{CHANGES}, version INT")


def _differences(source: DataFrame, index: DataFrame | None) -> DataFrame:
    """``index_diff`` with the rows of a key counted on the way: (chunk_id, action, n). The first sync has an empty index."""
    new = source.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"), F.max(content_hash(F.col("page_content_masked"))).alias("new_hash"))
    if index is None:
        return new.select("chunk_id", F.lit("insert").alias("action"), "n")
    old = index.select("chunk_id", F.col("content_hash").alias("old_hash"), F.lit(True).alias("in_index"))
    action = (
        F.when(F.col("n") > 1, F.lit("repeated"))
        .when(F.col("in_index").isNull(), F.lit("insert"))
        .when(F.col("n").isNull(), F.lit("delete"))
        .when(~F.col("old_hash").eqNullSafe(F.col("new_hash")), F.lit("update"))
    )
    return new.join(old, "chunk_id", "full_outer").select("chunk_id", action.alias("action"), "n").filter(F.col("action").isNotNull())


def sync_index(
    source: DataFrame, path: str, embed: Callable[[Column], Column] = embed_hashed, name: str = "source", count: int = BUCKETS,
    rows: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Create the index at ``path``, or bring it in step with the source; returns the version.

    The index is dealt into ``count`` buckets by key. Keys and hashes are compared in one shuffle; only changed texts are
    embedded, and only buckets that hold a changed key are read and written. The changes are the version's part of the
    change feed. Without changes nothing is written and the version stays. ``rows`` makes (chunk_id, content_hash, embedding) of a
    source in place of ``embed``, such as a model does; a row without embedding is left out and tried again by the next sync. The
    number of buckets is that of the first sync.
    """
    spark = source_ready(source, name).sparkSession
    index = read_index(spark, path)
    changes = stored(_differences(source, index), "changes")
    doubled = changes.filter("n > 1 OR chunk_id IS NULL").first()
    if doubled:
        raise ValueError(f"{name} has {doubled['n']} rows of key {doubled['chunk_id']}; keys must be unique and not NULL")
    if changes.isEmpty():
        return versions.latest(spark, f"{path}/manifest")
    folder = F.when(F.lit(index is None), buckets.bucket("chunk_id", count)).otherwise(buckets.bucket("chunk_id", _bucket_count(spark, path, count)))
    touched = [r.p for r in changes.select(folder.alias("bucket")).distinct().select(buckets.part(["bucket"]).alias("p")).collect()]
    fresh = source.join(changes.filter("action <> 'delete'").select("chunk_id"), "chunk_id", "left_semi")
    made = index_rows(fresh, embed) if rows is None else rows(fresh).select("chunk_id", "content_hash", "embedding").filter("embedding IS NOT NULL")
    if index is None:
        versions.write_next(spark.createDataFrame([(count,)], "count INT").coalesce(1), f"{path}/buckets")
    else:
        same = buckets.read(spark, path, INDEX, touched).join(changes.select("chunk_id"), "chunk_id", "left_anti")
        made = same.select("chunk_id", "content_hash", "embedding").unionByName(made)
    version = buckets.replace(made.withColumn("bucket", folder), path, ["bucket"], touched)
    versions.write_next(changes.select("chunk_id", "action"), f"{path}/changes")
    buckets.prune(spark, path)
    return version


def _bucket_count(spark: SparkSession, path: str, count: int) -> int:
    known = versions.read_latest(spark, f"{path}/buckets", "count INT")
    return count if known is None else known.first()["count"]


# --- search -----------------------------------------------------------------------------


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row, the columns that can be among the k best: everything at or above the k-th score."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, dtype=bool)
    kth = np.partition(scores, -k, axis=1)[:, -k]
    return scores >= kth[:, None]


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    order = found.sort_values(["query_id", "score", "id"], ascending=[True, False, True])
    return order.groupby("query_id", sort=False).head(k)


def _candidates(query_ids, queries: np.ndarray, ids, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """Best k of these vectors per query; a strip of queries at a time bounds the score matrix."""
    strip = max(1, SCORES_AT_ONCE // max(1, len(ids)))
    parts = []
    for at in range(0, len(query_ids), strip):
        scores = np.round(queries[at : at + strip] @ vectors.T, SCORE_DIGITS)
        q, v = np.nonzero(_top(scores, k))
        parts.append(
            _best(pd.DataFrame({"query_id": query_ids[at + q], "id": ids[v], "score": scores[q, v]}), k)
        )
    return pd.concat(parts)


def _vectors(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the matrix of (id, embedding) rows, straight from the Arrow buffers."""
    ids, lists = rows.column(0), rows.column(1)
    if isinstance(rows, pa.Table):
        ids, lists = ids.combine_chunks(), lists.combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError(f"vectors of {sizes.min()} and of {sizes.max()} numbers cannot be compared")
    flat = np.asarray(lists.flatten(), dtype="float64")
    return ids.to_numpy(zero_copy_only=False), flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def knn(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    vec: tuple[str, str] = ("vec_id", "embedding"),
    query: tuple[str, str] = ("query_id", "embedding"),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact k best vectors per query by dot product: (query_id, id, score, rank).

    The queries are cut into pieces of proven size. A piece goes to every executor as one matrix,
    and each batch of vectors is one matrix product of which only the best k per query leave the
    task: vectors are never shuffled. Each piece is one scan of the vectors. Queries are computed
    once and stored if there is more than one piece. Rows without a vector take no part.
    """
    # a filter on a computed vector would be pushed below its projection and compute it twice: rows without one are dropped in the search
    v = vectors.select(F.col(vec[0]).alias("id"), F.col(vec[1]).alias("embedding"))
    given = stored(_asked(queries, query), "queries").filter(F.col("embedding").isNotNull())
    whole = given.agg(F.sum("_bytes")).first()[0] or 0
    pieces = max(1, math.ceil(whole / max(1, broadcast_bytes // 2)))
    if pieces == 1:
        return _ranked(_searched(v, given.select("query_id", "embedding").toArrow(), k), k)
    # one piece after the other is in the driver and on the executors; its best are stored before the next comes
    piece, found = F.pmod(F.xxhash64("query_id"), F.lit(pieces)), []
    for n in range(pieces):
        shared: list = []
        found.append(stored(_searched(v, given.filter(piece == n).select("query_id", "embedding").toArrow(), k, shared), "best"))
        shared[0].unpersist()
    return _ranked(reduce(DataFrame.unionByName, found), k)


def _asked(queries: DataFrame, query: tuple[str, str]) -> DataFrame:
    """(query_id, embedding, bytes in a broadcast)."""
    q = queries.select(F.col(query[0]).alias("query_id"), F.col(query[1]).alias("embedding"))
    size = F.lit(64) + 8 * F.size("embedding") + (F.octet_length("query_id") if dict(q.dtypes)["query_id"] in ("string", "binary") else F.lit(16))
    return q.withColumn("_bytes", size.cast("long"))


def _searched(v: DataFrame, piece: pa.Table, k: int, held: list | None = None) -> DataFrame:
    spark = v.sparkSession
    shared = spark.sparkContext.broadcast(_vectors(piece))
    if held is not None:
        held.append(shared)
    kind = from_arrow_type(piece.schema.field("query_id").type).simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, matrix = shared.value
        best: pd.DataFrame | None = None
        for batch in batches:
            if batch.column(1).null_count:
                batch = batch.filter(batch.column(1).is_valid())
            if not len(batch) or not len(asked):
                continue
            ids, theirs = _vectors(batch)
            if theirs.shape[1] != matrix.shape[1]:
                raise ValueError(f"vectors of {theirs.shape[1]} numbers cannot be compared with queries of {matrix.shape[1]}")
            found = _candidates(asked, matrix, ids, theirs, k)
            best = found if best is None else _best(pd.concat([best, found]), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    return v.mapInArrow(search, f"query_id {kind}, id {dict(v.dtypes)['id']}, score double")
