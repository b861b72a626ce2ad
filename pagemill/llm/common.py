"""What the training-data operators share: stored steps, joins that bear hot keys, key-wise choices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_dir

# The most that a join ships to every executor. Beyond it the same join runs by shuffle.
BROADCAST_BYTES = 64 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def stored(rows: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows written to the cluster's shared folder and read back: what follows does not depend on executors that are gone.

    ``drop_stored`` deletes what a session has written.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/steps/{uuid.uuid4().hex}"
    writer = rows.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    _written(spark).append(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of at most so many bytes for what is run inside; the session's setting is put back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _written(spark: SparkSession) -> list[str]:
    paths = getattr(spark, "_pagemill_steps", None)
    if paths is None:
        paths = spark._pagemill_steps = []
    return paths


def drop_stored(spark: SparkSession) -> None:
    """Delete the stored steps of this session. Results that still read them must be written before."""
    paths, jvm = _written(spark), spark.sparkContext._jvm
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small(rows: DataFrame, count: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with a broadcast hint if their counted size stays under the limit."""
    return F.broadcast(rows) if count * row_bytes <= limit else rows


def attach(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of many rows to the one fact of their key, without a hot key in one task.

    ``weight`` says how many rows have the key, ``total`` how many rows there are. Keys above a
    500th of all rows are at most 500: their facts are broadcast and their rows stay where
    they are. The rest is an ordinary join in which no key is large.
    """
    heavy = facts.filter(F.col(weight) > max(1000, total // 500))
    light = facts.filter(F.col(weight) <= max(1000, total // 500))
    hot = rows.join(F.broadcast(heavy), key)
    cold = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(cold)


def one_per_group(rows: DataFrame, group: str, row: str, order: Column) -> DataFrame:
    """The ``row`` struct that is last in ``order`` of each group.

    An aggregate: each task sends one row per group on, however large the group is.
    """
    return rows.groupBy(group).agg(F.max_by(F.col(row), order).alias(row)).select(f"{row}.*")


def as_struct(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def tie_break(docs: DataFrame) -> Column:
    """A hash of the whole row, to choose among rows that are alike in what decides. Map columns have no hash."""
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return F.xxhash64(*hashable) if hashable else F.lit(0).cast("long")


def unnest(rows: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    return rows.select(*[F.col(row).getField(c).alias(c) for c in columns])
