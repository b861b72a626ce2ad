"""Vectors as short codes: one codebook entry per part of a vector, all in integers.

Every component becomes floor(256 x). A vector is cut into equal consecutive parts, and each part's place has a
codebook, which starts as that part of the first vectors (smallest ids) and is refined in rounds: every part goes to
its nearest entry, each entry becomes the floored mean of its parts. A code names the nearest entries.

Nearest entries are searched on Walsh-Hadamard transforms of the parts and entries, zero-padded to a power of two P.
The transform needs additions only and multiplies every squared distance by exactly P. Coefficients are
compared in sequency order, smooth ones first, which carry most of the distance: entries whose sum is
already above the whole distance of one good entry are out. Sums only grow, so what stays is the exact nearest entry.

Tasks send sums and counts per entry; the driver holds codebooks alone (entries x dimension numbers),
which every task gets with its function.

Defined results. Rows whose vector is null or empty, or holds null or non-finite components, are dropped, and so are vectors
whose length is not the commonest (ties: the longer). Dimensions that the parts do not divide are padded with zeros. Ids
may repeat or be null: the first vectors go by id, then by components, nulls last. With fewer vectors than entries the
codebooks are shorter; an empty table gives an empty result. Components are held to +-2^22 (less for parts
of over 256 dimensions), beyond which sums of squares would not fit into 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import attach, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 22
SLICE_ROWS = 2048


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry, position, for vectors of ``dimension`` components."""

    entries: np.ndarray
    dimension: int

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _padded(size: int) -> int:
    return 1 << max(0, size - 1).bit_length()


def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix by their number of sign changes: the bit-reversed Gray code."""
    bits = size.bit_length() - 1
    gray = [n ^ n >> 1 for n in range(size)]
    return np.array([int(f"{g:0{bits}b}"[::-1], 2) if bits else 0 for g in gray])


def transformed(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the last axis, zero-padded to a power of two, in sequency order."""
    size = _padded(parts.shape[-1])
    a = np.zeros((*parts.shape[:-1], size), np.int64)
    a[..., : parts.shape[-1]] = parts
    half = 1
    while half < size:
        pairs = a.reshape(*a.shape[:-1], size // (2 * half), 2, half)
        low, high = pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]
        a = np.stack([low, high], axis=-2).reshape(a.shape)
        half *= 2
    return a[..., sequency_order(size)]


def _distance(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    off = points - entries
    return np.einsum("...i,...i->...", off, off)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each transformed point the nearest transformed entry (ties: the first) and its squared distance before the transform."""
    size = points.shape[-1]
    head = max(1, size // 4)
    lower = _distance(points[:, None, :head], entries[None, :, :head])
    bound = _distance(points, entries[lower.argmin(axis=1)])
    row, entry = np.nonzero(lower <= bound[:, None])
    total = lower[row, entry]
    while head < size:
        # twice as many coefficients each time, for the entries still in
        upto = min(2 * head, size)
        total = total + _distance(points[row, head:upto], entries[entry, head:upto])
        still = total <= bound[row]
        row, entry, total, head = row[still], entry[still], total[still], upto
    first = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(total, first) if len(first) else total
    best = np.flatnonzero(total == np.repeat(least, np.diff(np.append(first, len(row)))))
    best = best[np.flatnonzero(np.diff(row[best], prepend=-1))]
    return entry[best], least // size


def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def _whole(vector: Column, part: int) -> Column:
    largest = float(min(LARGEST, (1 << 30) // _padded(part)))
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-largest), F.least(F.lit(largest), x.cast("double") * SCALE))).cast("int"))


def usable(vectors: DataFrame, id_col: str, vector_col: str, carry: Sequence[str] = (), parts: int = PARTS) -> tuple[DataFrame, int]:
    """(id, v, carried columns) of the rows that get a code, their components whole numbers, and the dimension."""
    vector = F.col(f"`{vector_col}`")
    kept = vectors.filter(_finite(vector))
    common = kept.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimension = common.d if common else parts
    columns = [F.col(f"`{id_col}`").alias("id"), _whole(vector, -(-dimension // parts)).alias("v")]
    return kept.filter(F.size(vector) == dimension).select(*columns, *[F.col(f"`{c}`") for c in carry]), dimension


def _parts_of(column: pa.Array, dimension: int, parts: int) -> np.ndarray:
    """(rows, parts, positions) of a column of vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimension)
    size = -(-dimension // parts)
    if size * parts > dimension:
        flat = np.pad(flat, ((0, 0), (0, size * parts - dimension)))
    return flat.reshape(len(column), parts, size)


def assigned(column: pa.Array, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a column: parts, entries (rows, parts), squared distances (rows, parts)."""
    parts = len(books.entries)
    tables = transformed(books.entries)
    for at in range(0, len(column), SLICE_ROWS):
        cut = _parts_of(column.slice(at, SLICE_ROWS), books.dimension, parts)
        points = transformed(cut)
        found = [nearest(points[:, p], tables[p]) for p in range(parts)]
        yield cut, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: parts to their nearest entries, entries to the floored means of their parts; unused entries stay."""
    parts, count, size = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last position of an entry counts its parts
        sums = np.zeros((parts * count, size + 1), np.int64)
        for batch in batches:
            for cut, codes, _ in assigned(batch.column(0), books):
                for part in range(parts):
                    order = np.argsort(codes[:, part], kind="stable")
                    which, first, times = np.unique(codes[order, part], return_index=True, return_counts=True)
                    sums[part * count + which, :size] += np.add.reduceat(cut[order, part], first, axis=0)
                    sums[part * count + which, size] += times
        used = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(sums.ravel()[used])], names=["place", "amount"])

    found = rows.select("v").mapInArrow(run, "place long, amount long").groupBy("place").agg(F.sum("amount").alias("amount"))
    sums = np.zeros(parts * count * (size + 1), np.int64)
    for row in found.collect():  # at most one number per component of the codebooks
        sums[row.place] = row.amount
    sums = sums.reshape(parts, count, size + 1)
    used = sums[..., -1:] > 0
    means = np.floor_divide(sums[..., :-1], np.maximum(sums[..., -1:], 1))
    return Codebooks(np.where(used, means, books.entries), books.dimension)


def fit(rows: DataFrame, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``usable`` rows; none without rows."""
    first = rows.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    if not first:
        return None
    start = _parts_of(pa.array([r.v for r in first], pa.list_(pa.int32())), dimension, parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)), dimension)
    for _ in range(rounds):
        books = refined(rows, books)
    return books


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """The ``usable`` rows with code (two hex digits a part) and error instead of their vectors."""
    at = rows.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, found, distance in assigned(batch.column(at), books):
                codes += [bytes(c).hex() for c in found.astype(np.uint8)]
                errors.append(distance.sum(axis=1))
            others = [batch.column(n) for n in range(batch.num_columns) if n != at]
            names = [n for n in batch.schema.names if n != "v"]
            new = [pa.array(codes, pa.string()), pa.array(np.concatenate([np.zeros(0, np.int64), *errors]), pa.int64())]
            yield pa.RecordBatch.from_arrays([*others, *new], names=[*names, "code", "error"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "v"]
    return rows.mapInArrow(run, ", ".join([*kept, "code string", "error long"]))


def decoded(code: str, books: Codebooks) -> np.ndarray:
    """The vector that a code stands for, in the scale of the input."""
    found = [books.entries[p, e] for p, e in enumerate(bytes.fromhex(code))]
    return np.concatenate(found)[: books.dimension] / SCALE


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every row with a usable vector.

    ``label_error`` is the error summed over equal labels, nulls together. ``entries`` is at most 256.
    """
    named = {"id": id_col, "v": vector_col, "label": label_col}
    rows, dimension = usable(vectors.select(*[F.col(f"`{c}`").alias(n) for n, c in named.items()]), "id", "v", ["label"], parts)
    books = fit(rows, dimension, parts, entries, rounds)
    if books is None:
        columns = ["label", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")]]
        return rows.limit(0).select("id", *columns, F.lit("").alias("codebooks_sha256"))
    done = stored(encoded(rows, books).withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))))
    largest = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), largest).cast("long")
    sums = stored(done.groupBy("_key").agg(total.alias("label_error"), F.count(F.lit(1)).alias("_weight")))
    whole = attach(done, sums, "_key", "_weight", done.count())
    return whole.select("id", "label", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
