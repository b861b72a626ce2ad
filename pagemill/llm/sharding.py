"""Sharding by a minimax contiguous partition of atomic groups.

Rows with equal texts are a group that no shard boundary may cut. Groups stand in the order of a hash of their
text. The smallest capacity at which the shards can hold all groups in this order is found by
binary search; a capacity is checked greedily, filling one shard after the other.

The groups themselves stay in Spark. The driver gets a summary of at most ``BLOCKS`` stretches of the
order: the first and last group end in each. From these a check gives a bound on either side. Where the bounds differ, only the stretches that
the checks touched are summarised more finely, until both agree; the capacity is then exact.
The cuts keep within that capacity and lie as near to equal shares of what is left as they can.

Defined results. Null and empty texts have no bytes and are one group. Every row weighs its bytes and
a fixed ``overhead`` of at least 1. Repeated rows are one group. A group larger than an equal share
makes its shard as large; the others share the rest. With fewer groups than shards some shards are empty. An empty table gives an
empty result. Ids may repeat or be null; rows of a group are ordered by id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, whole_text
from .prefix import running_sums

OVERHEAD = 8
# Stretches of the order that the driver gets at once, three numbers each.
BLOCKS = 1 << 16


def group_of(text: Column) -> Column:
    """Order and identity of a group. Two texts with one hash would only stay together."""
    return F.xxhash64(whole_text(text))


def size_of(text: Column, overhead: int = OVERHEAD) -> Column:
    return (F.octet_length(whole_text(text)) + F.lit(overhead)).cast("long")


class Ends:
    """What the driver knows of the sorted ends of all groups: stretches by first end, last end and count."""

    def __init__(self, first: np.ndarray, last: np.ndarray, count: np.ndarray) -> None:
        order = np.argsort(first)
        self.first, self.last, self.count = first[order], last[order], count[order]

    @property
    def total(self) -> int:
        return int(self.last[-1]) if len(self.last) else 0

    def open(self) -> np.ndarray:
        """Stretches with ends that the driver does not know."""
        return self.count > 2

    def upto(self, x: int, optimistic: bool) -> int:
        """The last end not beyond ``x``: one that is known, or the best that could be there."""
        at = int(np.searchsorted(self.first, x, "right")) - 1
        if at < 0:
            return 0
        if x >= self.last[at]:
            return int(self.last[at])
        return x if optimistic and self.count[at] > 2 else int(self.first[at])

    def walk(self, capacity: int, shards: int, optimistic: bool, begin: int = 0) -> list[int]:
        """Ends of greedily filled shards."""
        ends, at = [], begin
        for _ in range(shards):
            at = self.upto(at + capacity, optimistic)
            ends.append(at)
        return ends

    def fits(self, capacity: int, shards: int, optimistic: bool, begin: int = 0) -> bool:
        return (self.walk(capacity, shards, optimistic, begin)[-1] if shards else begin) >= self.total

    def least(self, shards: int, optimistic: bool) -> int:
        """The smallest capacity that fits, by binary search."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fits(middle, shards, optimistic) else (middle + 1, high)
        return low


def _summary(ends: DataFrame, width: int) -> DataFrame:
    return ends.groupBy(F.floor(F.col("end") / F.lit(width)).alias("block")).agg(F.min("end").alias("f"), F.max("end").alias("l"), F.count(F.lit(1)).alias("n"))


def _fetch(ends: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = _summary(ends, width).select("f", "l", "n").collect()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(3))


def least_capacity(ends: DataFrame, total: int, shards: int, blocks: int = BLOCKS) -> tuple[int, Ends]:
    """The exact smallest capacity, and a summary that knows every end it needs. ``ends``: a column ``end``, distinct."""
    known = Ends(*_fetch(ends, max(1, total // blocks)))
    while True:
        low, high = known.least(shards, True), known.least(shards, False)
        if low == high:
            return high, known
        # where the shards of any capacity between the bounds can end
        near, far = known.walk(low, shards, False), known.walk(high, shards, True)
        spans = [(a - high + low, b) for a, b in zip([low, *(x + low for x in near)], [high, *(x + high for x in far)], strict=True)]
        touched = known.open() & np.any([(known.first <= b) & (known.last >= a) for a, b in spans], axis=0)
        stretches = [(int(a), int(b)) for a, b in zip(known.first[touched], known.last[touched], strict=True)]
        merged: list[list[int]] = []
        for a, b in stretches:
            if merged and a - merged[-1][1] <= max(1, total // blocks):
                merged[-1][1] = b
            else:
                merged.append([a, b])
        within = F.lit(False)
        for a, b in merged:
            within = within | F.col("end").between(a, b)
        # finer than the stretches were, so that every round gets closer
        width = max(1, min(sum(b - a + 1 for a, b in merged) // blocks, max(b - a + 1 for a, b in stretches) // 4))
        finer = _fetch(ends.filter(within), width)
        outside = ~np.any([(known.first >= a) & (known.last <= b) for a, b in merged], axis=0)
        known = Ends(*(np.concatenate([old[outside], new]) for old, new in zip((known.first, known.last, known.count), finer, strict=True)))


def even_cuts(known: Ends, capacity: int, shards: int) -> list[int]:
    """Cuts near equal shares of what is left, each leaving a rest that fits the capacity."""
    points = np.unique(np.concatenate([known.first, known.last]))
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        share = at + (known.total - at) / (left + 1)
        place = int(np.searchsorted(points, share))
        near = [int(p) for p in points[max(0, place - 1) : place + 2] if at < p <= at + capacity]
        chosen = next((p for p in sorted(near, key=lambda p: abs(p - share)) if known.fits(capacity, left, False, p)), None)
        at = known.upto(at + capacity, False) if chosen is None else chosen
        cuts.append(at)
    return cuts


def _ordered(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), size_of(text, overhead).alias("size"), F.crc32(whole_text(text).cast("binary")).alias("text_crc32"), group_of(text).alias("grp"))
    rows = stored(rows.withColumn("one", F.lit(1).cast("long")))
    return stored(running_sums(rows, ["grp", "doc_id"], {"before": "size", "place": "one"}, ["doc_id", "size", "text_crc32", "grp"]))


def _borders(ordered: DataFrame, shards: int, blocks: int) -> list[int]:
    """The last group of each shard but the last one, repeated where a shard is empty."""
    ends = stored(ordered.groupBy("grp").agg(F.max(F.col("before") + F.col("size")).alias("end")))
    total = ends.agg(F.max("end")).first()[0] or 0
    if not total:
        return []
    capacity, known = least_capacity(ends.select("end"), total, shards, blocks)
    cuts = even_cuts(known, capacity, shards)
    group = {r["end"]: r["grp"] for r in ends.filter(F.col("end").isin(sorted(set(cuts)))).collect()}
    return [group[c] if c else -(2**63) for c in cuts]


def shard_of(group: Column, borders: list[int]) -> Column:
    """Number of shards that end before the group; borders of empty shards at the end repeat the last group."""
    return sum((F.when(group > F.lit(b), 1).otherwise(0) for b in borders), F.lit(0)).cast("int")


def shards_of(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD, blocks: int = BLOCKS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot (gapless from 0 in the shard)."""
    ordered = _ordered(docs, id_col, text_col, overhead)
    dealt = ordered.withColumn("shard", shard_of(F.col("grp"), _borders(ordered, shards, blocks)))
    # one row per shard
    begins = dealt.groupBy("shard").agg(F.min("place").alias("begin"))
    return dealt.join(F.broadcast(begins), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("begin")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD) -> list[int]:
    """The rows with all their columns as Parquet below ``path/shard=N``; gives the borders.

    A row's shard follows from its text and the borders, so rows are written where they are read.
    """
    if "shard" in docs.columns:
        raise ValueError("the rows have a column named shard, which the folders would hide")
    borders = _borders(_ordered(docs, id_col, text_col, overhead), shards, BLOCKS)
    docs.withColumn("shard", shard_of(group_of(F.col(text_col)), borders)).write.partitionBy("shard").parquet(path)
    return borders
