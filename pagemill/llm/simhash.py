"""SimHash near-dedup with keys from the Golay code.

A fingerprint of 64 bits is three segments of 23, 23 and 18 bits. The perfect Golay code of
length 23 has one codeword within three bits of every vector, so a segment decodes to a
codeword index, and the vectors at most one bit away decode to at most six indices.

Two fingerprints with at most four differing bits have two segments with at most two of them:
the third has at least as many as either. Halfway between the two there is a vector at most one
bit from each, and it decodes to an index pair that both list. So for each of the three
segment pairs a fingerprint lists the index pairs of all vectors one bit away (at most 11), and
fingerprints that share a key are compared bit by bit. No link is lost, none is taken unseen.

Comparison runs on distinct fingerprints that Spark has shuffled and sorted by key. A task turns the
links it finds into a forest, so a group of near copies costs a link per member and not per
pair. A key with very many fingerprints is cut into blocks, and every two blocks meet in a task.

Defined results. Null text counts as empty; a text without words has fingerprint zero and links
like any other. Repeated rows share a fingerprint. A null id is never the smallest unless all
ids of a component are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from . import components
from .common import as_struct, attach, batches_of, small, stored, tie_break, unnest

SEED = 42
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
# Fingerprints of one key that a task compares at once; a key with more is cut into blocks of this size.
BLOCK = 16_384
# Bytes of text that a worker gets at once.
BATCH_BYTES = 1 << 20

# --- fingerprints -------------------------------------------------------------------------

# Shingles whose bits are unpacked at once: 64 bytes each.
_PIECE = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text: words between ASCII white space, A-Z lower-cased, shingles counted as often as they occur."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.array([digest(view[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PIECE):
        part = hashes[at : at + _PIECE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: Column, keep: dict[str, Column], shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The ``keep`` columns with ``fp``: the fingerprint as a signed long."""
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("_text"))
    kept = rows.drop("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
            columns = [*batch.columns[:-1], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "fp long"]))


# --- Golay code ---------------------------------------------------------------------------

# Fixed value: generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the binary Golay code of length 23.
_GENERATOR = 0b101011100011
_SEGMENTS = ((0, 23), (23, 23), (46, 18))
_PAIRS = ((0, 1), (0, 2), (1, 2))


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the 23 unit vectors, and the error of at most three bits for each remainder."""
    unit = []
    for bit in range(23):
        rest = 1 << bit
        for high in range(22, 10, -1):
            if rest >> high & 1:
                rest ^= _GENERATOR << (high - 11)
        unit.append(rest)
    error = np.zeros(2048, np.int64)
    for a in range(23):
        error[unit[a]] = 1 << a
        for b in range(a):
            error[unit[a] ^ unit[b]] = 1 << a | 1 << b
            for c in range(b):
                error[unit[a] ^ unit[b] ^ unit[c]] = 1 << a | 1 << b | 1 << c
    return np.array(unit, np.int64), error


_UNIT, _ERROR = _golay_tables()


def decode(vectors: np.ndarray) -> np.ndarray:
    """Index of the nearest codeword: its upper 12 bits, which no two codewords share."""
    rest = np.zeros_like(vectors)
    for bit in range(23):
        rest ^= (vectors >> bit & 1) * _UNIT[bit]
    return (vectors ^ _ERROR[rest]) >> 11


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``prints``, key) for every key of unsigned 64-bit fingerprints."""
    exact, near = [], []
    for start, width in _SEGMENTS:
        segment = (prints >> np.uint64(start) & np.uint64((1 << width) - 1)).astype(np.int64)
        exact.append(decode(segment))
        near.append(np.stack([exact[-1], *(decode(segment ^ (1 << bit)) for bit in range(width))], axis=1))
    positions, keys = [], []
    for table, (i, j) in enumerate(_PAIRS):
        both = np.concatenate([near[i] << 12 | exact[j][:, None], exact[i][:, None] << 12 | near[j]], axis=1)
        both.sort(axis=1)
        first = np.ones(both.shape, bool)
        first[:, 1:] = both[:, 1:] != both[:, :-1]
        at, _ = np.nonzero(first)
        positions.append(at)
        keys.append(both[first] | table << 24)
    return np.concatenate(positions), np.concatenate(keys)


# --- links --------------------------------------------------------------------------------

# Up to so many fingerprints of a key are compared neighbour by neighbour over the whole batch.
_FEW = 16


def _differing(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    """Number of differing bits; of a signed number ``bitwise_count`` would take the absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64))


class _Forest:
    """Which fingerprints of a partition are linked so far, as trees over the smallest one."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (above := self.up.get(root, root)) != root:
            root = above
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.up.setdefault(min(a, b), min(a, b))


def _link_many(prints: np.ndarray, forest: _Forest, distance: int) -> None:
    """Links within one key: each found group is walked once, its members leave the rest."""
    rest = prints
    while len(rest):
        seed, rest = int(rest[0]), rest[1:]
        open_ = [seed]
        while open_ and len(rest):
            hit = _differing(rest, np.int64(open_.pop())) <= distance
            if hit.any():
                found = rest[hit].tolist()
                rest = rest[~hit]
                open_ += found
                for x in found:
                    forest.join(seed, x)


def _link_runs(key: np.ndarray, prints: np.ndarray, forest: _Forest, distance: int) -> None:
    """Links within runs of equal keys; every run is whole."""
    edge = np.flatnonzero(key[1:] != key[:-1]) + 1
    starts = np.concatenate(([0], edge))
    lengths = np.diff(np.concatenate((starts, [len(key)])))
    for s, n in zip(starts[lengths > _FEW].tolist(), lengths[lengths > _FEW].tolist(), strict=True):
        _link_many(np.unique(prints[s : s + n]), forest, distance)
    few = np.repeat(lengths, lengths) <= _FEW
    key, prints = key[few], prints[few]
    for step in range(1, min(_FEW, len(key))):
        same = key[step:] == key[:-step]
        if not same.any():
            break
        hit = np.flatnonzero(same & (_differing(prints[step:], prints[:-step]) <= distance))
        for x, y in zip(prints[hit].tolist(), prints[hit + step].tolist(), strict=True):
            forest.join(x, y)


def _find_links(distance: int):
    """Task over rows (key, cell, fp) sorted by key and cell: the forest of its links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held_key, held = _Forest(), [], []

        def flush(whole_key: np.ndarray, whole: np.ndarray) -> None:
            if len(whole_key) > 1:
                _link_runs(whole_key, whole, forest, distance)

        for batch in batches:
            key = batch.column(0).to_numpy() << 36 | batch.column(1).to_numpy()
            held_key.append(key)
            held.append(batch.column(2).to_numpy())
            if key[0] == key[-1] == held_key[0][0]:
                continue  # one run so far: it is held until it ends
            keys, prints = np.concatenate(held_key), np.concatenate(held)
            last = int(np.searchsorted(keys, keys[-1]))
            flush(keys[:last], prints[:last])
            held_key, held = [keys[last:]], [prints[last:]]
        if held:
            flush(np.concatenate(held_key), np.concatenate(held))
        nodes = [(x, forest.find(x)) for x in forest.up]
        nodes = [(x, r) for x, r in nodes if x != r]
        for at in range(0, len(nodes), 100_000):
            part = nodes[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], names=["a", "b"])

    return run


def links(prints: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """(a, b): links of distinct fingerprints ``fp``, enough of them to connect whatever is within ``distance``."""
    if distance > MAX_DISTANCE:
        raise ValueError(f"the keys find links of at most {MAX_DISTANCE} bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                position, key = keys_of(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[position])], names=["key", "fp"])

    keyed = prints.select("fp").mapInArrow(run, "key long, fp long")
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    crowded = stored(crowded.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1)).cast("long")
    own = F.pmod(F.xxhash64("fp"), blocks)
    grid = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.least(own, j) * blocks + F.greatest(own, j))
    dealt = keyed.join(small(crowded, crowded.count(), 32), "key", "left").select("key", F.explode(grid).alias("cell"), "fp")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "key", "cell").sortWithinPartitions("key", "cell").mapInArrow(_find_links(distance), "a long, b long")


# --- operator -----------------------------------------------------------------------------


def _facts(light: DataFrame, distance: int, block: int) -> tuple[DataFrame, int]:
    """Per fingerprint: number of rows, smallest id and size of its component, its root; and the number of rows."""
    prints = stored(light.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    roots = components.roots(links(prints, distance, block))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted)
    parts = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("component_size"), F.count(F.lit(1)).alias("prints"))
    total = light.count()
    return attach(rooted, parts, "root", "prints", total), total


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = MAX_DISTANCE, shingle_words: int = SHINGLE_WORDS, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id (smallest id that links reach), component_size."""
    with batches_of(docs.sparkSession, BATCH_BYTES):
        light = stored(fingerprints(docs, F.col(text_col), {"doc_id": F.col(id_col)}, shingle_words))
    facts, total = _facts(light, distance, block)
    return attach(light, stored(facts), "fp", "n", total).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size"
    )


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = MAX_DISTANCE, shingle_words: int = SHINGLE_WORDS, block: int = BLOCK
) -> DataFrame:
    """The rows that stay, with all their columns: of each component the row with the smallest id.

    Rows alone in their component are not shuffled unless the list of the others is too large to ship.
    """
    row_key = {"_id": F.col(id_col), "_hash": F.xxhash64(F.col(text_col))}
    with batches_of(docs.sparkSession, BATCH_BYTES):
        light = stored(fingerprints(docs, F.col(text_col), {"doc_id": F.col(id_col), **row_key}, shingle_words))
    facts, total = _facts(light, distance, block)
    crowd = attach(light, stored(facts), "fp", "n", total).filter("component_size > 1").select("_id", "_hash", "root").distinct()
    crowd = stored(crowd.withColumnsRenamed({"_id": "_cid", "_hash": "_chash"}))
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), tie_break(docs)).alias("_order")
    rows = docs.select(as_struct(docs).alias("_row"), order, *[c.alias(n) for n, c in row_key.items()])
    listed = small(crowd, crowd.count(), 48)
    tagged = rows.join(listed, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_hash") == F.col("_chash")), "left")
    alone = unnest(tagged.filter("root IS NULL"), "_row", docs.columns)
    grouped = tagged.filter("root IS NOT NULL").groupBy("root").agg(F.min_by("_row", F.col("_order")).alias("_row"))
    return alone.unionByName(unnest(grouped, "_row", docs.columns))
