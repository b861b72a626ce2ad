"""Resampling documents by importance: those are drawn whose word n-grams look like a target's.

Texts are lower-cased (A-Z only) and normalised: words of digits, letters and all signs beyond ASCII, one space between them.
Every run of 1 to n words is a feature, hashed by its CRC-32 into a bucket. The CRC-32 of all runs comes from
running values that one scan of a text stores (``crcgrams``). A bucket's gain is the smoothed logarithm of its share in
the target over its share in the corpus; a document's weight is the sum of its features' gains. Weight plus Gumbel noise
from a hash of the id is its score, and the highest scores are a draw without replacement by weight.

Texts are scanned once: the buckets of each text's features go to a stored table, from which both the corpus's counts and the weights
come. Counts are summed per task first, so that one number a bucket and task is shuffled; gains (one number
a bucket) are shipped to every task. Ranks are running counts over range partitions, and only numbers are sorted.

Defined results. Null texts count as empty and have no feature. Ids may repeat or be null: equal scores are ranked by id (nulls first),
then by features and weight. Empty tables give an empty result or gains of zero. Long texts are scanned in blocks, over whose
ends runs of words go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import batches_of, stored, whole_text
from .crcgrams import Prefixes
from .prefix import running_sums

BUCKETS = 10_000
WORDS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
BLOCK_BYTES = 4 << 20

_KEPT = np.zeros(256, bool)
_KEPT[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The normalised bytes, starts and ends of words in them, and the words' starts in the data."""
    low = _LOWER[data]
    kept = _KEPT[low]
    behind = np.append(False, kept[:-1])
    first = np.flatnonzero(kept & ~behind)
    # a word's signs and one sign behind it stay
    stays = np.flatnonzero(kept | behind)
    plain = np.where(kept[stays], low[stays], np.uint8(0x20))
    starts = np.searchsorted(stays, first)
    ends = np.append(starts[1:] - 1, len(plain) - (0 if not len(plain) or kept[stays[-1]] else 1))[: len(starts)]
    return plain, starts, ends, first


def buckets_of(texts: list[bytes], words: int, buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each text the buckets of all its features, and its number of words."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    plain, starts, ends, first = _words_of(data)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    owner = np.searchsorted(np.cumsum(sizes), first, "right")
    prefixes, found, owners = Prefixes(plain), [], []
    for n in range(1, words + 1):
        whole = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
        found.append(prefixes.spans(starts[whole], ends[whole + n - 1]) % np.uint32(buckets))
        owners.append(owner[whole])
    owners, found = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    cuts = np.cumsum(np.bincount(owners, minlength=len(texts)))[:-1]
    return np.split(found[order], cuts), np.bincount(owner, minlength=len(texts))


def _long_text(text: bytes, words: int, buckets: int) -> tuple[np.ndarray, int]:
    """A long text's buckets and words, block by block. A block ends behind a word and starts with the last words of the one before."""
    found, count, at, tail = [], 0, 0, b""
    while at < len(text):
        end = at + BLOCK_BYTES
        while end < len(text) and _KEPT[_LOWER[text[end - 1]]]:
            inside = ~_KEPT[_LOWER[np.frombuffer(text[end : end + BLOCK_BYTES], np.uint8)]]
            end += int(inside.argmax()) + 1 if inside.any() else BLOCK_BYTES
        block = text[at:end]
        [new], number = buckets_of([tail + b" " + block], words, buckets)
        if tail:
            [old], known = buckets_of([tail], words, buckets)
            # the runs inside the repeated words were counted with the block before
            new = np.repeat(np.arange(buckets), np.bincount(new, minlength=buckets) - np.bincount(old, minlength=buckets))
            number = number - known
        found.append(new.astype(np.uint32))
        count, at = count + int(number[0]), end
        tail = _last_words(tail + b" " + block, words - 1)
    return np.concatenate([np.zeros(0, np.uint32), *found]), count


def _last_words(text: bytes, words: int) -> bytes:
    if not words:
        return b""
    plain, starts, _, _ = _words_of(np.frombuffer(text, np.uint8))
    return plain[starts[-min(words, len(starts))] :].tobytes() if len(starts) else b""


def features(rows: DataFrame, id_col: str, text_col: str, words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, buckets): the buckets of each text's features as little-endian numbers."""
    texts = rows.select(F.col(f"`{id_col}`").alias("id"), whole_text(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch):
                column = [t.as_py() for t in some.column(1)]
                if len(column) == 1 and len(column[0]) > BLOCK_BYTES:
                    found, counts = ([x] for x in _long_text(column[0], words, buckets))
                else:
                    found, counts = buckets_of(column, words, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array(np.asarray(counts, np.int64)),
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array([x.astype(kind).tobytes() for x in found], pa.binary()),
                    ],
                    names=["id", "n_words", "n_features", "buckets"],
                )

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, n_words long, n_features long, buckets binary")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most BLOCK_BYTES of text; a longer text is a slice of its own."""
    ends = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)])
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts lie in each bucket."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                sums += np.bincount(np.frombuffer(text.as_py(), kind), minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["bucket", "amount"])

    summed = found.select("buckets").mapInArrow(run, "bucket long, amount long").groupBy("bucket").agg(F.sum("amount").alias("amount"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():  # one number a bucket
        out[row.bucket] = row.amount
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus."""
    t, s, buckets = target.astype(float), corpus.astype(float), len(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _noise(doc_id: Column, seed: int) -> Column:
    hexed = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(hexed, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(share)))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", words: int = WORDS,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; the drawn ones have a rank."""
    spark = docs.sparkSession
    with batches_of(spark, BLOCK_BYTES):
        found = stored(features(docs, id_col, text_col, words, buckets))
    wanted = counts(features(target, target_text, target_text, words, buckets), buckets)
    gain, kind = gains(wanted, counts(found, buckets)), _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gain[np.frombuffer(b.as_py(), kind)].sum()) for b in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in range(3)), pa.array(weights, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    kind_of_id = found.schema["id"].dataType.simpleString()
    weighed = found.mapInArrow(run, f"doc_id {kind_of_id}, n_words long, n_features long, weight long")
    scored = stored(weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)))
    able = scored.filter(F.col("n_words") >= least_words).withColumns({"_down": -F.col("score"), "_one": F.lit(1).cast("long")})
    drawn = able.count() * percent // 100
    columns = scored.columns
    placed = running_sums(able, ["_down", "doc_id", "n_features", "weight"], {"_before": "_one"}, columns)
    ranked = placed.select(*columns, F.when(F.col("_before") < drawn, F.col("_before") + 1).alias("rank"))
    return ranked.unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
