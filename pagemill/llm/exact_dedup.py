"""Exact dedup: two passes over hashes with a Bloom filter in between, all in built-in functions.

Pass one sets, for every row, two bits within one 64-bit word of a filter; word and bits come
from a hash of the text. Only bits that were set at least twice are kept. Pass two tests each
row against these bits. A text that occurs twice has set its own bits twice, so a row that
fails the test is unique and passes straight through. The others, repeated texts and a few
per cent of chance hits, are grouped by their SHA-256.

Defined results. Null text counts as empty text. Texts are equal if they are identical after
lower-casing A-Z only. Of equal texts the row with the largest id stays; a null id is smaller
than any other. Rows that repeat both id and text are alike in ``groups`` (each is marked kept if its
id is the kept one) and leave a single row in ``dedup``. An empty table gives an empty result.
Other columns play no part and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, as_struct, ascii_lower, attach, one_per_group, small, stored, tie_break, unnest

# Bits of the filter per row of the table.
BITS_PER_ROW = 16
# Memory of one filter word in a broadcast hash table.
WORD_BYTES = 40


def text_sha(text: Column) -> Column:
    return F.sha2(ascii_lower(text).cast("binary"), 256)


def _word_count(rows: int) -> int:
    """A power of two, so that a word number is a mask of the hash."""
    return 1 << max(10, (max(rows, 1) * BITS_PER_ROW // 64).bit_length())


def _word(sha: Column, words: int) -> Column:
    return F.xxhash64(sha).bitwiseAND(F.lit(words - 1))


def _bits(sha: Column) -> list[Column]:
    """Two bit numbers from other bits of the hash than the word number takes first."""
    h = F.xxhash64(sha, F.lit(1))
    return [h.bitwiseAND(F.lit(63)).cast("int"), F.shiftright(h, 6).bitwiseAND(F.lit(63)).cast("int")]


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _mask(sha: Column) -> Column:
    a, b = _bits(sha)
    return _one(a).bitwiseOR(_one(b))


def repeated_bits(hashes: DataFrame, sha: str, words: int) -> DataFrame:
    """The filter: (word, bits) with the bits that at least two rows have set.

    A row whose two bits coincide sets its bit once, so it does not count twice itself.
    """
    bits = hashes.select(_word(F.col(sha), words).alias("word"), F.explode(F.array_distinct(F.array(*_bits(F.col(sha))))).alias("bit"))
    counted = bits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counted.groupBy("word").agg(F.bit_or(_one(F.col("bit"))).alias("bits"))


def suspected(rows: DataFrame, sha: str, repeated: DataFrame, words: int, word_count: int, limit: int) -> DataFrame:
    """The rows with ``_suspect``: whether the filter holds all bits of their hash."""
    filled = small(repeated, word_count, WORD_BYTES, limit)
    tested = rows.withColumn("_word", _word(F.col(sha), words)).join(filled, F.col("_word") == F.col("word"), "left")
    mask = _mask(F.col(sha))
    return tested.withColumn("_suspect", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False))).drop("_word", "word", "bits")


def _filter(hashes: DataFrame, sha: str) -> tuple[DataFrame, int, int, int]:
    """Filter, its number of words, its filled words, the number of rows."""
    rows = hashes.count()
    words = _word_count(rows)
    repeated = stored(repeated_bits(hashes, sha, words))
    return repeated, words, repeated.count(), rows


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, suspected.

    Texts are read once; what follows works on a stored table of ids and hashes.
    """
    hashes = stored(docs.select(F.col(id_col).alias("doc_id"), text_sha(F.col(text_col)).alias("text_sha256")))
    repeated, words, filled, total = _filter(hashes, "text_sha256")
    tested = suspected(hashes, "text_sha256", repeated, words, filled, limit)
    straight = tested.filter(~F.col("_suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256", F.lit(False).alias("suspected")
    )
    suspects = tested.filter("_suspect").select("doc_id", "text_sha256")
    facts = suspects.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    settled = attach(suspects, stored(facts), "text_sha256", "group_size", total).withColumn("suspected", F.lit(True))
    return straight.unionByName(settled.select(*straight.columns)).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "suspected"
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows that stay, with all their columns: one of each text. Unique rows are not shuffled."""
    order = F.struct(F.col(id_col), tie_break(docs)).alias("_order")
    rows = docs.select(as_struct(docs).alias("_row"), order, text_sha(F.col(text_col)).alias("_sha"))
    repeated, words, filled, _ = _filter(rows.select("_sha"), "_sha")
    tested = suspected(rows, "_sha", repeated, words, filled, limit)
    settled = one_per_group(tested.filter("_suspect"), "_sha", "_row", F.col("_order"))
    return unnest(tested.filter(~F.col("_suspect")), "_row", docs.columns).unionByName(settled)
