"""Substring dedup by content-defined chunks.

A gear hash rolls over the words of a text: each step shifts the register by eight bits and adds a random number
that the word stands for, so a register of 32 bits forgets a word after four steps. A chunk ends
where the register is smaller than at the ``REACH`` words on either side. Where chunks end thus depends on the
words nearby alone: an insertion moves the chunks around it and no other, and a passage has
the same chunks wherever it stands. Chunks have five words and more, seven or so on average.

Chunks are deduplicated by digest. A digest that occurs once drops out in the first aggregate. Neighbouring chunks of a
document that all occur elsewhere too form a repeat; repeats shorter than ``MIN_WORDS`` are left alone, as
the chunks at the ends of a passage share words with what stands around it. Of every chunk the occurrence
in the row with the smallest id stays (nulls first, then the earlier place).

Defined results. Words are parted at ASCII white space and compared with A-Z lower-cased; null counts as empty, and a text
without words has no chunk. Repeats within one text count. Repeated rows repeat each other; one of them keeps its text. A text of a single
repeated word is one chunk. Positions are bytes of the UTF-8 text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import as_struct, attach, stored, unnest, whole_text

REACH = 3
MIN_WORDS = 20
_SEED = 11
_MAX = np.iinfo(np.uint32).max


def gear(words: list[bytes]) -> np.ndarray:
    """The register after each word."""
    digest = xxhash.xxh32_intdigest
    numbers = np.array([digest(w, _SEED) for w in words], np.uint32)
    register = numbers.copy()
    for back in (1, 2, 3):
        register[back:] += numbers[:-back] << np.uint32(8 * back)
    return register


def chunk_ends(register: np.ndarray) -> np.ndarray:
    """Number of words up to each chunk's end; the text's end is one."""
    n = len(register)
    wide = np.full(n + 2 * REACH, _MAX, np.uint32)
    wide[REACH : n + REACH] = register
    least = np.ones(n, bool)
    for step in range(1, REACH + 1):
        least &= (register < wide[REACH - step : REACH - step + n]) & (register <= wide[REACH + step : REACH + step + n])
    return np.union1d(np.flatnonzero(least) + 1, [n]) if n else np.zeros(0, np.int64)


def _word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word in the text as it is."""
    raw = np.frombuffer(data, np.uint8)
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    turn = np.flatnonzero(space[1:] != space[:-1])
    return turn[::2], turn[1::2]


def chunks(data: bytes) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Digest, number of words, first byte and end of every chunk."""
    words = data.lower().split()
    ends = chunk_ends(gear(words))
    if not len(ends):
        return [], ends, ends, ends
    begins = np.concatenate(([0], ends[:-1]))
    joined = memoryview(b" ".join(words))
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    digest = xxhash.xxh3_64_intdigest
    digests = [digest(joined[a:b]) for a, b in zip(starts[begins].tolist(), stops[ends - 1].tolist(), strict=True)]
    first, last = _word_places(data)
    return digests, ends - begins, first[begins], last[ends - 1]


def chunked(docs: DataFrame, id_col: str, text_col: str, keep: bool = False) -> DataFrame:
    """Per row: id, row (a number), and the arrays digest, words, begin, finish of its chunks; with the row itself if asked for."""
    kept = [as_struct(docs).alias("_row")] if keep else []
    rows = docs.select(F.col(id_col).alias("id"), *kept, whole_text(F.col(text_col)).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [chunks(t.as_py()) for t in part.column(part.num_columns - 1)]
                digests = [np.array(f[0], np.uint64).view(np.int64) for f in found]
                arrays = [
                    pa.array(digests, pa.list_(pa.int64())),
                    *(pa.array([f[i].astype(np.int32) for f in found], pa.list_(pa.int32())) for i in (1, 2, 3)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(np.arange(row, row + len(part))), *arrays],
                    names=[*part.schema.names[:-1], "row", "digest", "words", "begin", "finish"],
                )
                row += len(part)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, row long, digest array<long>, words array<int>, begin array<int>, finish array<int>")


def _repeats(known: DataFrame, min_words: int) -> DataFrame:
    """Chunks in repeats: id, row, run, c (number in the row), words, begin, finish, next (where the next chunk begins), stays."""
    flat = known.select("row", "id", F.posexplode("digest").alias("c", "digest"))
    facts = flat.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "row", "c")).alias("first")).filter("copies > 1")
    facts = stored(facts.select("digest", "copies", F.col("first.row").alias("first_row"), F.col("first.c").alias("first_c")))
    total = known.agg(F.sum(F.size("digest"))).first()[0] or 0
    repeated = attach(flat.select("row", "c", "digest"), facts, "digest", "copies", total)
    repeated = repeated.select("row", "c", ((F.col("row") == F.col("first_row")) & (F.col("c") == F.col("first_c"))).alias("stays"))
    # per document: the numbers of its repeated chunks, in order
    listed = repeated.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("c", "stays"))).alias("hits"))
    placed = known.select("row", "id", "words", "begin", "finish").join(listed, "row")
    chunk = placed.select("row", "id", F.posexplode("hits").alias("at", "hit"), "words", "begin", "finish")
    chunk = chunk.select(
        "row", "id", (F.col("hit.c") - F.col("at")).alias("run"), F.col("hit.c").alias("c"), F.col("hit.stays").alias("stays"),
        *[F.get(n, F.col("hit.c")).alias(n) for n in ("words", "begin", "finish")],
        F.coalesce(F.get("begin", F.col("hit.c") + 1), F.get("finish", F.col("hit.c"))).alias("next"),
    )
    # a run of neighbours has one difference between number and rank
    whole = chunk.withColumn("run_words", F.sum("words").over(Window.partitionBy("row", "run")))
    return whole.filter(F.col("run_words") >= min_words)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeat in a document: doc_id, start, length (bytes), words, removed_words.

    ``removed_words`` is what ``dedup`` takes away there; it is 0 where the passage stays.
    """
    found = _repeats(stored(chunked(docs, id_col, text_col)), min_words)
    spans = found.groupBy("row", "run").agg(
        F.first("id").alias("doc_id"), F.min("begin").cast("long").alias("start"), F.max("finish").cast("long").alias("end"),
        F.sum("words").alias("words"), F.sum(F.when(F.col("stays"), 0).otherwise(F.col("words"))).alias("removed_words"),
    )
    return spans.select("doc_id", "start", (F.col("end") - F.col("start")).alias("length"), "words", "removed_words")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows with all their columns; from the texts, the chunks of repeats that do not stay are cut out.

    What is left keeps its bytes, so a text may end up empty. A null text stays null.
    """
    known = stored(chunked(docs, id_col, text_col, keep=True))
    cut = _repeats(known.drop("_row"), min_words).filter("NOT stays")
    cuts = cut.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("begin", "next"))).alias("cuts"))
    rows = known.select("row", "_row").join(cuts, "row", "left")
    raw = F.col("_row").getField(text_col).cast("string").cast("binary")
    # what stands between one cut and the next
    froms = F.concat(F.array(F.lit(0)), F.col("cuts.next"))
    tos = F.concat(F.col("cuts.begin"), F.array(F.octet_length(raw)))
    pieces = F.zip_with(froms, tos, lambda a, b: F.substring(raw, a + 1, b - a).cast("string"))
    text = F.when(F.col("cuts").isNull(), F.col("_row").getField(text_col)).otherwise(F.array_join(pieces, ""))
    return unnest(rows.select(F.col("_row").withField(text_col, text).alias("_row")), "_row", docs.columns)
