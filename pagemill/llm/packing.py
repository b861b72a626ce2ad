"""Packing documents into training sequences along a space-filling curve.

A document's token counts are hashed into a vector, the vector is scaled to length one and projected to a
few dimensions, and the place of the projection on a Hilbert curve is the document's key. Documents in the order of
their keys form one stream, in which similar documents are neighbours; the stream is cut every
``length`` tokens. What remains at the end becomes sequences of powers of two, so that nothing needs padding.

Texts are tokenised once. Their ids stay in a stored table; ordering, which needs a range shuffle, moves only (key, id,
row, length). Running sums are taken within range partitions, and one number per partition makes
them global. No sort or sum passes through a single task.

Defined results. Null text counts as empty; an empty text is the end token alone. Ties of the key are ordered by
id (nulls first) and then by row, so repeated rows each have a place of their own. Ids may repeat or be null. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import batches_of, small, stored, whole_text
from .hilbert import hilbert_keys
from .prefix import running_sums

LENGTH = 2048
END_ID = 1
DIMENSIONS = 4
BITS = 10
BUCKETS = 4096
SEED = 7
# Words whose ids a worker remembers, and words looked up at once.
KNOWN_WORDS = 300_000
SLICE_WORDS = 200_000
# Bytes of text that a worker gets at once: what it makes of them takes some twenty times as much.
BATCH_BYTES = 1 << 20
# ASCII signs that can follow a word as one run; the apostrophe starts contractions and "<" special tokens.
_SIGNS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"


class WordIds:
    """Token ids of texts, word by word: the tokenizer splits at white space, so a word's ids do not depend on its neighbours.

    Words are parted at ASCII white space only; any other is left to the tokenizer. The words of many texts are parted and
    numbered in Arrow; only different ones are looked up among those a worker remembers, and only new ones are tokenised.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        # tokens that end a run of letters, digits or signs
        self.ends = np.zeros(self.size + 1, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.code: dict[bytes, int] = {}
        self.start, self.count, self.pool, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32), 0
        self.again = np.zeros(1024, bool)

    def _forget_rare(self) -> None:
        """Keep the words that were met again since the last time, unless they fill half the room."""
        kept = np.flatnonzero(self.again[: len(self.code)])
        if len(kept) > KNOWN_WORDS // 2:
            kept = kept[:0]
        words, counts = list(self.code), self.count[kept]
        ids = self._gathered(kept, counts)
        self._forget()
        self._add([words[n] for n in kept.tolist()], counts, ids)

    def _learn(self, words: list[bytes]) -> None:
        """Words of letters before a run of ASCII signs are made of both: the tokenizer parts letters from signs."""
        letters, others, parted, known = {}, {}, [], self.code
        for word, text in zip(words, [w.decode("utf-8", "replace") for w in words], strict=True):
            if text.isalpha():
                letters[word] = text
                continue
            base = text.rstrip(_SIGNS)
            if len(base) < len(text) and base.isalpha():
                sign = len(text) - len(base)
                front, back = word[:-sign], word[-sign:]
                parted.append((word, front, back))
                if front not in known:
                    letters[front] = base
                if back not in known:
                    others[back] = text[-sign:]
            else:
                others[word] = text
        self._encode(letters, self._by_ends)
        self._encode(others, self._by_offsets)
        if parted:
            code = np.array([(known[front], known[back]) for _, front, back in parted], np.int64)
            counts = self.count[code]
            self._add([word for word, _, _ in parted], counts.sum(axis=1), self._gathered(code.ravel(), counts.ravel()))

    def _gathered(self, code: np.ndarray, counts: np.ndarray) -> np.ndarray:
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.repeat(self.start[code] - ends + counts, counts) + np.arange(total)]

    def _add(self, words: list[bytes], counts: np.ndarray, ids: np.ndarray) -> None:
        first, n = len(self.code), len(words)
        self.start, self.count, self.again = _room(self.start, first + n), _room(self.count, first + n), _room(self.again, first + n)
        self.pool = _room(self.pool, self.used + len(ids))
        self.count[first : first + n] = counts
        self.start[first : first + n] = self.used + np.cumsum(counts) - counts
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.code.update(zip(words, range(first, first + n), strict=True))

    def _encode(self, texts: dict[bytes, str], counted: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        """Tokenise new words; some may be known since, as the front or back of another."""
        words = [w for w in texts if w not in self.code]
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            self._add(part, *counted([texts[w] for w in part]))

    def _by_ends(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens and the ids of words of letters, each of which ends with its only token that ends a run."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(self.ends[ids])
        # letters whose small form is more than letters make several runs
        if len(ends) != len(texts) or ends[-1] != len(ids) - 1:
            return self._by_offsets(texts)
        return np.diff(ends, prepend=-1), ids

    def _by_offsets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(encoded.ids, np.int32)
        owner = np.searchsorted(starts, np.array([a for a, _ in encoded.offsets], np.int64), "right") - 1
        return (np.bincount(owner, minlength=len(texts)) if len(ids) else np.zeros(len(texts), np.int64)), ids

    def _coded(self, words: pa.Array) -> np.ndarray:
        """The number of each word among those remembered."""
        numbered = words.dictionary_encode()
        # words hold no space; joining and parting them again is faster than taking them one by one
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(numbered.dictionary)], numbered.dictionary.cast(pa.large_binary())), pa.scalar(b" ", pa.large_binary()))
        different = joined[0].as_py().split(b" ")
        if len(self.code) + len(different) > KNOWN_WORDS:
            self._forget_rare()
        code = np.fromiter(map(self.code.get, different, repeat(-1)), np.int64, len(different))
        self.again[code[code >= 0]] = True
        missing = np.flatnonzero(code < 0).tolist()
        if missing:
            self._learn([different[n] for n in missing])
            code[missing] = [self.code[different[n]] for n in missing]
        return code[numbered.indices.to_numpy()]

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        texts = texts.cast(pa.large_string())
        # the tokenizer lower-cases; a special token in capitals would become one, though
        low = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(low)
        words, bounds = split.flatten(), np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))
        ids, ends = [], [np.zeros(1, np.int64)]
        for at in range(0, len(words), SLICE_WORDS):
            code = self._coded(words.slice(at, SLICE_WORDS))
            counts = self.count[code]
            ids.append(self._gathered(code, counts))
            ends.append(ends[-1][-1] + np.cumsum(counts))
        cuts = np.concatenate(ends)[bounds]
        return np.split(np.concatenate([np.zeros(0, np.int32), *ids]), cuts[1:-1]) if len(texts) else []

    def ids(self, text: bytes) -> np.ndarray:
        return self.batch(pa.array([text], pa.large_binary()))[0]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One memory of words per worker, which serves all its tasks."""
    return WordIds(path)


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The array, or one at least twice as long with the same beginning."""
    if size <= len(values):
        return values
    wider = np.zeros(max(size, 2 * len(values)), values.dtype)
    wider[: len(values)] = values
    return wider


def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS))


def curve_keys(token_ids: list[np.ndarray], projection: np.ndarray) -> np.ndarray:
    """Keys of documents from their ids: hashed counts, damped and of length one, projected, and placed on the curve."""
    places = np.zeros((len(token_ids), DIMENSIONS))
    for row, ids in enumerate(token_ids):
        bucket = (ids.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(20)) & np.uint32(BUCKETS - 1)
        vector = np.log1p(np.bincount(bucket.astype(np.int64), minlength=BUCKETS))
        places[row] = vector @ projection / max(np.linalg.norm(vector), 1e-12)
    # the projection of a vector of length one is about standard normal: its distribution function spreads it evenly
    cells = np.minimum((1 << BITS) / (1 + np.exp(-1.702 * places)), (1 << BITS) - 1).astype(np.int64)
    return hilbert_keys(cells, BITS)


def tokenised(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """(id, row, n, key, ids): ids as little-endian numbers, of two bytes if the vocabulary allows."""
    rows = docs.select(F.col(id_col).alias("id"), whole_text(F.col(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, projection, row = word_ids(tokenizer), _projection(), TaskContext.get().partitionId() << 33
        kind = _kind(max(words.size - 1, end_id))
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                found = [np.append(ids, np.int32(end_id)) for ids in words.batch(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.arange(row, row + len(found))),
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array(curve_keys(found, projection)),
                        pa.array([x.astype(kind).tobytes() for x in found], pa.binary()),
                    ],
                    names=["id", "row", "n", "key", "ids"],
                )
                row += len(found)

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, row long, n long, key long, ids binary")


def _kind(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def _tail(total: int, length: int) -> list[int]:
    """Ends of the sequences behind the last full one: powers of two, largest first."""
    end, rest = total // length * length, total % length
    ends = []
    for bit in range(length.bit_length(), -1, -1):
        if rest >> bit & 1:
            end += 1 << bit
            ends.append(end)
    return ends


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    with batches_of(docs.sparkSession, BATCH_BYTES):
        tokens = stored(tokenised(docs, tokenizer, id_col, text_col, end_id))
    places = stored(running_sums(tokens.select("key", "id", "row", "n"), ["key", "id", "row"], {"start": "n"}, ["row"]).withColumnRenamed("row", "_row"))
    facts = tokens.agg(F.sum("n"), F.count(F.lit(1)), F.max(F.length("ids") / F.col("n"))).first()
    total, count, width = facts[0] or 0, facts[1], int(facts[2] or 2)
    ends, full, kind = np.array(_tail(total, length), np.int64), total // length, f"<u{width}"
    placed = tokens.join(small(places, count, 48), F.col("row") == F.col("_row")).select("id", "start", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                yield _pieces(batch.slice(at, 64), kind, length, full, ends)

    kind_of_id = dict(placed.dtypes)["id"]
    return placed.mapInArrow(run, f"doc_id {kind_of_id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def _pieces(batch: pa.RecordBatch, kind: str, length: int, full: int, ends: np.ndarray) -> pa.RecordBatch:
    owner, columns = [], [[] for _ in range(6)]
    for row, (begin, packed) in enumerate(zip(batch.column(1).to_numpy().tolist(), batch.column(2), strict=True)):
        ids = np.frombuffer(packed.as_py(), kind).astype("<u4")
        cuts = np.arange((begin // length + 1) * length, min(begin + len(ids), full * length + 1), length)
        cuts = np.concatenate(([begin], cuts, ends[(ends > begin) & (ends < begin + len(ids))], [begin + len(ids)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a < full * length:
                sequence, first = a // length, a // length * length
            else:
                behind = int(np.searchsorted(ends, a, "right"))
                sequence, first = full + behind, int(ends[behind - 1]) if behind else full * length
            owner.append(row)
            for column, value in zip(columns, (a - begin, b - a, ids[a - begin : b - begin].tobytes(), len(ids), sequence, a - first), strict=True):
                column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )
