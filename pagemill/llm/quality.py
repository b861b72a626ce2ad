"""Quality classifier by compression.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad. A
text like the good ones packs better with the good dictionary. Two numbers describe a whole text:
the difference of its compressed sizes with the bad and the good dictionary, and its size
packed without any, both divided by its length. The second tells texts that repeat themselves, for
which any difference is small, from ordinary ones. A logistic fit on labelled texts that no
dictionary has seen turns them into a probability.

A dictionary helps only at the start of what is packed, so a text is packed in blocks of ``BLOCK_BYTES``,
all of them and each on its own, and the sizes are summed: the numbers do not depend on how long a text
is. A passage that comes again only in other blocks thus counts as new (that is what ``substring`` finds).

Learning takes a bounded sample (``SAMPLE_ROWS`` per class, chosen by a hash of the id, and of each
at most ``SAMPLE_CHARS`` for a dictionary); scoring takes every row and whole texts, in Arrow
batches, with a model of two dictionaries and three numbers.

Defined results. Null text counts as empty, and empty texts get a score too. Labels other than 0
and 1, without id, or contradicting each other are not learnt from. Without labels of both classes
every text gets the share of good labels, (good + 1) / (all + 2), and ``keep_good`` rejects nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .common import as_struct, stored, unnest, whole_text

SAMPLE_ROWS = 2000
SAMPLE_CHARS = 8192
DICTIONARY_BYTES = 1 << 15
BLOCK_BYTES = 8192
LEVEL = 3
GOOD_FROM = 0.7


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float

    @property
    def trained(self) -> bool:
        return bool(self.weights)


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the plain texts if they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        share = max(1, DICTIONARY_BYTES // max(1, len(texts)))
        return b"\n".join(t[:share] for t in texts)[:DICTIONARY_BYTES]


class Packer:
    """Compressed sizes of texts with both dictionaries and with none."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        def packer(content: bytes | None) -> zstandard.ZstdCompressor:
            if not content:
                return zstandard.ZstdCompressor(level=LEVEL)
            words = zstandard.ZstdCompressionDict(content)
            words.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=words)

        self.good, self.bad, self.plain = packer(good), packer(bad), packer(None)

    def numbers(self, text: str | None) -> tuple[float, float]:
        data = (text or "").encode()
        g = b = p = 0
        for at in range(0, max(1, len(data)), BLOCK_BYTES):
            block = data[at : at + BLOCK_BYTES]
            g, b, p = g + len(self.good.compress(block)), b + len(self.bad.compress(block)), p + len(self.plain.compress(block))
        return (b - g) / (len(data) + 1), float(np.log((p + 1) / (len(data) + 20)))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted logistic regression with a slight ridge, by Newton's method."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    a = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    ridge = 0.01 * np.eye(len(w))
    for _ in range(50):
        p = _squash(a @ w)
        h = weight * (p * (1 - p) + 1e-6)
        w += np.linalg.solve((a * h[:, None]).T @ a + ridge, a.T @ (weight * (y - p)) - ridge @ w)
    return centre, scale, w


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_texts(model: Model, texts: list[str | None], packer: Packer | None = None) -> np.ndarray:
    if not model.trained:
        return np.full(len(texts), model.prior)
    packer = packer or Packer(model.good, model.bad)
    x = np.array([packer.numbers(t) for t in texts]).reshape(len(texts), 2)
    # term by term, so that a text's score does not depend on its batch
    z = np.full(len(texts), model.weights[-1])
    for column, centre, scale, weight in zip(x.T, model.centre, model.scale, model.weights[:-1], strict=True):
        z = z + (column - centre) / scale * weight
    return _squash(z)


def _label_rows(labels: DataFrame, id_col: str, label_col: str, learn_from: Column | None) -> DataFrame:
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter("_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    return known if learn_from is None else known.filter(learn_from)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn_from: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """The model from labelled rows. ``learn_from`` is a condition on ``_id`` that a label must meet to be learnt from."""
    known = stored(_label_rows(labels, id_col, label_col, learn_from))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = counts.get(0, 0), counts.get(1, 0)
    prior = (good + 1) / (good + bad + 2)
    rank = F.xxhash64("_id")
    chosen = [known.filter(F.col("label") == label).orderBy(rank, "_id").limit(sample_rows) for label in (0, 1)]
    texts = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("text"))
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_id").withColumn("role", F.pmod(F.shiftright(rank, 8), F.lit(2)))
    found = stored(found)
    # a window of the text at a place that the hash chooses
    start = F.pmod(rank, F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1)).cast("long")).cast("int") + 1
    windows = found.filter("role = 0").select("label", "_id", F.substr("text", start, F.lit(SAMPLE_CHARS)).alias("text"))
    samples = windows.orderBy("_id", "text").limit(2 * sample_rows).collect()
    seen = {label: [r.text.encode() for r in samples if r.label == label and r.text] for label in (0, 1)}
    if not seen[0] or not seen[1]:
        return Model(b"", b"", (), (), (), prior)
    dictionaries = _dictionary(seen[1]), _dictionary(seen[0])

    @arrow_udf("array<double>")
    def numbers(column: pa.Array) -> pa.Array:
        packer = Packer(*dictionaries)
        return pa.array([list(packer.numbers(t.as_py())) for t in column], pa.list_(pa.float64()))

    measured = found.filter("role = 1").select("_id", "label", numbers("text").alias("x")).orderBy("_id", "x").limit(2 * sample_rows).collect()
    y = np.array([r.label for r in measured], float)
    if len(set(y)) < 2:
        return Model(b"", b"", (), (), (), prior)
    share = np.where(y == 1, good / max(1, (y == 1).sum()), bad / max(1, (y == 0).sum()))
    centre, scale, w = _fit(np.array([r.x for r in measured]), y, share / share.mean())
    return Model(*dictionaries, tuple(centre), tuple(scale), tuple(w), prior)


def score(model: Model):
    """A function of a text column: the probability that the text is good."""

    @arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        packer = Packer(model.good, model.bad) if model.trained else None
        return pa.array(np.concatenate([np.zeros(0), *(score_texts(model, [t.as_py()], packer) for t in column)]), pa.float64())

    return scored


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", good_from: float = GOOD_FROM) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    got = docs.select(F.col(id_col).alias("doc_id"), score(model)(whole_text(F.col(text_col))).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= good_from).cast("int"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", good_from: float = GOOD_FROM) -> DataFrame:
    """The rows that the model does not reject, with all their columns."""
    if not model.trained:
        return docs
    rows = docs.select(as_struct(docs).alias("_row"), score(model)(whole_text(F.col(text_col))).alias("_score"))
    return unnest(rows.filter(F.col("_score") >= good_from), "_row", docs.columns)
