import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pagemill.llm import importance
from pagemill.llm.crcgrams import Prefixes
from pagemill.llm.queries import op13_importance_resampling

from .helpers import UPPER_TO_LOWER, clashing, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features_by_hand(text, words):
    found = WORD.findall((text or "").translate(UPPER_TO_LOWER))
    runs = [" ".join(found[i : i + n]) for n in range(1, words + 1) for i in range(len(found) - n + 1)]
    return len(found), Counter(zlib.crc32(r.encode()) % importance.BUCKETS for r in runs)


def by_hand(pairs, target, words=1, least=20, percent=10):
    made = [(i, *features_by_hand(t, words)) for i, t in pairs]
    s, t = (sum((f for f in x), Counter()) for x in ([m[2] for m in made], [features_by_hand(x, words)[1] for x in target]))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in s}
    scored = []
    for i, n, f in made:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * k for b, k in f.items())
        scored.append((i, n, f.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in scored if x[1] >= least), key=lambda x: (-x[4], x[0] is not None, x[0], x[2], x[3]))
    drawn = Counter((*x, r) for r, x in enumerate(able[: len(able) * percent // 100], 1))
    return drawn + Counter((*x, None) for x in able[len(able) * percent // 100 :]) + Counter((*x, None) for x in scored if x[1] < least)


def texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("aeiouBCDfé7", k=rng.randint(1, 7))) for _ in range(300)] + ["naïve", "日本語", "x" * 200]
    marks = [" ", "  ", ", ", ".\n", "\t", " — ", "'", "\x00", "@", "[", "`"]
    return ["".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("words", [1, 2, 3])
def test_scores_and_ranks_equal_those_by_hand(spark, words):
    pairs = [*enumerate(texts(400)), (None, None), (None, "a b c " * 20), (5000, ""), (5001, "..."), (7, texts(400)[7]), (5002, "Straße É ÀÉ " * 30)]
    target = [*texts(30, 2), None, ""]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(clashing(docs(spark, pairs)), goal, words=words)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in got.collect()) == by_hand(pairs, target, words)


@pytest.mark.parametrize("words", [1, 2, 4])
def test_long_texts_go_on_over_blocks(spark, monkeypatch, words):
    monkeypatch.setattr(importance, "BLOCK_BYTES", 1000)
    long = " ".join(texts(300)) + "y" * 5000 + " ".join(texts(100, 3))
    found, count = importance._long_text(long.encode().translate(None), words, importance.BUCKETS)
    number, wanted = features_by_hand(long, words)
    assert count == number and Counter(found.tolist()) == wanted


def test_crc_of_spans():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 129, 5000, 300_001):
        data = rng.integers(0, 256, size).astype(np.uint8)
        prefixes, starts = Prefixes(data), rng.integers(0, size + 1, 200)
        ends = np.array([int(rng.integers(s, size + 1)) for s in starts])
        assert [int(x) for x in prefixes.spans(starts, ends)] == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def test_empty_tables(spark):
    goal = spark.createDataFrame([], "text string")
    assert importance.resample(docs(spark, []), goal).collect() == []
    got = importance.resample(docs(spark, ["a b c"] * 30), goal, least_words=3).collect()
    assert {r.weight for r in got} == {3 * math.floor(1000 * math.log(10090 / (31 * 10000)))} and sorted(r.rank for r in got if r.rank) == [1, 2, 3]


def test_target_like_texts_are_drawn_more(spark):
    rng = random.Random(9)
    pairs = [(i, " ".join(rng.choices(["red", "green", "blue"] if i % 10 == 0 else ["one", "two", "three"], k=40))) for i in range(500)]
    goal = spark.createDataFrame([("red green blue " * 10,)], "text string")
    drawn = [r.doc_id for r in importance.resample(docs(spark, pairs), goal).collect() if r.rank]
    assert len(drawn) == 50 and all(i % 10 == 0 for i in drawn)


def test_query_returns_every_document(spark):
    sf = "/root/testdata/sf0.001"
    got = op13_importance_resampling(spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for c, t in got.dtypes} == {"bigint"} and got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
