import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int"


def fixture(n=150, dimension=32, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss((i % 3) / 4, 0.2) for _ in range(dimension)], i % 5 or None) for i in range(n)]
    return [(i, np.array(v, np.float32).tolist(), label) for i, v, label in rows]


def by_hand(rows, parts=16, entries=64, rounds=2):
    """Codes in plain Python whole numbers."""
    kept = sorted((r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: r[0])
    whole = {r[0]: [math.floor(256 * x) for x in r[1]] for r in kept}
    size = len(next(iter(whole.values()))) // parts
    cut = {i: [v[p * size : (p + 1) * size] for p in range(parts)] for i, v in whole.items()}
    books = [[cut[r[0]][p] for r in kept[:entries]] for p in range(parts)]

    def best(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for v in cut.values():
                of[best(p, v[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e], strict=True)] if of[e] else old for e, old in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    found = {i: [best(p, v[p]) for p in range(parts)] for i, v in cut.items()}
    errors = {i: sum(d for d, _ in f) for i, f in found.items()}
    of_label = defaultdict(int)
    for i, _, label in kept:
        of_label[label] += errors[i]
    return {i: ("".join(f"{e:02x}" for _, e in found[i]), errors[i], of_label[label], digest) for i, _, label in kept}


def result(df):
    return {r.id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()}


@pytest.mark.parametrize("dimension", [16, 32, 48, 80])
def test_codes_equal_those_by_hand(spark, dimension):
    rows = fixture(dimension=dimension)
    rows += [(1000, None, 1), (1001, [None] * dimension, 1), (1002, [float("nan")] * dimension, 1), (1003, [0.1] * (dimension - 1) + [float("-inf")], 1)]
    got = result(vectorcodes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert got == by_hand(rows)


def test_few_equal_and_repeated_vectors(spark):
    same = [(i, [0.5] * 16, None) for i in range(5)]
    assert result(vectorcodes.compress(spark.createDataFrame(same, SCHEMA))) == by_hand(same)
    twice = spark.createDataFrame([*fixture(20), *fixture(20), (None, fixture(1)[0][1], 2)], SCHEMA)
    got = vectorcodes.compress(twice).collect()
    assert len(got) == 41 and len({(r.id, r.code) for r in got if r.id is not None}) == 20


def test_empty_tables_odd_lengths_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vectorcodes.compress(empty).collect() == []
    assert vectorcodes.compress(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).collect() == []
    rows = fixture(40)
    clashing = spark.createDataFrame([*rows, (90, [1.0], 1)], SCHEMA).withColumns({c: F.lit("x") for c in ("id", "v", "code", "error", "_key", "place")})
    assert result(vectorcodes.compress(clashing)) == by_hand(rows)
    odd = [(i, v[:21], x) for i, v, x in rows]
    padded = [(i, v[:21] + [0.0] * 11, x) for i, v, x in rows]
    assert {i: x[:2] for i, x in result(vectorcodes.compress(spark.createDataFrame(odd, SCHEMA))).items()} == {i: x[:2] for i, x in by_hand(padded).items()}


def test_large_components_are_held(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 16, 1) for i in range(6)]
    got = vectorcodes.compress(spark.createDataFrame(rows, SCHEMA), entries=1).collect()
    assert len(got) == 6 and all(r.error >= 0 for r in got)


def test_transform_scales_distances_exactly():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 4, 5, 8, 12):
        a, b = rng.integers(-5000, 5000, (40, size)), rng.integers(-5000, 5000, (9, size))
        x, y = vectorcodes.transformed(a), vectorcodes.transformed(b)
        plain = ((a[:, None] - b[None]) ** 2).sum(-1)
        assert (((x[:, None] - y[None]) ** 2).sum(-1) == plain * x.shape[-1]).all()
        entry, distance = vectorcodes.nearest(x, y)
        assert (entry == plain.argmin(1)).all() and (distance == plain.min(1)).all()


def test_sequency_order_counts_sign_changes():
    for size in (1, 2, 8, 16):
        rows = vectorcodes.transformed(np.eye(size, dtype=np.int64)).T
        assert [int((np.diff(np.sign(r)) != 0).sum()) for r in rows] == list(range(size))


def test_codes_stand_for_near_vectors(spark):
    rows = fixture(300)
    kept, dimension = vectorcodes.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    books = vectorcodes.fit(kept, dimension)
    codes = {r.id: r.code for r in vectorcodes.encoded(kept, books).collect()}
    off = [np.linalg.norm(vectorcodes.decoded(codes[i], books) - np.array(v)) / np.linalg.norm(v) for i, v, _ in rows]
    assert np.mean(off) < 0.35
