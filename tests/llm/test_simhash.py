import random
import re

import numpy as np
import xxhash

from pagemill.llm import simhash

from .helpers import UPPER_TO_LOWER, clashing, docs, unions


def print_of(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER_TO_LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts():
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(300)] + ["É", "naïve", "Ωμέγα", " x"]
    out = [None, "", " \t\n", "one", "One", "two words", "a b c", "a b c d"]
    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.randint(1, 400))
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append("\n ".join(words).upper() if rng.random() < 0.2 else "  ".join(words))
    return out


def expected(pairs):
    prints = {i: print_of(t) for i, t in pairs}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4]
    return prints, unions(near, ids)


def test_equals_brute_force(spark):
    pairs = list(enumerate(texts(), start=10))
    prints, parts = expected(pairs)
    for block in (simhash.BLOCK, 2):
        got = simhash.near_duplicates(clashing(docs(spark, pairs)), block=block).collect()
        assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", parts[i]) for i, _ in pairs}
        assert len(set(parts.values())) < len(parts)


def test_keys_meet_within_four_bits():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 400, np.uint64)
    other = base.copy()
    for k in range(len(base)):
        for bit in rng.choice(64, k % 5, replace=False):
            other[k] ^= np.uint64(1) << np.uint64(bit)
    listed = [set(zip(*map(np.ndarray.tolist, simhash.keys_of(x)), strict=True)) for x in (base, other)]
    shared = {p for p, _ in listed[0] & listed[1]}
    assert shared == set(range(400))
    _, counts = np.unique(simhash.keys_of(base)[0], return_counts=True)
    assert counts.max() <= 33


def test_golay_code_is_perfect():
    index = simhash.decode(np.arange(1 << 23))
    assert np.array_equal(np.bincount(index, minlength=4096), np.full(4096, 2048))


def test_links_of_a_crowd_are_a_forest(spark):
    rng = random.Random(2)
    crowd = {0x0123456789ABCDEF ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(700)}
    prints = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in crowd], "fp long")
    for block in (simhash.BLOCK, 100):
        found = simhash.links(prints, block=block).collect()
        parts = unions([(r.a, r.b) for r in found], {int(np.uint64(x).astype(np.int64)) for x in crowd})
        assert len(set(parts.values())) == 1
        assert len(found) < 40 * len(crowd)


def test_dedup_leaves_one_of_each_group(spark):
    pairs = [(i, t) for i, t in enumerate(texts())] + [(3, "one"), (None, "one")]
    _, parts = expected([p for p in pairs if p[0] is not None])
    df = clashing(docs(spark, pairs))
    got = simhash.dedup(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(parts.values()))


def test_long_text_and_empty_table(spark):
    long_text = "word other third fourth " * 60_000
    assert simhash.fingerprint(long_text.encode()) == print_of(long_text)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.dedup(docs(spark, [])).count() == 0
