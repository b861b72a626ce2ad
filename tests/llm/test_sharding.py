import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pagemill.llm import sharding

from .helpers import clashing, docs


def least_by_hand(sizes, shards):
    """Smallest capacity, tried one by one over all sums of neighbours."""
    sums = np.concatenate(([0], np.cumsum(sizes)))
    for c in sorted({int(b - a) for i, a in enumerate(sums) for b in sums[i + 1 :]}):
        at, used = 0, 0
        while at < len(sizes):
            end = int(np.searchsorted(sums, sums[at] + c, "right")) - 1
            if end == at:
                break
            at, used = end, used + 1
        if at == len(sizes) and used <= shards:
            return c
    raise AssertionError


@pytest.mark.parametrize("blocks", [4, 16, 1 << 16])
@pytest.mark.parametrize("shards", [1, 3, 24])
def test_least_capacity_is_exact(spark, shards, blocks):
    rng = random.Random(shards)
    sizes = [rng.choice((1, 5, 40, 400)) * rng.randint(1, 30) for _ in range(120)]
    ends = spark.createDataFrame([(int(x),) for x in np.cumsum(sizes)], "end long")
    capacity, known = sharding.least_capacity(ends, sum(sizes), shards, blocks)
    assert capacity == least_by_hand(sizes, shards)
    cuts = [0, *sharding.even_cuts(known, capacity, shards), sum(sizes)]
    assert set(cuts[1:]) <= {int(x) for x in np.cumsum(sizes)} | {0}
    assert max(b - a for a, b in zip(cuts, cuts[1:], strict=False)) == capacity


def check(got, pairs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs
    )
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in got:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        of_text[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())


def test_shards_are_even_and_keep_groups(spark):
    rng = random.Random(4)
    pairs = [(i, "x" * rng.randint(0, 4000) + str(i)) for i in range(1500)] + [(None, None), (7, ""), (8, None), (9, "é" * 9000), (9, "é" * 9000)]
    got = sharding.shards_of(clashing(docs(spark, pairs)), 24, blocks=64).collect()
    check(got, pairs, 24)
    total = Counter()
    for r in got:
        total[r.shard] += r.size
    assert len(total) == 24 and max(total.values()) < 1.15 * min(total.values())


def test_a_large_group_of_copies_has_a_shard_and_the_others_share(spark):
    pairs = [(i, "copy " * 40) for i in range(400)] + [(1000 + i, f"text {i} " * 20) for i in range(600)]
    got = sharding.shards_of(docs(spark, pairs), 24).collect()
    check(got, pairs, 24)
    total = Counter()
    for r in got:
        total[r.shard] += r.size
    assert len(total) == 24 and max(total.values()) < 400 * 208 + 6000


def test_few_groups_and_empty_table(spark):
    pairs = [(1, "a"), (2, "b"), (3, "b")]
    check(sharding.shards_of(docs(spark, pairs), 24).collect(), pairs, 24)
    assert sharding.shards_of(docs(spark, []), 24).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    pairs = [(i, f"text {i % 50} " * (i % 7)) for i in range(300)]
    df = docs(spark, pairs)
    sharding.write_shards(df, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(300))
    where = {r.doc_id: r.shard for r in sharding.shards_of(df, 4).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == where


def test_a_column_named_like_the_folders_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="shard"):
        sharding.write_shards(clashing(docs(spark, ["a", "b"])), str(tmp_path / "s"), 2)
