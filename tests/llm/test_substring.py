import random

import pytest

from pagemill.llm import substring

from .helpers import clashing, docs


def words_of(rng, n, vocabulary):
    return rng.choices(vocabulary, k=n)


VOCABULARY = ["".join(random.Random(i).choices("abcdefghij", k=2 + i % 8)) for i in range(600)] + ["the", "of", "É", "naïve"] * 40


def test_chunks_partition_the_words():
    rng = random.Random(1)
    for n in (0, 1, 2, 5, 9, 300):
        text = "  \n".join(words_of(rng, n, VOCABULARY)) + " "
        digests, words, begin, finish = substring.chunks(text.encode())
        assert sum(words) == n and len(digests) == len(words)
        parts = [text.encode()[a:b].split() for a, b in zip(begin, finish, strict=True)]
        assert [w for p in parts for w in p] == text.encode().split()
        assert [len(p) for p in parts] == list(words)


def test_an_insertion_moves_only_chunks_nearby():
    rng = random.Random(2)
    words = words_of(rng, 4000, VOCABULARY)
    before = substring.chunks(" ".join(words).encode())[0]
    after = substring.chunks(" ".join([*words[:2000], "inserted", "here", *words[2000:]]).encode())[0]
    assert len(set(before) - set(after)) <= 4
    assert 5 <= 4000 / len(before) <= 10


def test_passages_of_over_fifty_words_are_found(spark):
    rng = random.Random(3)
    pairs, planted = [], set()
    for i in range(600):
        pairs.append((i, words_of(rng, rng.randint(60, 300), VOCABULARY)))
    for k in range(150):
        passage = words_of(rng, 51 + k % 20, VOCABULARY)
        for i in (2 * k, 2 * k + 1):
            at = rng.randint(0, len(pairs[i][1]))
            pairs[i][1][at:at] = [w.upper() if w.isascii() else w for w in passage] if i % 2 else passage
            planted.add(i)
    got = substring.repeats(clashing(docs(spark, [(i, " ".join(w)) for i, w in pairs]))).collect()
    found = {r.doc_id for r in got}
    assert len(planted - found) <= 1
    assert not found - planted
    assert all(r.removed_words == 0 for r in got if r.doc_id % 2 == 0)
    assert sum(r.words for r in got) > 0.6 * sum(2 * (51 + k % 20) for k in range(150))
    assert all(0 < r.removed_words == r.words for r in got if r.doc_id % 2)


def brute(pairs, min_words):
    """Repeats by dictionaries over the same chunks."""
    where = {}
    per = []
    for k, (i, t) in enumerate(pairs):
        c = substring.chunks((t or "").encode())
        per.append(c)
        for j, d in enumerate(c[0]):
            where.setdefault(d, []).append(((i is not None, i or 0), k, j))
    out = []
    for k, (i, _) in enumerate(pairs):
        digests, words, begin, finish = per[k]
        run = []
        for j in range(len(digests) + 1):
            if j < len(digests) and len(where[digests[j]]) > 1:
                run.append(j)
                continue
            if run and sum(words[x] for x in run) >= min_words:
                gone = sum(int(words[x]) for x in run if min(where[digests[x]])[1:] != (k, x))
                out.append((i, int(begin[run[0]]), int(finish[run[-1]] - begin[run[0]]), int(sum(words[x] for x in run)), gone))
            run = []
    return sorted(out, key=str)


@pytest.mark.parametrize("min_words", [5, substring.MIN_WORDS])
def test_equals_brute_force(spark, min_words):
    rng = random.Random(5)
    blocks = [" ".join(words_of(rng, rng.randint(10, 80), VOCABULARY)) for _ in range(25)]
    pairs = [(i, "\n".join(rng.choices(blocks, k=rng.randint(0, 4)) + [f"own{i}"])) for i in range(80)]
    pairs += [(200, None), (201, ""), (202, "same " * 500), (203, "same " * 500), (204, " ".join(blocks) * 8)]
    got = substring.repeats(docs(spark, pairs, parts=1), min_words=min_words).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(pairs, min_words)


def test_dedup_cuts_repeats_out(spark):
    rng = random.Random(6)
    passage = " ".join(words_of(rng, 80, VOCABULARY))
    texts = [f"é{i} start {i} . {passage} . end ü{i}" for i in range(6)]
    df = clashing(docs(spark, [*enumerate(texts), (7, None), (None, "é0 alone")]))
    got = {r.doc_id: r.text for r in substring.dedup(df).collect()}
    assert got[0] == texts[0] and got[7] is None and got[None] == "é0 alone"
    for i in range(1, 6):
        assert got[i].startswith(f"é{i} start {i}") and got[i].endswith(f"end ü{i}") and len(got[i]) < 0.4 * len(texts[i])
    assert substring.dedup(df).columns == df.columns


def test_repeated_rows_leave_one_and_empty_table(spark):
    text = " ".join(words_of(random.Random(8), 300, VOCABULARY))
    got = [r.text for r in substring.dedup(docs(spark, [(1, text)] * 4)).collect()]
    assert sorted(map(len, got)) == [0, 0, 0, len(text)]
    assert substring.repeats(docs(spark, [])).count() == 0
    assert substring.dedup(docs(spark, [])).count() == 0
