import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagemill.llm import packing
from pagemill.llm.hilbert import hilbert_keys

from .helpers import clashing, docs

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(9)
    hard = ["it's we'll O'NEIL's", "á é x y", "İstanbul ΣΑΣ ǅ", "\x1c\x1d\x85 ​", "1234 5,6.7", "word.,; Word... don't. x- -x a'. b.' word<| end|> <|ENDOFTEXT|> THE!! the", "<|endoftext|> a<|startoftext|>b", "́x ́", "日本語 テキスト", "🙂🙂 x"]
    out = [None, "", " \n ", *hard, " ".join(hard)]
    out += [" ".join(rng.choices(["the", "Theatres", "naïve", "x1y2", "...", "don't"], k=rng.randint(1, 900))) for _ in range(40)]
    return out


def expected_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("known", [300_000, 0])
def test_words_give_the_ids_of_the_whole_text(known, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", known)
    words = packing.WordIds(PATH)
    for t in texts():
        assert [*words.ids((t or "").encode()).tolist(), 1] == expected_ids(t)


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_stepping_to_a_neighbour(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(got, pairs, length):
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.start, r.length, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    sizes = []
    for s in range(len(sequences)):
        at = 0
        for offset, n in sorted(sequences[s]):
            assert offset == at and n > 0
            at += n
        sizes.append(at)
    assert all(n <= length for n in sizes)
    padding = sum(0 if n & (n - 1) == 0 else length - n for n in sizes)
    assert padding == 0
    for i, t in pairs:
        at, ids = 0, []
        for start, n, part, total in sorted(by_doc[i]):
            assert start == at and len(part) == n and total == len(expected_ids(t))
            ids += part
            at += n
        assert ids == expected_ids(t)
    return sizes


@pytest.mark.parametrize("length", [2048, 64])
def test_round_trip(spark, length):
    pairs = list(enumerate(texts()))
    got = packing.pack(clashing(docs(spark, pairs)), PATH, length=length).collect()
    sizes = check(got, pairs, length)
    assert sizes[: sum(sizes) // length] == [length] * (sum(sizes) // length)


def test_similar_documents_are_neighbours(spark):
    rng = random.Random(1)
    topics = [["".join(rng.choices("abcdefghij", k=6)) for _ in range(60)] for _ in range(4)]
    pairs = [(i, " ".join(rng.choices(topics[i % 4], k=300))) for i in range(80)]
    got = packing.pack(docs(spark, pairs), PATH).filter("start = 0").orderBy("sequence_id", "offset").collect()
    order = [r.doc_id % 4 for r in got]
    assert sum(a == b for a, b in zip(order, order[1:], strict=False)) > 55


def test_repeated_rows_null_ids_and_empty_table(spark):
    pairs = [(None, "one two"), (None, "one two"), (3, "x"), (3, "x"), (4, "word " * 30_000)]
    got = packing.pack(docs(spark, pairs), PATH).collect()
    assert sum(r.length for r in got if r.doc_id is None) == 2 * len(expected_ids("one two"))
    assert sum(r.length for r in got) == sum(len(expected_ids(t)) for _, t in pairs)
    check([r for r in got if r.doc_id == 4] and got, [(4, pairs[4][1])], 2048)
    assert packing.pack(docs(spark, []), PATH).count() == 0


def test_full_memory_of_words_keeps_those_met_again(monkeypatch):
    """A worker serves many stages: what it remembers stays, so it must be little, and the words that come again."""
    monkeypatch.setattr(packing, "KNOWN_WORDS", 100)
    words, rare = packing.WordIds(PATH), [" ".join(f"q{turn}x{n}" for n in range(30)) for turn in range(5)]
    lines = ["the river (again) bank", "the river (again) bank", *rare, "the river (again) bank"]
    for n, text in enumerate(lines):
        assert words.ids(text.encode()).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(words.code) <= 100
        assert n < 1 or b"river" in words.code
    monkeypatch.setattr(packing, "KNOWN_WORDS", 6)
    assert words.ids(lines[0].encode()).tolist() == words.tokenizer.encode(lines[0], add_special_tokens=False).ids
    assert packing.KNOWN_WORDS == 6 and 0 < len(words.code) <= 10
