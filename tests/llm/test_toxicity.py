import random
import zlib

import pytest
from pyspark.sql import functions as F

from pagemill.llm import toxicity
from pagemill.llm.queries import HELD_OUT, op12_toxicity, toxicity_model

from .helpers import clashing, docs

SF = "/root/testdata/sf0.1"


def reader(weights=()):
    weights = dict(weights) or {"idiot$": 1.0, "moron$": 1.0, "gralb": 2.0}
    return toxicity.Reader(toxicity.Lexicon(weights, tuple(weights)))


def sums(text, r=None):
    return dict(zip(toxicity.CONTEXTS, (r or reader()).sums(text), strict=True))


def only(context, amount=1.0):
    return {c: amount if c == context else 0.0 for c in toxicity.CONTEXTS}


@pytest.mark.parametrize(
    "text, context",
    [
        ("What an IDIOT.", "plain"),
        ("You complete idiot!", "targeted"),
        ("idiot, that is what you are", "targeted"),
        ("It was not an idiot. Fine.", "negated"),
        ("It was not. What an idiot", "plain"),  # a stop ends what a negation reaches
        ("not in the least way an idiot", "plain"),  # so do three words
        ("The paper called it idiot", "reported"),
        ('The word "idiot" is old', "reported"),
        ("I will kill you", "threat"),
        ("We never kill you", "negated threat"),
        ("It said we will kill them", "reported threat"),
    ],
)
def test_contexts(text, context):
    assert sums(text) == only(context)


def test_words_alone_threats_without_target_and_other_words_do_not_count():
    for text in (None, "", "idiotic", "anidiot", "The frost may kill plants", "you there", "gral"):
        assert sums(text) == only(None), text


def test_beginnings_weigh_for_words_not_seen():
    got = reader({"gralb": 2.0, "gralb$": 0.0, "gralbes": 0.5, "gralbesco$": 3.0})
    for word, weight in (("gralbix", 2.0), ("gralb", 0.0), ("gralbest", 0.5), ("gralbesco", 3.0), ("gra", 0.0)):
        assert got.lexicon.weight(word) == weight
    assert sums("gralbix gralb gralbest", got) == only("plain", 2.5)


def test_product_machine_runs_like_its_parts():
    parts = [toxicity.negation(), toxicity.report(), toxicity.target()]
    rng = random.Random(2)
    for _ in range(300):
        symbols = rng.choices(range(7), k=rng.randint(0, 12))
        states, state = [m.start for m in parts], toxicity.GRAMMAR.start
        for symbol in symbols:
            steps = [m.step[s, symbol] for m, s in zip(parts, states, strict=True)]
            states, marks = [s for s, _ in steps], sum(m for _, m in steps)
            state, both = toxicity.GRAMMAR.step[state, symbol]
            assert both == marks
        assert toxicity.GRAMMAR.final[state] == sum(m.final.get(s, 0) for m, s in zip(parts, states, strict=True))


def test_clauses_of_long_texts_without_stops_are_linear():
    import time

    text = "idiot word " * 100_000
    at = time.time()
    got = reader().sums(text)
    assert sum(got) == 100_000 and time.time() - at < 10


def labelled(n=600, seed=4):
    """Texts of one vocabulary; every fifth holds words of a made-up insulting stem, or a known one."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 9))) for _ in range(400)]
    pairs, labels = [], []
    for i in range(n):
        words, bad = rng.choices(vocabulary, k=rng.randint(30, 200)), i % 5 == 0
        for _ in range(max(2, len(words) // 50) if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["trash", "zworg" + rng.choice(vocabulary)])
        pairs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(bad)))
    return pairs, labels


def test_learns_stems_and_scores_rows_not_learnt_from(spark):
    pairs, labels = labelled()
    df = clashing(docs(spark, [*pairs, (None, None), (9000, ""), (9001, "x" * 500_000), (9002, pairs[5][1]), (9002, pairs[5][1])]))
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (8, 7)], "doc_id long, toxic int")
    model = toxicity.train(df, known, learn_from=F.expr("_id < 400"))
    assert any("zworg".startswith(r) or r.startswith("zwor") for r in model.lexicon.roots) and "trash$" in model.lexicon.roots
    got = {r.doc_id: r for r in toxicity.scores(df, model).collect()}
    assert len(got) == len(pairs) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert not [i for i, label in labels if got[i].predicted != label]
    assert got[9000].predicted == got[9001].predicted == got[None].predicted == 0 and got[9002].predicted == got[5].predicted
    assert model == toxicity.train(df.repartition(7), known, learn_from=F.expr("_id < 400"))


def test_without_both_classes_and_without_rows(spark):
    pairs, _ = labelled(20)
    for labels in ([], [(1, 1)], [(1, 1), (1, 0)]):
        model = toxicity.train(docs(spark, pairs), spark.createDataFrame(labels, "doc_id long, toxic int"))
        rows = toxicity.scores(docs(spark, ["You utter moron, you idiot", "Good day"]), model).orderBy("doc_id").collect()
        assert rows[0].score > 0.5 > 0.3 > rows[1].score
    assert toxicity.scores(docs(spark, []), model).count() == 0


def test_negation_counts_as_the_labels_say(spark):
    """Clean texts that negate or quote insults teach that such clauses count less."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 9))) for _ in range(400)]
    pairs, labels = [], []
    for i in range(800):
        words = rng.choices(vocabulary, k=60)
        if i % 4 == 0:
            words[10:12] = ["trash", "trash"]
        if i % 4 == 1:
            words[10:13] = ["not", "a", "trash"]
        pairs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    model = toxicity.train(docs(spark, pairs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.factors[toxicity.CONTEXTS.index("negated")] < 0.15 < 0.6 < model.factors[0]
    got = {r.doc_id: r.predicted for r in toxicity.scores(docs(spark, pairs), model).collect()}
    assert sum(got[i] != label for i, label in labels) <= 8


def test_query_on_held_out_rows(spark):
    got = op12_toxicity(spark, SF).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    caught = sum(p for p, t in held if t) / sum(t for _, t in held)
    left = sum(1 - p for p, t in held if not t) / sum(1 - t for _, t in held)
    # the rest of the toxic rows are repeated or shuffled junk without any sign of it
    assert caught > 0.93 and left > 0.97


def test_scores_recomputed_by_their_formula(spark):
    import math

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = toxicity_model(spark, df, "/root/testdata/sf0.001")
    r = toxicity.Reader(model.lexicon)
    text = {row.doc_id: row.text or "" for row in df.collect()}
    for row in toxicity.scores(df, model).collect():
        total = sum(a * b for a, b in zip(r.sums(text[row.doc_id]), model.factors, strict=True))
        z = model.fit[0] + model.fit[1] * math.log1p(total) + model.fit[2] * math.log((total + 0.1) / (len(text[row.doc_id]) / 400 + 1))
        assert abs(row.score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9
    assert HELD_OUT
