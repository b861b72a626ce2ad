import random
import zlib

from pyspark.sql import functions as F

from pagemill.llm import quality
from pagemill.llm.queries import op4_quality_classifier

from .helpers import clashing, docs

SF = "/root/testdata/sf0.01"


def fixture(spark, n=400):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 9))) for _ in range(500)]
    pairs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(30, 300))
        bad = i % 4 == 0
        pairs.append((i, " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + "."))
        labels.append((i, 0 if bad else 1))
    return pairs, labels


def test_learns_to_tell_apart(spark):
    pairs, labels = fixture(spark)
    df = clashing(docs(spark, [*pairs, (None, None), (1000, ""), (1001, "x" * 500_000)]))
    model = quality.train(df, spark.createDataFrame([*labels, (None, 0), (5, None), (9, 7)], "doc_id long, quality int"), learn_from=F.expr("_id % 4 <> 2 AND _id < 300"))
    got = {r.doc_id: r for r in quality.scores(df, model).collect()}
    assert len(got) == len(pairs) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    wrong = [i for i, label in labels if got[i].predicted != label]
    assert len(wrong) <= 0.02 * len(labels)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i or -1 for i, r in got.items() if r.predicted)


def test_same_model_again_and_scores_by_hand(spark):
    pairs, labels = fixture(spark)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    a, b = (quality.train(docs(spark, pairs, parts=p), table) for p in (2, 5))
    assert a == b
    by_hand = dict(zip([i for i, _ in pairs], quality.score_texts(a, [t for _, t in pairs]), strict=True))
    assert {r.doc_id: r.score for r in quality.scores(docs(spark, pairs), a).collect()} == by_hand


def test_numbers_do_not_depend_on_length_or_place(spark):
    pairs, labels = fixture(spark)
    model = quality.train(docs(spark, pairs), spark.createDataFrame(labels, "doc_id long, quality int"), learn_from=F.expr("_id < 300"))
    held = {label: [t for (i, t), (_, x) in zip(pairs, labels, strict=True) if i >= 300 and x == label] for label in (0, 1)}
    packer = quality.Packer(model.good, model.bad)
    long = {label: " ".join(random.Random(label).choices(texts, k=20_000))[:2_000_000] for label, texts in held.items()}
    for text in long.values():
        first, *others = (packer.numbers(text[:size])[0] for size in (8_000, 100_000, 500_000, 2_000_000))
        assert all(abs(x - first) < 0.3 * abs(first) for x in others)
    # what stands deep in a text counts like its start
    good, bad = long[1][:900_000], long[0][:100_000]
    ahead, behind = packer.numbers(bad + good)[0], packer.numbers(good + bad)[0]
    assert abs(ahead - behind) < 0.1 * abs(ahead)


def test_given_texts_joined_to_half_a_megabyte_keep_their_predictions(spark):
    from pagemill.llm.queries import HELD_OUT, quality_model

    whole = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{whole}/documents.parquet")
    model = quality_model(spark, df, whole)
    held = df.join(spark.read.parquet(f"{whole}/labels.parquet"), "doc_id").filter(F.expr(HELD_OUT.format("doc_id"))).orderBy("doc_id").collect()
    for label in (0, 1):
        texts, long = [r.text for r in held if r.quality == label and r.text], []
        random.Random(label).shuffle(texts)
        while len(long) < 4:
            made = ""
            while len(made) < 500_000:
                texts.append(texts.pop(0))
                made += "\n" + texts[-1]
            long.append(made)
        got = quality.score_texts(model, [*long, "\n".join(long)])
        assert [int(s >= quality.GOOD_FROM) for s in got] == [label] * 5


def test_without_both_classes(spark):
    pairs, _ = fixture(spark, 20)
    for labels, prior in (([], 0.5), ([(1, 1), (2, 1)], 0.75), ([(1, 1), (1, 0)], 0.5)):
        model = quality.train(docs(spark, pairs), spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {r.score for r in quality.scores(docs(spark, pairs), model).collect()} == {prior}
        assert quality.keep_good(docs(spark, pairs), model).count() == 20
    assert quality.scores(docs(spark, []), model).count() == 0


def test_query_is_right_on_held_out_rows(spark):
    got = op4_quality_classifier(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in held) / len(held) > 0.93


def test_scores_recomputed_from_compressed_sizes(spark):
    """The formula spelled once more with the compressor itself: blocks of 8 KB with either dictionary and with none."""
    import math

    import zstandard

    pairs, labels = fixture(spark)
    model = quality.train(docs(spark, pairs), spark.createDataFrame(labels, "doc_id long, quality int"))
    packers = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d)) for d in (model.good, model.bad)] + [zstandard.ZstdCompressor(level=3)]
    extra = [(9000, ""), (9001, " ".join(t for _, t in pairs[:200])), (9002, None)]
    text = {i: (t or "").encode() for i, t in [*pairs, *extra]}
    for r in quality.scores(docs(spark, [*pairs, *extra]), model).collect():
        data = text[r.doc_id]
        blocks = [data[at : at + 8192] for at in range(0, max(1, len(data)), 8192)]
        good, bad, plain = (sum(len(p.compress(b)) for b in blocks) for p in packers)
        numbers = (bad - good) / (len(data) + 1), math.log((plain + 1) / (len(data) + 20))
        z = model.weights[-1] + sum((x - c) / s * w for x, c, s, w in zip(numbers, model.centre, model.scale, model.weights[:-1], strict=True))
        assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-6
