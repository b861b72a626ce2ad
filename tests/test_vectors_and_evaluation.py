import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.operators import evaluate, modelhook, vectors


def source(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, page_content_masked string")


def test_hashed_vectors_are_unit_and_equal_for_equal_text(spark):
    frame = spark.createDataFrame([("a b b",), ("B a b!",), ("",), (None,), ("other words",)], "t string")
    for hasher in ("xxhash64", "md5"):
        got = [r[0] for r in frame.select(vectors.embed_hashed(F.col("t"), 16, hasher)).collect()]
        assert got[0] == got[1] and all(len(v) == 16 for v in got)
        assert np.linalg.norm(got[0]) == pytest.approx(1, abs=1e-6)
        assert got[2] == got[3] == [0.0] * 16


def test_index_follows_its_source(spark, tmp_path):
    path = str(tmp_path / "index")
    embedded = []
    first = source(spark, [("a", "one"), ("b", "two"), ("c", "three")])
    assert vectors.read_index(spark, path) is None
    assert vectors.sync_index(first, path) == 0
    second = source(spark, [("a", "one"), ("b", "changed"), ("d", "four")])
    diff = {tuple(r) for r in vectors.index_diff(second, vectors.read_index(spark, path)).collect()}
    assert diff == {("b", "update"), ("c", "delete"), ("d", "insert")}
    assert vectors.sync_index(second, path) == 1
    index = vectors.read_index(spark, path)
    assert vectors.index_diff(second, index).isEmpty()
    whole = {r.chunk_id: tuple(r.embedding) for r in vectors.index_rows(second).collect()}
    assert {r.chunk_id: tuple(r.embedding) for r in index.collect()} == whole
    # nothing changed: nothing is written
    assert vectors.sync_index(second, path) == 1
    # a version that was not finished does not count
    (tmp_path / "index" / "version=7").mkdir()
    assert vectors.read_index(spark, path).count() == 3
    with pytest.raises(ValueError):
        vectors.sync_index(second.filter("false"), path)


def test_only_changed_texts_are_embedded(spark):
    old = vectors.index_rows(source(spark, [("a", "one"), ("b", "two")]))
    marked = lambda text: F.array(F.lit(-1.0).cast("float"))
    new = source(spark, [("a", "one"), ("b", "new")])
    now = vectors.synced(new, old, vectors.index_diff(new, old), marked).collect()
    assert {r.chunk_id: len(r.embedding) for r in now} == {"a": 256, "b": 1}


@pytest.mark.parametrize("limit", [10**9, 2000, 0])
def test_search_equals_brute_force(spark, limit):
    rng = np.random.default_rng(3)
    v = rng.integers(-3, 4, (60, 5)).astype(float)  # many equal scores
    q = rng.integers(-3, 4, (17, 5)).astype(float)
    vf = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id int, embedding array<double>").repartition(5)
    qf = spark.createDataFrame([(f"q{i}", x.tolist()) for i, x in enumerate(q)], "query_id string, embedding array<double>")
    got = {}
    for r in vectors.knn(vf, qf, 4, broadcast_bytes=max(limit, 500)).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.id, r.score)
    for i, x in enumerate(q):
        order = sorted(range(len(v)), key=lambda j: (-(v[j] @ x), j))[:4]
        assert [got[f"q{i}"][n + 1] for n in range(4)] == [(j, v[j] @ x) for j in order]


def test_search_with_few_or_no_rows(spark):
    vf = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id int, embedding array<double>")
    qf = spark.createDataFrame([(1, [1.0, 1.0])], "query_id int, embedding array<double>")
    assert vectors.knn(vf, qf, 3).count() == 1
    assert vectors.knn(vf, qf, 3, broadcast_bytes=0).count() == 1
    assert vectors.knn(vf.filter("false"), qf, 3).count() == 0
    assert vectors.knn(vf, qf.filter("false"), 3).count() == 0
    assert vectors.knn(vf.filter("false"), qf, 3, broadcast_bytes=0).count() == 0


def test_vectors_of_two_lengths_are_an_error(spark):
    vf = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0])], "vec_id int, embedding array<double>").coalesce(1)
    qf = spark.createDataFrame([(1, [1.0, 1.0, 1.0])], "query_id int, embedding array<double>")
    with pytest.raises(Exception, match="cannot be compared"):
        vectors.knn(vf, qf, 1).collect()
    with pytest.raises(Exception, match="cannot be compared"):
        vectors.knn(vf.filter("vec_id = 1"), qf, 1).collect()


def test_pages_without_text_stay_single(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = source(spark, [("a", "one"), ("b", None), ("c", "x")])
    assert [vectors.sync_index(rows, path) for _ in range(3)] == [0, 0, 0]
    changed = source(spark, [("a", None), ("b", None), ("d", None)])
    assert [vectors.sync_index(changed, path) for _ in range(3)] == [1, 1, 1]
    assert sorted((r.chunk_id, r.content_hash) for r in vectors.read_index(spark, path).collect()) == [("a", None), ("b", None), ("d", None)]
    with pytest.raises(ValueError, match="unique"):
        vectors.sync_index(source(spark, [("a", "1"), ("a", "2")]), path)


def test_word_limit(spark):
    texts = ["", None, " ".join(["w"] * 80), " ".join(["w"] * 81), "\n" + "\t".join(["w"] * 80) + " \n", "\nw" * 81]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(evaluate.concise(F.col("t"))).collect()] == ["yes", "yes", "yes", "no", "yes", "no"]


def test_answer_text(spark):
    frame = spark.createDataFrame([(("r", "o"),), (("", "o"),), ((None, None),)], "outputs struct<response: string, output: string>")
    kind = dict(frame.dtypes)["outputs"]
    assert [r[0] for r in frame.select(evaluate.answer_text(F.col("outputs"), kind)).collect()] == ["r", "o", ""]
    frame = spark.createDataFrame([({"output": "o"},), ({"response": "r", "output": "o"},), ({},)], "outputs map<string, string>")
    kind = dict(frame.dtypes)["outputs"]
    assert [r[0] for r in frame.select(evaluate.answer_text(F.col("outputs"), kind)).collect()] == ["o", "r", ""]
    frame = spark.createDataFrame([('{"response": "r"}',), ("plain",), (None,), ('{"output": "o", "response": ""}',)], "outputs string")
    assert [r[0] for r in frame.select(evaluate.json_answer_text(F.col("outputs"))).collect()] == ["r", "plain", "", "o"]


def test_scorers(spark):
    rows = [
        ("what is the rate", "the rate is 5 percent", "5 percent", "rate: 5 percent in the year"),
        ("what is the rate", "I’m sorry, I can’t help with that", "5 percent", ""),
        ("was ist das", "das ist nicht die Antwort und der Preis", "unknown", None),
    ]
    frame = spark.createDataFrame(rows, "question string, answer string, expected string, context string")
    table = evaluate.scored(frame.withColumn("id", F.col("question")), ["id"]).drop("id").collect()
    assert [tuple(r) for r in table] == [
        ("yes", "yes", "yes", "yes", "yes", "yes", "yes"),
        ("no", "no", "no", "no", "yes", "no", "yes"),
        ("no", "no", "no", "yes", "no", "yes", "yes"),
    ]
    scored = evaluate.scored(frame, ["question"])
    long = evaluate.long_form(scored, ["question"])
    assert long.count() == 21
    shares = {r.scorer: (r.n_answers, r.n_yes) for r in evaluate.metrics(scored, ["question"]).collect()}
    assert shares["concise_response"] == (3, 3) and shares["correctness_proxy"] == (3, 1)
    assert evaluate.metrics(scored.filter("false"), ["question"]).first().share_yes is None


def test_same_document(spark):
    frame = spark.createDataFrame([("a_hr.pdf", "x/a_hr.enc"), ("a.b.pdf", "a.b.enc"), ("a.pdf", "b.enc")], "l string, r string")
    assert [r[0] for r in frame.select(evaluate.same_document(F.col("l"), F.col("r"))).collect()] == [True, True, False]


def test_failed_model_batches_become_error_rows(spark):
    def call(batch):
        if (batch == "bad").any():
            raise RuntimeError("no answer")
        return batch.str.upper().tolist()

    frame = spark.createDataFrame([(i, "bad" if i == 3 else f"t{i}") for i in range(8)], "id int, t string").coalesce(1)
    rows = {r.id: (r.answer, r.error) for r in modelhook.map_batches(frame, call, "t", "answer", batch_rows=2).collect()}
    assert rows[0] == ("T0", None) and rows[7] == ("T7", None)
    assert rows[2] == rows[3] == (None, "RuntimeError: no answer")
    short = modelhook.map_batches(frame, lambda b: ["x"], "t", "answer", batch_rows=2)
    assert short.filter("error LIKE '%1 answers for 2 rows%'").count() == 8


def test_model_rows_keep_their_other_columns(spark):
    frame = spark.createDataFrame([(9007199254740993, "a", None), (None, None, [1]), (5, "b", [None, 2])], "id long, t string, x array<int>").coalesce(1)
    got = modelhook.map_batches(frame, lambda b: [len(t) for t in b], "t", "n", "bigint").collect()
    assert [tuple(r) for r in got] == [(9007199254740993, "a", None, 1, None), (None, None, [1], None, None), (5, "b", [None, 2], 1, None)]


def test_model_steps(spark):
    answers = lambda batch: ['[{"original": "Ann", "masked": "?"}]' if "Ann" in p else "no" for p in batch]
    pages = spark.createDataFrame([(0, "Hi Ann"), (1, "  "), (2, "x"), (3, None)], "doc_id int, page_content string").coalesce(1)
    found = {r.doc_id: [tuple(e) for e in r.entities] for r in modelhook.entities(pages, answers).collect()}
    assert found == {0: [("Ann", "***", "UNKNOWN")], 1: [], 2: [], 3: []}
    masked = modelhook.masked(pages, lambda batch: [p.split("Text:\n")[1].replace("Ann", "[[NAME]]") for p in batch])
    assert {r.doc_id: r.page_content_masked for r in masked.collect()} == {0: "Hi [[NAME]]", 1: None, 2: "x", 3: None}
    vector = modelhook.embedded(pages, lambda batch: [[float(len(t)), 1.0] for t in batch], "page_content")
    assert [r.embedding for r in vector.orderBy("doc_id").collect()] == [[6.0, 1.0], [2.0, 1.0], [1.0, 1.0], None]
    rows = spark.createDataFrame([("q", "a", "e", None), ("q", "b", "e", "c")], "question string, answer string, expected string, context string")
    verdicts = modelhook.judged(rows.coalesce(1), "correctness", lambda batch: ["Yes " if '"a"' in c else "maybe" for c in batch])
    assert {r.answer: r.correctness for r in verdicts.collect()} == {"a": "yes", "b": None}


def test_a_question_asked_often_does_not_multiply(spark):
    qa = spark.createDataFrame([("f", "q", "x")] * 5, "filename string, question string, answer string")
    answers = spark.createDataFrame([("q", "o")] * 7, "question string, outputs string")
    assert evaluate.with_answers(qa, answers).count() == 5


def test_every_answer_and_every_context_is_scored(spark):
    qa = spark.createDataFrame([("f", "q", "x")], "filename string, question string, answer string")
    answers = spark.createDataFrame([("q", "o"), ("q", "o"), ("q", "p")], "question string, outputs string")
    context = spark.createDataFrame([("q", "second", 2), ("q", "first", 1), ("q", "third", 3)], "question string, context string, rank int")
    got = evaluate.with_answers(qa, answers, context).collect()
    assert sorted((r.outputs, r.context) for r in got) == [("o", "first\nsecond\nthird"), ("p", "first\nsecond\nthird")]
    assert len({r.answer_id for r in got}) == 2


def test_model_labels_outside_the_list_count_as_none(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "file_name string").coalesce(1)
    rows = modelhook.classified(frame, lambda b: [" HR ", "other"], ["hr", "finance"]).collect()
    assert [r.document_type for r in rows] == ["hr", None]
