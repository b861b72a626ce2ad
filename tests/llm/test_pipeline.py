"""The pipeline and its stages against plain Python on a small folder of tables."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from pagemill.llm import packing, queries

from .helpers import UPPER_TO_LOWER, unions
from .test_decontaminate import shingles
from .test_packing import PATH, expected_ids
from .test_simhash import print_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 9))) for _ in range(800)]
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(5)]
    texts, labels = [], []
    for i in range(240):
        words = rng.choices(vocabulary, k=rng.randint(60, 300))
        if i % 12 == 5:
            at = rng.randrange(len(words))
            words[at:at] = items[i % 5][1].split()
        bad = i % 6 == 0
        texts.append(" ".join(w.upper() + "!!" for w in words) if bad else " ".join(words))
        if i % 3 < 2:
            labels.append((i, 0 if bad else 1, 0))
    for i in range(60):
        base = texts[1 + i % 40].split()
        if i % 2:
            base[rng.randrange(len(base))] = "changed"
        texts.append(" ".join(base))
    texts += [None, "", "short one", "Short one"]
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "src0", len(t or ""), "x") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_against_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == "packing":
            got = out.collect()
            break
        assert out.columns == columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_classifier":
            scores = {r.doc_id: r.predicted for r in queries.op4_quality_classifier(spark, folder).collect()}
            want = {i: t for i, t in left.items() if scores[i]}
            assert sum(i in want for i in range(240) if i % 6) > 0.97 * 200 and sum(i in want for i in range(0, 240, 6)) < 4
        elif name == "exact_dedup":
            last = {(t or "").translate(UPPER_TO_LOWER): i for i, t in sorted(left.items())}
            want = {i: left[i] for i in last.values()}
        elif name == "simhash_near_dedup":
            prints = {i: print_of(t) for i, t in left.items()}
            near = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4]
            want = {i: left[i] for i in set(unions(near, prints).values())}
        else:
            bad = lambda t: any(5 * len(shingles(x) & shingles(t)) >= 4 * len(shingles(x)) for x in items)
            want = {i: t for i, t in left.items() if not bad(t)}
        assert after == want and len(after) < len(left)
        left, docs = after, out
    by_doc = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        by_doc.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert by_doc == {i: expected_ids(t) for i, t in left.items()}
    assert max(r.offset + r.length for r in got) <= packing.LENGTH
    ran = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, ran)) == sorted(map(tuple, got))


def test_tokenizer_is_installed_not_copied():
    assert not re.search(r"/repo/", PATH)


def test_pipeline_of_an_empty_table(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
