"""The shape of the plans: what is shuffled, what is computed once, what is read."""

import re

import pytest
from pyspark.sql import functions as F

from pagemill.functions import crypto, parse
from pagemill.operators import bronze, detect, evaluate, gold, redact, silver, vectors


@pytest.fixture()
def stored(spark, key, tmp_path):
    """A stored table of encrypted files, so that plans start at a scan."""
    path = str(tmp_path / "files")
    rows = spark.createDataFrame([(f"/in/{i}_hr.enc", f"one {i}\nmail a{i}@b.org") for i in range(20)], "path string, t string")
    content = crypto.encrypt_bytes(F.col("t").cast("binary"), key)
    rows.select("path", F.lit(1).cast("bigint").alias("length"), content.alias("content")).write.parquet(path)
    return spark.read.parquet(path)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan(frame)))


def parser(content):
    return parse.plain_text(content.cast("string"), 5)


def test_files_to_gold_without_a_shuffle(stored, key):
    pages = silver.pages_of(bronze.parsed(stored, key, parser))
    published = gold.masked_pages(pages)
    assert exchanges(published) == 0 and published.count() == 20
    assert plan(published).count("aesDecrypt(") == 1
    assert exchanges(redact.leaks(redact.redact(detect.with_entities(pages)), ["file_path", "page_id"])) == 0


def test_nothing_is_computed_twice_for_a_filter(stored, key):
    opened = bronze.opened(stored, key, "quarantine")
    assert plan(opened).count("aesDecrypt(") == 1
    pages = silver.pages_of(bronze.parsed(stored, key, parser))
    for frame in (
        detect.entity_rows(detect.with_entities(pages), ["file_path"]),
        detect.entity_counts(detect.with_entities(pages), ["file_path"]),
        redact.redaction_rows(redact.with_redactions(detect.with_entities(pages.withColumn("words", F.split("page_content", " ")))), ["file_path"]),
    ):
        assert plan(frame).count("aesDecrypt(") == 1
        assert not re.search(r"Filter .*size\(", plan(frame))


def test_page_aggregation_is_one_shuffle(stored, key):
    elements = bronze.explode_elements(bronze.parsed(stored, key, parser))
    grouped = silver.pages(elements)
    assert exchanges(grouped) == 1 and "partial_collect_list" in plan(grouped)


def test_scans_read_what_is_needed(spark, tmp_path):
    path = str(tmp_path / "gold")
    rows = spark.createDataFrame(
        [("c", "f", "/f", "hr", 0, "text", 1, "text", None)],
        "chunk_id string, file_name string, file_path string, document_type string, page_id int, "
        "page_content_masked string, element_count bigint, element_types string, image_uri string",
    )
    gold.publish(rows, path)
    summary = plan(gold.summary(gold.published(spark, path)))
    assert "page_content_masked" not in summary and "ReadSchema: struct<file_name:string>" in summary


def test_no_sort_before_a_partitioned_write(spark):
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "16"


def test_texts_stay_where_they_are_in_a_sync(spark, tmp_path):
    source = spark.createDataFrame([(str(i), f"t {i}") for i in range(50)], "chunk_id string, page_content_masked string")
    source.write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    vectors.sync_index(source, str(tmp_path / "i"))
    index = vectors.read_index(spark, str(tmp_path / "i"))
    diff = plan(vectors.index_diff(source, index))
    for shuffled in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", diff):
        assert shuffled.startswith("chunk_id")
    assert "embedding" not in diff
    spark.createDataFrame([("1", "update")], vectors.CHANGES).write.parquet(str(tmp_path / "c"))
    changes = spark.read.parquet(str(tmp_path / "c"))
    assert exchanges(vectors.synced(source, index, changes)) == 0


def test_answers_are_paired_without_a_window(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id int, turn int, role string, text string")
    paired = evaluate.conversation_pairs(turns)
    assert "Window" not in plan(paired) and paired.count() == 1
    metrics = plan(evaluate.metrics(evaluate.scored(paired.withColumns({"expected": F.lit(""), "context": F.lit("")}), ["conv_id"]), ["conv_id"]))
    assert "Expand" not in metrics and metrics.count("partial_count") >= 1


def test_search_cuts_down_before_its_shuffle(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "vec_id int, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, embedding array<double>")
    text = plan(vectors.knn(v, q, 2))
    assert text.count("WindowGroupLimit") == 2 and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "CartesianProduct" not in plan(vectors.knn(v, q, 2, broadcast_bytes=0))
