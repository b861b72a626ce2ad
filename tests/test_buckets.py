"""Tables that are replaced folder by folder: index, gold and the maintained page view."""

import os

import pytest
from pyspark.sql import functions as F

from pagemill.functions import parse
from pagemill.operators import bronze, gold, modelhook, silver, vectors
from pagemill.sources import buckets, versions
from pagemill.streaming import ingest

ROWS = "k STRING, v INT, bucket INT"


def rows(spark, pairs, count=4):
    return spark.createDataFrame(pairs, "k STRING, v INT").withColumn("bucket", buckets.bucket("k", count))


def files_under(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def test_folders_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    assert buckets.read(spark, path, ROWS) is None and buckets.last_batch(spark, path) == -1
    first = rows(spark, [(f"k{i}", i) for i in range(40)])
    parts = [r.p for r in first.select(buckets.part(["bucket"]).alias("p")).distinct().collect()]
    assert buckets.replace(first, path, ["bucket"], parts) == 0
    before = files_under(path)
    touched = [parts[0]]
    changed = buckets.read(spark, path, ROWS, touched).select("k", (F.col("v") + 100).alias("v"), "bucket")
    assert buckets.replace(changed, path, ["bucket"], touched, batch=5) == 1
    assert buckets.last_batch(spark, path) == 5
    got = {r.k: r.v for r in buckets.read(spark, path, ROWS).collect()}
    moved = {r.k for r in first.collect() if f"bucket={r.bucket}" == touched[0]}
    assert got == {f"k{i}": i + 100 * (f"k{i}" in moved) for i in range(40)}
    # what was not touched is not written again
    assert all(files_under(path)[f] == t for f, t in before.items())
    # a version without a finished manifest does not count
    versions.write_next(rows(spark, [("x", 1)]), f"{path}/data", "bucket")
    (tmp_path / "t" / "manifest" / "version=9").mkdir()
    assert buckets.read(spark, path, ROWS).count() == 40
    # a folder that becomes empty goes
    assert buckets.replace(first.filter("false"), path, ["bucket"], touched) == 10
    assert buckets.read(spark, path, ROWS).count() == 40 - len(moved)
    assert buckets.prune(spark, path, keep=1) == sorted(f"data/version={v}/{touched[0]}" for v in (0, 1))
    assert buckets.read(spark, path, ROWS).count() == 40 - len(moved)
    buckets.replace(first.filter("false"), path, ["bucket"], parts)
    assert buckets.read(spark, path, ROWS).count() == 0
    with pytest.raises(ValueError, match="folder"):
        buckets.replace(first, path, ["bucket"], ["bucket=../x"])


def test_a_sync_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "index")
    texts = [(f"key{i}", f"text {i}") for i in range(2000)]
    source = spark.createDataFrame(texts, "chunk_id string, page_content_masked string").repartition(4)
    assert vectors.sync_index(source, path, count=32) == 0
    before = files_under(path)
    one = source.withColumn("page_content_masked", F.when(F.col("chunk_id") == "key7", "changed").otherwise(F.col("page_content_masked")))
    assert vectors.sync_index(one, path) == 1
    manifests = [{r.part: r.version for r in spark.read.parquet(f"{path}/manifest/version={n}").collect()} for n in (0, 1)]
    assert len(manifests[0]) == 32 and sum(manifests[0][p] != manifests[1][p] for p in manifests[0]) == 1
    new = set(files_under(path)) - set(before)
    assert len({os.path.dirname(f) for f in new if "/data/" in f and f.endswith(".parquet")}) == 1
    # nothing changed: nothing is written
    before = files_under(path)
    assert vectors.sync_index(one, path) == 1 and files_under(path) == before
    feed = {(r.version, r.action): r["count"] for r in vectors.read_changes(spark, path).groupBy("version", "action").count().collect()}
    assert feed == {(0, "insert"): 2000, (1, "update"): 1}
    assert vectors.index_diff(one, vectors.read_index(spark, path)).isEmpty()


PAGES = "file_name string, file_path string, document_type string, page_id int, page_content string, element_count bigint, element_types string, image_uri string"


def pages(spark, texts, kind="hr"):
    listed = [(f"f{i}", f"/f{i}", k, 0, t, 1, "text", None) for i, (t, k) in enumerate((x if isinstance(x, tuple) else (x, kind)) for x in texts)]
    return spark.createDataFrame([r for r in listed if r[4] is not None], PAGES).repartition(3)


def as_rows(frame):
    return sorted((r.file_path, r.document_type, r.page_content_masked) for r in frame.collect())


def test_only_new_and_changed_pages_are_masked(spark, tmp_path):
    path, calls = str(tmp_path / "gold"), spark.sparkContext.accumulator(0)

    def call(batch):
        calls.add(len(batch))
        return [asked.split("Text:\n", 1)[1].replace("Ann", "[[NAME]]") for asked in batch]

    step = lambda pages: modelhook.masked(pages, call)
    texts = [f"Name: Ann Lee{chr(97 + i)} wrote page {i}" for i in range(20)]

    def run(listed):
        at = calls.value
        version = gold.sync(pages(spark, listed), path, "secret", masked=step, count=8)
        asked = calls.value - at
        assert as_rows(gold.published(spark, path)) == as_rows(gold.masked_pages(pages(spark, listed), masked=step))
        return version, asked

    first, asked = run(texts)
    assert asked == 20
    before = files_under(path)
    assert run(texts) == (first, 0) and files_under(path) == before
    # one changed, one gone, one new, one in another category
    changed = [*texts, "Name: Bob Stone is new"]
    changed[3], changed[5], changed[8] = "Call 415-555-0134", None, (texts[8], "support")
    second, asked = run(changed)
    assert second == first + 1 and asked == 3
    assert {r.action: r["count"] for r in spark.read.parquet(f"{path}/changes/version=1").groupBy("action").count().collect()} == {"insert": 1, "update": 2, "delete": 1}
    assert gold.category_pages(spark, path, "support").count() == 1
    assert run([])[1] == 0 and gold.published(spark, path).count() == 0


def test_equal_requests_are_asked_once_and_failures_again(spark, tmp_path):
    path, calls = str(tmp_path / "answers"), spark.sparkContext.accumulator(0)
    rows_ = spark.createDataFrame([(i, None if i == 0 else f"text {i % 5}") for i in range(40)], "id int, t string").repartition(3)

    def call(batch, broken=False):
        calls.add(len(batch))
        if broken and any("3" in t for t in batch):
            raise RuntimeError("broken")
        return [t.upper() for t in batch]

    first = modelhook.asked(rows_, path, lambda b: call(b, True), "t", "said", batch_rows=1).collect()
    assert calls.value == 5 and {r.said for r in first if r.error is None} == {None, "TEXT 0", "TEXT 1", "TEXT 2", "TEXT 4"}
    assert {r.t for r in first if r.error} == {"text 3"}
    second = modelhook.asked(rows_, path, call, "t", "said").collect()
    assert calls.value == 6 and all(r.error is None and r.said == (r.t and r.t.upper()) for r in second) and len(second) == 40
    third = modelhook.asked(rows_, path, call, "t", "said")
    assert third.count() == 40 and calls.value == 6


def test_a_maintained_view_equals_the_batch_view(spark, key, tmp_path):
    target, into = str(tmp_path / "out"), str(tmp_path / "view")
    docs = spark.createDataFrame([(f"{n}_hr.enc", f"/{n}", "hr", "\n".join(f"{n} line {i}" for i in range(n))) for n in range(1, 12)], "file_name string, file_path string, document_type string, text string")
    elements = bronze.explode_elements(docs.withColumn("parsed_doc", parse.plain_text(F.col("text"), 3)))

    def append(part):
        bronze.sealed_elements(part, key).write.mode("append").parquet(f"{target}/{ingest.ELEMENT_TABLE}")

    def shown(frame):
        return sorted(tuple(r) for r in silver.unsealed_pages(frame, key).select("file_name", "file_path", "page_id", "page_content", "element_count", "element_types").collect())

    assert ingest.maintained_pages(spark, into).count() == 0
    for part in ("element_id % 2 = 0 AND file_path < '/5'", "element_id % 2 = 0 AND file_path >= '/5'", "element_id % 2 = 1"):
        append(elements.filter(part))
        ingest.maintain_pages(spark, target, key, into, count=8)
        whole = silver.sealed_pages(silver.pages(bronze.unsealed_elements(spark.read.parquet(f"{target}/{ingest.ELEMENT_TABLE}"), key)), key)
        assert shown(ingest.maintained_pages(spark, into)) == shown(whole)
    last = buckets.last_batch(spark, into)
    assert last >= 2
    before = files_under(into)
    ingest.renew_pages(spark.read.parquet(f"{target}/{ingest.ELEMENT_TABLE}"), last, target, key, into, 8)
    ingest.maintain_pages(spark, target, key, into, count=8)
    assert {f for f in files_under(into) if "_checkpoint" not in f} == {f for f in before if "_checkpoint" not in f}


def test_renewed_pages_are_dealt_once(spark, key, tmp_path, monkeypatch):
    """Pages go to their buckets before they are sealed; many files in a batch give the same view as few."""
    target, shown = str(tmp_path / "t"), []
    rows = [(f"{f}_hr.enc", f"/{f}_hr.enc", "hr", n, "text", f"{f} {n}", None, n // 3, None, None) for f in range(30) for n in range(6)]
    names = "file_name string, file_path string, document_type string, element_id int, element_type string, content string, description string, page_id int, image_uri string, bbox_json string"
    clear = spark.createDataFrame(rows, names).withColumn("extracted_at", F.current_timestamp())
    asked, replace = [], ingest.buckets.replace
    monkeypatch.setattr(ingest.buckets, "replace", lambda *a, **k: asked.append(k.get("dealt")) or replace(*a, **k))
    for few, into in ((100, str(tmp_path / "a")), (0, str(tmp_path / "b"))):
        monkeypatch.setattr(ingest, "FEW_FILES", few)
        folder = f"{target}{few}"
        for half in ("element_id % 2 = 0", "element_id % 2 = 1 AND file_name < '2'"):
            bronze.sealed_elements(clear.filter(half), key).write.mode("append").parquet(f"{folder}/{ingest.ELEMENT_TABLE}")
            ingest.maintain_pages(spark, folder, key, into, count=4)
        shown.append(sorted(tuple(r) for r in silver.unsealed_pages(ingest.maintained_pages(spark, into), key).select("file_path", "page_id", "page_content").collect()))
    assert shown[0] == shown[1] and len(shown[0]) == 60 and asked == [True] * 4


def test_gold_reads_no_text_for_pages_that_only_go(spark, tmp_path):
    """A run that finds only deleted pages neither masks nor joins the pages that are there."""
    asked = []
    rows = [(f"{f}_hr.enc", f"/{f}_hr.enc", "hr", 0, f"text {f}", 1, "text", None) for f in range(20)]
    pages = spark.createDataFrame(rows, "file_name string, file_path string, document_type string, page_id int, page_content string, element_count long, element_types string, image_uri string")
    mask = lambda text: asked.append(1) or F.upper(text)
    for kept, n in ((pages, 20), (pages.filter("file_name < '15'"), None)):
        gold.sync(kept, str(tmp_path), "s", mask=mask)
        got = {(r.file_path, r.page_content_masked) for r in gold.published(spark, str(tmp_path)).collect()}
        assert got == {(r.file_path, r.page_content.upper()) for r in kept.collect()} and len(got) == (n or len(got))
    assert asked == [1]
