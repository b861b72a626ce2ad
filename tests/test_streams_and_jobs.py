import csv
import gc
import itertools
import weakref

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pagemill import schemas
from pagemill.functions import parse
from pagemill.operators import bronze, gold, modelhook, silver, vectors
from pagemill.plans import jobs, queries
from pagemill.sources import buckets, files, versions
from pagemill.streaming import ingest
from tests.test_parse_and_pages import PDF

TEXT = lambda content: parse.plain_text(content.cast("string"), 3)


def drop(spark, key, folder, **texts):
    rows = spark.createDataFrame([(f"{n}.enc", t) for n, t in texts.items()], "name string, t string")
    from pagemill.functions.crypto import encrypt_bytes

    content = encrypt_bytes(F.col("t").cast("binary"), key)
    files.write_files(rows.select("name", content.alias("content")), str(folder)).collect()


def page_set(frame):
    columns = ["file_name", "document_type", "page_id", "page_content", "element_count", "element_types"]
    return sorted(tuple(r) for r in frame.select(columns).collect())


def test_stream_equals_batch_over_restarts(spark, key, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    drop(spark, key, inbox, a_hr="one\ntwo\nthree\nfour", b_finance="x")
    (inbox / "note.txt").write_text("not for us")
    (inbox / "bad_hr.enc").write_bytes(b"too short")
    first = ingest.refresh(spark, str(inbox), out, key, TEXT)
    assert len(page_set(silver.unsealed_pages(first, key))) == 3
    # nothing new: nothing happens
    assert ingest.refresh(spark, str(inbox), out, key, TEXT).count() == 3
    drop(spark, key, inbox, c_support="later\nfile")
    ingest.refresh(spark, str(inbox), out, key, TEXT, max_files=1)
    stored = spark.read.parquet(f"{out}/{ingest.PAGES}")
    batch = silver.pages_of(bronze.parsed(files.read_files(spark, str(inbox)), key, TEXT, on_error="quarantine"))
    assert page_set(silver.unsealed_pages(stored, key)) == page_set(batch)
    ingest.refresh_pages(spark, out, key, str(tmp_path / "view"))
    assert page_set(silver.unsealed_pages(versions.read_latest(spark, str(tmp_path / "view")), key)) == page_set(batch)
    docs = spark.read.parquet(f"{out}/{ingest.DOCS}")
    assert [r.file_name for r in bronze.failed(docs).collect()] == ["bad_hr.enc"]
    assert set(docs.columns) == {"file_name", "file_path", "file_size", "document_type", "encrypted_parsed_doc", "ingested_at"}
    elements = spark.read.parquet(f"{out}/{ingest.ELEMENT_TABLE}")
    assert "two" not in {r.encrypted_content for r in elements.collect()}


def test_micro_batches_with_a_stage_of_their_own(spark, key, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    for round_ in ({"a_hr": "1"}, {"b_hr": "2", "c_hr": "3"}):
        drop(spark, key, inbox, **round_)
        stream = files.stream_files(spark, str(inbox), max_files=1)
        build = lambda batch: batch.groupBy().agg(F.count("*").alias("n"))
        ingest.each_batch(stream, out, "counts", build)
    assert [r.n for r in ingest.read_batches(spark, out, "counts").collect()] == [1, 1, 1]


def test_files_to_index(spark, key, tmp_path):
    plain, inbox = tmp_path / "plain", tmp_path / "in"
    plain.mkdir()
    (plain / "offer_hr.pdf").write_bytes(PDF)
    (plain / "tax_audit.pdf").write_bytes(PDF.replace(b"Ann Miller", b"Bob Stone"))
    (plain / "other.pdf").write_bytes(PDF)
    files.encrypt_folder(spark, str(plain), str(inbox), key).collect()
    done = jobs.files_to_index(spark, str(inbox), str(tmp_path / "out"), key)
    assert {(r[0], r[1], r[2]) for r in done.summary.collect()} == {("hr", 2, 1), ("finance", 2, 1)}
    assert [tuple(r) for r in done.unrouted.collect()] == [(None, 2)]
    assert done.index_version == 0
    finance = gold.category_pages(spark, done.gold_path, "finance")
    assert set(finance.columns) == set(schemas.GOLD)
    texts = " ".join(r.page_content_masked for r in finance.collect())
    assert "Name: [[NAME]]" in texts and "Bob" not in texts
    index = vectors.read_index(spark, str(tmp_path / "out" / "index_finance"))
    assert {r.chunk_id for r in index.collect()} == {r.chunk_id for r in finance.collect()}
    again = jobs.files_to_index(spark, str(inbox), str(tmp_path / "out"), key)
    assert again.index_version == 0
    # nothing is new, so nothing is written: the empty table and the first pages are all versions
    assert versions.latest(spark, f"{done.gold_path}/manifest") == 1
    assert buckets.prune(spark, done.gold_path, keep=1) == []
    finance = gold.category_pages(spark, again.gold_path, "finance")
    assert vectors.index_diff(gold.category_pages(spark, again.gold_path, "finance"), index).isEmpty()
    found = jobs.retrieve(
        spark.createDataFrame([(1, "second page")], "query_id int, question string"), index, 1
    ).first()
    assert finance.filter(F.col("chunk_id") == found.id).first().page_content_masked == "second page"


def test_redact_folder(spark, tmp_path):
    source = tmp_path / "pdf"
    source.mkdir()
    (source / "a.pdf").write_bytes(PDF)
    (source / "scan.pdf").write_bytes(b"%PDF-1.4\nno text")
    pages, boxes, leaks = jobs.redact_folder(spark, str(source), str(tmp_path / "done"))
    assert {(r.page_id, r.reason) for r in pages.filter("reason IS NOT NULL").collect()} == {(None, "no readable text layer")}
    rows = {r.page_id: r.redacted for r in pages.filter("reason IS NULL").collect()}
    assert rows[1] == "second page" and rows[0] == "Offer (draft) 1. Terms Name: *** ****** back\\slash after a gap"
    assert [(r.masked, r.fontsize, r.category) for r in boxes.orderBy("pos").collect()] == [("***", 10.0, "PERSON_NAME"), ("******", 10.0, "PERSON_NAME")]
    assert leaks.isEmpty()
    stored = str(versions.read_latest(spark, str(tmp_path / "done")).collect())
    assert "Ann" not in stored and "Miller" not in stored


def test_a_page_that_leaks_is_withheld(spark, tmp_path):
    source = tmp_path / "pdf"
    source.mkdir()
    (source / "a.pdf").write_bytes(PDF)
    half = lambda pages: pages.withColumn(
        "entities",
        F.when(F.col("page_id") == 0, F.array(F.struct(F.lit("Miller").alias("original"), F.lit("Miller").alias("masked"), F.lit("PERSON_NAME").alias("category"))))
        .otherwise(F.array().cast(f"array<{schemas.ENTITY}>")),
    )
    pages, _, leaks = jobs.redact_folder(spark, str(source), str(tmp_path / "done"), entities=half)
    assert {(r.page_id, r.redacted) for r in pages.collect()} == {(0, None), (1, "second page")}
    assert [r.category for r in leaks.collect()] == ["PERSON_NAME"]
    shown, _, _ = jobs.redact_folder(spark, str(source), str(tmp_path / "open"), entities=half, gate=False)
    assert shown.filter("redacted IS NULL").isEmpty()


def test_gold_by_a_model_publishes_only_what_it_has_done(spark, key, tmp_path):
    rows = [("a_hr.enc", "/a_hr.enc", "hr", i, t, 1, "text", None) for i, t in enumerate(["Hi Ann", "bad", "fine"])]
    clear = spark.createDataFrame(rows, "file_name string, file_path string, document_type string, page_id int, page_content string, element_count bigint, element_types string, image_uri string")

    def call(batch):
        if batch.str.contains("bad").any():
            raise RuntimeError("no answer")
        return [p.split("Text:\n")[1].replace("Ann", "[[NAME]]") for p in batch]

    step = lambda pages: modelhook.masked(pages.coalesce(1), call, batch_rows=1)
    stamped = clear.withColumns({"extracted_at": F.current_timestamp(), "aggregated_at": F.current_timestamp()})
    got = jobs.build_gold(spark, silver.sealed_pages(stamped, key), key, str(tmp_path / "gold"), step)
    assert {r.page_id: r.page_content_masked for r in got.collect()} == {0: "Hi [[NAME]]", 2: "fine"}
    assert [(r.page_id, r.error) for r in gold.unmasked(clear, step).collect()] == [(1, "RuntimeError: no answer")]


def test_publishing_nothing_can_be_read(spark, key, tmp_path):
    empty = ingest.stored_pages(spark, str(tmp_path / "none"))
    assert jobs.build_gold(spark, empty, key, str(tmp_path / "gold")).count() == 0


def test_evaluation_from_csv(spark, tmp_path):
    path = tmp_path / "q.csv"
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows([("filename", "question", "answer"), ("a.pdf", "what rate", 'the "rate" is 5'), ("b.pdf", "who", "Ann")])
    answers = spark.createDataFrame([("what rate", ("the rate is 5", None))], "question string, outputs struct<response: string, output: string>")
    long, metrics = jobs.evaluate_answers(spark, str(path), answers)
    got = {(r.filename, r.scorer): r.value for r in long.collect()}
    assert got["a.pdf", "correctness_proxy"] == "yes" and got["b.pdf", "correctness_proxy"] == "no"
    assert got["b.pdf", "concise_response"] == "yes"
    assert {r.scorer: r.n_yes for r in metrics.collect()}["relevance_to_query_proxy"] == 1


def test_landing_folder_is_emptied_behind_the_stream(spark, key, tmp_path):
    inbox, archive, out = tmp_path / "in", tmp_path / "archive", str(tmp_path / "out")
    run = lambda: ingest.ingest_docs(spark, str(inbox), out, key, TEXT, archive=str(archive))
    there = lambda: sorted(p.name for p in inbox.glob("*.enc"))
    kept = lambda: sorted(p.name for p in archive.rglob("*.enc"))
    drop(spark, key, inbox, a_hr="1", b_hr="2")
    run()
    drop(spark, key, inbox, c_hr="3")
    run()
    run()
    drop(spark, key, inbox, d_hr="4")
    run()
    names = sorted(r.file_name for r in spark.read.parquet(f"{out}/{ingest.DOCS}").collect())
    assert names == ["a_hr.enc", "b_hr.enc", "c_hr.enc", "d_hr.enc"]
    assert there() == ["d_hr.enc"] and kept() == ["a_hr.enc", "b_hr.enc", "c_hr.enc"]


def test_a_run_lists_its_files_in_few_tasks(spark, tmp_path):
    name, seen = "spark.sql.sources.parallelPartitionDiscovery.parallelism", []
    before, cores = spark.conf.get(name), spark.sparkContext.defaultParallelism
    spark.range(10).write.parquet(f"{tmp_path}/in")

    def build(batch):
        seen.append(int(spark.conf.get(name)))
        return batch

    ingest.each_batch(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), str(tmp_path), "out", build)
    assert seen and max(seen) <= cores * 4 and spark.conf.get(name) == before
    assert ingest.read_batches(spark, str(tmp_path), "out").count() == 10


def small_shares(spark, monkeypatch, tmp_path, n, max_files):
    """A table of n texts; their files go 25 to a folder and two folders to a stream. Gets a row for each stream: its path and the files there."""
    runs, streams = itertools.count(), []
    globs, read, ingested = files.folder_globs, files.stream_files, ingest.ingest_docs

    def seen(spark, path, **options):
        streams.append((path, spark.read.format("binaryFile").load(path).count()))
        return read(spark, path, **options)

    monkeypatch.setattr(queries, "scratch", lambda spark, name: f"{tmp_path}/{name}-{next(runs)}")
    monkeypatch.setattr(files, "FOLDER_FILES", 25)
    monkeypatch.setattr(files, "folder_globs", lambda folder, folders: globs(folder, folders, 2), raising=False)
    monkeypatch.setattr(files, "stream_files", seen)
    monkeypatch.setattr(ingest, "ingest_docs", lambda *a, **b: ingested(*a, **b, max_files=max_files))
    rows = spark.range(n).selectExpr("id AS doc_id", "concat('src', id % 5) AS source", "repeat('a\\n', CAST(id % 4 AS INT)) AS text")
    rows.write.parquet(f"{tmp_path}/sf/documents.parquet")
    return streams


def test_no_stream_holds_all_files(spark, tmp_path, monkeypatch):
    """The driver remembers every file that a stream has seen."""
    streams = small_shares(spark, monkeypatch, tmp_path, 200, 30)
    got = queries.stream_files(spark, f"{tmp_path}/sf").collect()
    assert sorted((r.file_name.split("_")[0], r.file_size, r.n_elements) for r in got) == sorted((str(k), 2 * (k % 4) + 28, k % 4 + 1) for k in range(200))
    assert len({path for path, _ in streams}) >= 4 and max(there for _, there in streams) <= 100


def test_what_a_run_has_read_is_archived_by_the_next(spark, tmp_path, monkeypatch):
    """Whatever their number: with more files than a micro-batch takes, one stream archives most of them in the run that reads them."""
    streams = small_shares(spark, monkeypatch, tmp_path, 200, 40)
    got = queries.stream_files_archived(spark, f"{tmp_path}/sf").collect()
    ids = {int(r.file_name.split("_")[0]): r.left_in_inbox for r in got}
    assert len(got) == 200 and ids == {k: k % 3 == 2 for k in range(200)}
    assert len({path for path, _ in streams}) >= 4 and max(there for _, there in streams) <= 100


def test_a_finished_stream_is_let_go(spark, tmp_path, monkeypatch):
    begun, start = [], DataStreamWriter.start

    def seen(writer):
        query = start(writer)
        begun.append(weakref.ref(query._jsq))
        return query

    monkeypatch.setattr(DataStreamWriter, "start", seen)
    spark.range(10).write.parquet(f"{tmp_path}/in")
    gc.collect()
    gc.disable()
    try:
        ingest.append(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), str(tmp_path), "out")
    finally:
        gc.enable()
    assert len(begun) == 1 and begun[0]() is None and spark.read.parquet(f"{tmp_path}/out").count() == 10


def test_an_error_in_one_share_is_raised(spark, tmp_path):
    def step(source, into):
        if source == "b":
            raise ValueError("share b")

    with pytest.raises(ValueError, match="share b"):
        ingest.each_share(spark, ["a", "b", "c"], str(tmp_path), step)
