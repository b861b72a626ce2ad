import base64
import gc
import itertools
import weakref

import pytest
from pyspark.sql import functions as F

from pagemill import session
from pagemill.functions import crypto, parse
from pagemill.operators import bronze
from pagemill.plans import queries
from pagemill.sources import evalset, files


def sealed(spark, key, *texts):
    rows = spark.createDataFrame([(f"/in/{i}_hr.enc", t) for i, t in enumerate(texts)], "path string, text string")
    content = crypto.encrypt_bytes(F.col("text").cast("binary"), key)
    return rows.select("path", content.alias("content")).withColumn("length", F.octet_length("content").cast("bigint"))


def test_roundtrip_and_overhead(spark, key):
    texts = ["", "a", "Zoë 三 😀", "x" * 100_000]
    files_ = sealed(spark, key, *texts)
    back = bronze.opened(files_, key).select(F.col("content").cast("string").alias("t"), "length").collect()
    assert {r.t for r in back} == set(texts)
    assert all(r.length == len(r.t.encode()) + crypto.OVERHEAD for r in back)


def broken(spark, key):
    good = sealed(spark, key, "good", "flipped", "short", "empty")
    n = F.octet_length("content")
    content = (
        F.when(F.col("path").contains("/1_"), F.concat(F.substr("content", F.lit(1), n - 1), F.unhex(F.lit("FF00"))))
        .when(F.col("path").contains("/2_"), F.substr("content", F.lit(1), F.lit(11)))
        .when(F.col("path").contains("/3_"), F.lit(None).cast("binary"))
        .otherwise(F.col("content"))
    )
    return good.withColumn("content", content)


def test_broken_files_are_set_aside(spark, key):
    rows = broken(spark, key)
    reasons = {r.file_name: r.reason for r in bronze.quarantined(rows, key).collect()}
    assert reasons == {
        "1_hr.enc": "authentication failed",
        "2_hr.enc": "shorter than nonce and tag",
        "3_hr.enc": "no content",
    }
    assert bronze.opened(rows, key, "quarantine").count() == 1
    parser = lambda c: parse.plain_text(c.cast("string"))
    marked = bronze.sealed_docs(bronze.parsed(rows, key, parser, on_error="mark"), key)
    assert bronze.failed(marked).count() == 3
    with pytest.raises(Exception):
        bronze.opened(rows, key).collect()
    with pytest.raises(ValueError):
        bronze.opened(rows, key, "ignore")


def test_wrong_key_opens_nothing(spark, key):
    assert bronze.opened(sealed(spark, key, "a", "b"), bytes(32), "quarantine").count() == 0


def test_key_comes_from_conf(spark, monkeypatch):
    old = spark.conf.get(session.KEY_CONF, None)
    monkeypatch.delenv(session.KEY_ENV, raising=False)
    try:
        spark.conf.unset(session.KEY_CONF)
        with pytest.raises(ValueError):
            session.data_key(spark)
        monkeypatch.setenv(session.KEY_ENV, base64.b64encode(b"short").decode())
        with pytest.raises(ValueError):
            session.data_key(spark)
        spark.conf.set(session.KEY_CONF, base64.b64encode(bytes(range(32))).decode())
        assert session.data_key(spark) == bytes(range(32))
    finally:
        if old:
            spark.conf.set(session.KEY_CONF, old)
        else:
            spark.conf.unset(session.KEY_CONF)


def test_key_is_not_shown_in_plans(spark, key):
    plan = sealed(spark, key, "a")._jdf.queryExecution().simpleString()
    assert key.hex().upper() not in plan.upper()


def test_folder_is_encrypted_file_by_file(spark, key, tmp_path):
    source, target = tmp_path / "plain", tmp_path / "enc"
    source.mkdir()
    bodies = {"a_hr.pdf": b"%PDF one", "b c.pdf": b"\x00\x01" * 500, "skip.txt": b"no"}
    for name, body in bodies.items():
        (source / name).write_bytes(body)
    done = files.encrypt_folder(spark, str(source), str(target), key).collect()
    assert {(r.name, r.bytes, r.reason) for r in done} == {("a_hr.enc", 8 + 28, None), ("b c.enc", 1000 + 28, None)}
    assert sorted(f.name for f in target.iterdir()) == ["a_hr.enc", "b c.enc"]
    opened = bronze.opened(files.read_files(spark, str(target)), key).select("content").collect()
    assert sorted(bytes(r.content) for r in opened) == sorted([bodies["a_hr.pdf"], bodies["b c.pdf"]])


def test_two_files_of_one_name_are_an_error(spark, key, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"1")
    (tmp_path / "a.txt").write_bytes(b"2")
    with pytest.raises(ValueError, match="a.enc"):
        files.encrypt_folder(spark, str(tmp_path), str(tmp_path / "out"), key, "*.*")


def test_large_files_are_rows_without_content(spark, key, tmp_path):
    (tmp_path / "small.enc").write_bytes(b"x" * 10)
    (tmp_path / "large.enc").write_bytes(b"x" * 1000)
    read = files.read_files(spark, str(tmp_path), max_bytes=100)
    assert sorted((r.length, r.content is None) for r in read.collect()) == [(10, False), (1000, True)]
    assert "length" in read._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    reasons = {r.file_name: r.reason for r in bronze.quarantined(read, key, max_bytes=100).collect()}
    assert reasons == {"small.enc": "shorter than nonce and tag", "large.enc": "not read: too large"}
    written = files.write_files(files.encrypted(read, key), f"file://{tmp_path}/out").collect()
    assert {(r.name, r.bytes, r.reason) for r in written} == {("small.enc", 38, None), ("large.enc", None, "no content")}
    streamed = files.stream_files(spark, str(tmp_path), max_bytes=100)
    query = streamed.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/t").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.length for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [10, 1000]


def test_eval_csv_keeps_quotes_commas_and_lines(spark, tmp_path):
    import csv

    rows = [("a.pdf", 'What is "x", exactly?', "one,\ntwo \\ three"), ("b.pdf", "plain", 'ends with "')]
    path = tmp_path / "q.csv"
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows([("filename", "question", "guideline"), *rows])
    read = evalset.read_eval_csv(spark, str(path))
    assert [tuple(r) for r in read.collect()] == rows
    evalset.write_eval_csv(read, str(tmp_path / "again"))
    assert {tuple(r) for r in evalset.read_eval_csv(spark, str(tmp_path / "again")).collect()} == set(rows)


def test_small_files_share_tasks(spark, tmp_path):
    """Spark puts some 32 small files into a split; a scan has no task for each of these beyond a few a core."""
    for n in range(2_000):
        (tmp_path / f"{n}.enc").write_bytes(b"x" * (n % 7 + 1))
    cores = spark.sparkContext.defaultParallelism
    found = files.read_files(spark, str(tmp_path), max_bytes=6)
    assert found.rdd.getNumPartitions() <= 2 * max(4 * cores, 2_000 // 32 // 32 + 1)
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.content) for r in found.collect()}
    assert got == {f"{n}.enc": (n % 7 + 1, bytearray(b"x" * (n % 7 + 1)) if n % 7 < 6 else None) for n in range(2_000)}


def test_files_are_dealt_to_folders_and_read_group_by_group(spark, key, tmp_path):
    """Tasks that write into one folder wait for each other, and the driver lists a folder whole."""
    rows = spark.range(300).selectExpr("concat(id % 299, '.enc') AS name", "CAST(concat('body ', id % 299) AS BINARY) AS content")
    written = files.write_files(rows.unionByName(spark.sql("SELECT 'none.enc' AS name, CAST(NULL AS BINARY) AS content")), str(tmp_path), 7).collect()
    assert len(written) == 301 and sorted(f.name for f in tmp_path.iterdir()) == [f"{n:06d}" for n in range(7)]
    done = spark.createDataFrame(written, "name string, bytes bigint, reason string")
    groups = files.folder_groups(done, str(tmp_path), 7, at_once=3)
    assert [len(g) for g in groups] == [3, 3, 1]
    got = [(r.path.rsplit("/", 1)[1], bytes(r.content)) for g in groups for r in files.read_files(spark, g).collect()]
    assert sorted(got) == sorted((f"{n}.enc", b"body %d" % n) for n in range(299))


@pytest.mark.parametrize("n", [0, 1, 2_300])
def test_encrypted_files_are_found_again_in_all_folders(spark, tmp_path, monkeypatch, n):
    runs = itertools.count()
    monkeypatch.setattr(queries, "scratch", lambda spark, name: f"{tmp_path}/{name}-{next(runs)}")
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('src', id % 5) AS source", "repeat('a\\n', CAST(id % 4 AS INT)) AS text")
    docs.write.parquet(f"{tmp_path}/sf/documents.parquet")
    got = queries.encrypted_files_roundtrip(spark, f"{tmp_path}/sf").collect()
    assert sorted((r.file_size, r.n_elements) for r in got) == sorted((2 * (k % 4) + 28, k % 4 + 1) for k in range(n))
    folder = tmp_path / "enc-0"
    assert not n or sorted(f.name for f in folder.iterdir()) == [f"{k:06d}" for k in range(-(-n // files.FOLDER_FILES))]
    again = queries.opened_files(spark, str(folder), max(1, -(-n // files.FOLDER_FILES)), session.ephemeral_key(spark), at_once=2)
    assert sorted(r.file_size for r in again.collect()) == sorted(r.file_size for r in got)


def test_the_driver_lets_go_of_each_group_of_folders(spark, key, tmp_path, monkeypatch):
    """A frame holds the list of its files; Python frees it only when it looks for cycles."""
    rows = spark.range(60).selectExpr("concat(id, '.enc') AS name", "CAST('body' AS BINARY) AS content")
    sealed = rows.select("name", crypto.encrypt_bytes(F.col("content"), key).alias("content"))
    files.write_files(sealed, f"{tmp_path}/enc", 6).write.parquet(f"{tmp_path}/enc_written")
    monkeypatch.setattr(queries, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    read, frames, alive = files.read_files, [], []

    def seen(*args):
        alive.append(sum(f() is not None for f in frames))
        found = read(*args)
        frames.append(weakref.ref(found._jdf))
        return found

    monkeypatch.setattr(queries.files, "read_files", seen)
    gc.collect()
    gc.disable()
    try:
        got = queries.opened_files(spark, f"{tmp_path}/enc", 6, key, at_once=2)
    finally:
        gc.enable()
    assert got.count() == 60 and alive == [0, 0, 0]


CACHED = "spark.sql.hive.filesourcePartitionFileCacheSize"


def test_listings_are_not_kept_for_the_session(spark):
    before = spark.conf.get(CACHED)
    with session.few_listing_tasks(spark):
        assert spark.conf.get(CACHED) == "0"
    assert spark.conf.get(CACHED) == before
    assert files.LISTED_FOLDERS * files.FOLDER_FILES <= 64_000
