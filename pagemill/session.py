"""Session settings and the few run-time facts the stages look up."""

from __future__ import annotations

import base64
import gc
import os
import secrets
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

KEY_CONF = "spark.pagemill.key"
KEY_ENV = "PAGEMILL_KEY"

# Hides 256-bit key literals in plans and in the UI.
_REDACT = r"0x[0-9A-Fa-f]{64}"
# Hides settings by name: Spark's own words and the setting that holds the key.
_REDACT_NAMES = r"(?i)secret|password|token|access[.]?key|pagemill[.]key|PAGEMILL_KEY"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # writers kept open per task instead of a sort by category before a partitioned write
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # call sites per Column cost more than building the plan itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.redaction.string.regex": _REDACT,
    "spark.redaction.regex": _REDACT_NAMES,
}


def build_session(app_name: str = "pagemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def data_key(spark: SparkSession) -> bytes:
    """The 32-byte AES key, from the session conf or the environment; never from source."""
    encoded = spark.conf.get(KEY_CONF, None) or os.environ.get(KEY_ENV)
    if not encoded:
        raise ValueError(f"set {KEY_CONF} or {KEY_ENV} to a base64 256-bit key")
    return check_key(base64.b64decode(encoded))


def check_key(key: bytes) -> bytes:
    if len(key) != 32:
        raise ValueError(f"AES key must have 32 bytes, got {len(key)}")
    return key


def ephemeral_key(spark: SparkSession) -> bytes:
    """Configured key, or one drawn for this session: fine while nothing outlives the job."""
    try:
        return data_key(spark)
    except ValueError:
        key = secrets.token_bytes(32)
        spark.conf.set(KEY_CONF, base64.b64encode(key).decode())
        return key


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. The cluster names it in ``spark.checkpoint.dir``."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="pagemill-")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back, for a step that several later ones read."""
    path = f"{shared_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one round-robin shuffle.

    Text work is CPU-bound, and a small Parquet file with one row group is a single
    task. A large scan already has more splits than cores and is returned untouched,
    so no shuffle is added where it would cost something. Meant for a bare scan only.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores * 2)


# Splits of a scan of many small files that one task reads at most.
SPLITS_A_TASK = 32


def gathered(scan: DataFrame) -> DataFrame:
    """Fewer tasks for a scan of many small files, without a shuffle.

    Spark counts a file as 4 MB at least, so a split is some 32 small files, and a task for each
    costs more than the reading. A scan keeps a few tasks a core in any case.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.isStreaming:
        return scan.coalesce(cores * 4)
    splits = scan.rdd.getNumPartitions()
    tasks = max(cores * 4, -(-splits // SPLITS_A_TASK))
    return scan if splits <= tasks else scan.coalesce(tasks)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Listing jobs with a few tasks a core, whose results the driver forgets after use.

    A micro-batch lists the files it reads, by default with one task for each. Spark also keeps listings of up to 250 MB
    for each session's end, though none is ever looked up again but by the frame that made it.
    """
    name, tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext.defaultParallelism * 4
    kept = "spark.sql.hive.filesourcePartitionFileCacheSize"
    before = {n: spark.conf.get(n) for n in (name, kept)}
    spark.conf.set(name, str(min(int(before[name]), tasks)))
    spark.conf.set(kept, "0")
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def forget() -> None:
    """Let go of the JVM objects that no variable holds any more.

    Python's handles of them lie in reference cycles, so the driver keeps frames with their listings, and streams with all
    the files they know, until Python happens to look for cycles. A loop over such objects asks for it.
    """
    gc.collect()
