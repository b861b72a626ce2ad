"""Documents to packed training sequences: stages that each apply one operator to what the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import decontaminate, exact_dedup, packing, quality, queries, simhash
from pagemill.llm.common import stored
from pagemill.sources.tables import table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, trained on the labels of these documents, does not reject."""
    return quality.keep_good(docs, queries.quality_model(spark, docs, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by near fingerprints the row with the smallest id."""
    return simhash.dedup(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in training sequences, with their token ids."""
    return packing.pack(docs, queries.tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", keep_good_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# Trained scores and fingerprints have no form in SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs)
    return docs
