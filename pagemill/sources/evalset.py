"""Evaluation sets: CSV with a header, as Python's csv module writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Quotes inside a field are doubled, and a field may hold line breaks.
_DIALECT = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def read_eval_csv(spark: SparkSession, path: str) -> DataFrame:
    """(filename, question, answer), all strings; an older set calls the answer ``guideline``."""
    rows = spark.read.options(**_DIALECT).csv(path)
    if "answer" not in rows.columns and "guideline" in rows.columns:
        rows = rows.withColumnRenamed("guideline", "answer")
    return rows.select(*[F.col(c) for c in ("filename", "question", "answer")])


def write_eval_csv(rows: DataFrame, path: str) -> None:
    writer = rows.select("filename", "question", "answer").write.mode("overwrite")
    writer.options(header="true", quote='"', escape='"').csv(path)
