"""One place where a model can be called: batches of rows in, batches of rows out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..functions.text import not_blank
from ..sources import versions
from . import detect

ANSWERS = "hash STRING, answer STRING, error STRING, run BIGINT"

# What a model is asked for when it masks a page for publishing.
MASKING_RULES = (
    "Mask the personal data in the text and change nothing else. Names become [[NAME]], social security\n"
    "numbers <<SSN>>, addresses [ADDRESS]. Of e-mail addresses keep the domain only, of phone numbers the\n"
    "format and the last four digits, of card numbers the format without digits. Answer with the text only.\n\nText:\n"
)


def map_batches(
    rows: DataFrame,
    call: Callable[[pd.Series], Sequence[object]],
    column: str,
    result: str,
    result_type: str = "string",
    batch_rows: int = 64,
    error: str = "error",
) -> DataFrame:
    """Add ``result = call(column)``, asked for in batches of at most ``batch_rows``.

    Rows without input are not asked about. A batch whose call fails gets NULL results and
    the reason in ``error``; the job goes on and the failed rows can be sent again. The
    number of calls at one time is the number of running tasks.
    """
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + f", `{result}` {result_type}, `{error}` string"
    place, kind = rows.columns.index(column), to_arrow_type(DataType.fromDDL(result_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), batch_rows):
                part = batch.slice(at, batch_rows)
                # only the asked column is turned into Python values, all others stay as they are
                values = part.column(place).to_pylist()
                asked = [n for n, value in enumerate(values) if value is not None]
                given, problem = [None] * len(values), None
                try:
                    answers = list(call(pd.Series([values[n] for n in asked]))) if asked else []
                    if len(answers) != len(asked):
                        raise ValueError(f"{len(answers)} answers for {len(asked)} rows")
                    for n, answer in zip(asked, answers, strict=True):
                        given[n] = answer
                    told = pa.array(given, kind)
                except Exception as failure:
                    problem = f"{type(failure).__name__}: {failure}"
                    told = pa.nulls(len(values), kind)
                said = pa.array([problem if value is not None else None for value in values], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, told, said], names=[*part.schema.names, result, error])

    return rows.mapInArrow(run, schema)


def answers(spark: SparkSession, path: str) -> DataFrame:
    """(hash, answer, error) of every request asked so far: its answer, or what went wrong last."""
    runs = [f"{path}/version={n}" for n in versions.complete(spark, path)]
    told = spark.read.schema(ANSWERS).parquet(*runs) if runs else spark.createDataFrame([], ANSWERS)
    best = F.max_by(F.struct("answer", "error"), F.struct(F.col("error").isNull(), "run")).alias("told")
    return told.groupBy("hash").agg(best).select("hash", "told.answer", "told.error")


def asked(
    rows: DataFrame, path: str, call: Callable[[pd.Series], Sequence[str]], column: str, result: str, batch_rows: int = 64, error: str = "error"
) -> DataFrame:
    """``map_batches`` for text answers over a table of requests at ``path``: equal requests are asked once, in this run and in later ones.

    A request is known by its hash. Failures stay in the table and are asked again by the next run. Rows
    without input get neither answer nor error.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("_hash", F.sha2(F.col(column), 256))
    wanted = keyed.filter("_hash IS NOT NULL").groupBy(F.col("_hash").alias("hash")).agg(F.max(column).alias("request"))
    new = wanted.join(answers(spark, path).filter("error IS NULL").select("hash"), "hash", "left_anti")
    told = map_batches(new, call, "request", "answer", batch_rows=batch_rows)
    versions.write_next(told.select("hash", "answer", "error", F.lit(time.time_ns()).alias("run")), path)
    known = answers(spark, path).select(F.col("hash").alias("_hash"), F.col("answer").alias(result), F.col("error").alias(error))
    return keyed.join(known, "_hash", "left").drop("_hash")


def masked(
    pages: DataFrame, call, text: str = "page_content", result: str = "page_content_masked", batch_rows: int = 64, path: str | None = None
) -> DataFrame:
    """Pages masked for publishing by a model; a page that failed has no masked text and an ``error``.

    With a ``path`` the answers are kept there: equal pages are asked once, and a second look at the same pages, such as ``gold.unmasked``
    after publishing, asks only for what failed.
    """
    request = F.when(not_blank(F.col(text)), F.concat(F.lit(MASKING_RULES), F.col(text)))
    if path is not None:
        return asked(pages.withColumn("_request", request), path, call, "_request", result, batch_rows).drop("_request")
    return map_batches(pages.withColumn("_request", request), call, "_request", result, batch_rows=batch_rows).drop("_request")


def entities(pages: DataFrame, call, text: str = "page_content") -> DataFrame:
    """``entities`` of pages from a model's answers to ``detect.prompt``."""
    request = F.when(not_blank(F.col(text)), detect.prompt(F.col(text)))
    told = map_batches(pages.withColumn("_request", request), call, "_request", "_answer")
    return told.withColumn("entities", detect.answered(F.col("_answer"))).drop("_request", "_answer")


def embedded(rows: DataFrame, call, text: str, result: str = "embedding") -> DataFrame:
    """Vectors from a model."""
    return map_batches(rows, call, text, result, "array<float>")


def judged(rows: DataFrame, name: str, call, columns: Sequence[str] = ("question", "answer", "expected", "context")) -> DataFrame:
    """A scorer column from a judge that gets the columns as JSON; an answer but yes or no counts as none."""
    told = map_batches(rows.withColumn("_case", F.to_json(F.struct(*columns))), call, "_case", "_verdict", error=f"{name}_error")
    verdict = F.lower(F.trim("_verdict"))
    return told.withColumn(name, F.when(verdict.isin("yes", "no"), verdict)).drop("_case", "_verdict")


def classified(files: DataFrame, call, labels: Sequence[str], column: str = "file_name") -> DataFrame:
    """``document_type`` from a model; an answer outside the labels counts as none."""
    answered = map_batches(files, call, column, "_label")
    label = F.lower(F.trim("_label"))
    return answered.withColumn("document_type", F.when(label.isin(*labels), label)).drop("_label")
