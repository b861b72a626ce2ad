"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, spread over all cores if it has too few splits."""
    return spread(table(spark, folder, name).select(*columns))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
