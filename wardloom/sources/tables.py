"""Whole-table reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, where: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet folder or file by path; optionally some columns only."""
    df = spark.read.parquet(where) if "/" in where else spark.table(where)
    return df.select(*columns) if columns else df
