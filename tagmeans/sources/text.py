"""Text scan (S1): posting lines from files or from any ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line: ``value string``. Splittable for plain and
    splittable-compressed files, so a large file is read by many tasks."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths)


def as_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Use any string column of an existing DataFrame as posting lines."""
    return df.select(df[column].cast("string").alias("value"))
