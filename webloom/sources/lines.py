"""Side inputs: text files, plain or compressed, one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | None) -> DataFrame | None:
    """``value`` per line of the files at ``path``; no path means no such input."""
    return None if path is None else spark.read.text(path)
