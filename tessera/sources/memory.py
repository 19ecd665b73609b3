"""In-memory rows (S3): small literal lookups and fixtures only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A DataFrame from literal rows; its size is known on the driver."""
    return spark.createDataFrame(list(rows), schema)


def lookup(spark: SparkSession, rows, schema) -> DataFrame:
    """A literal lookup table. Spark knows its size in bytes and broadcasts it
    below the session's threshold; a larger one is joined by a shuffle."""
    return from_rows(spark, rows, schema)
