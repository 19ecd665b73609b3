"""Readers for Parquet datasets and named tables (sources S1, S4, S6)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver tables the named queries run on.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table of a scale-factor folder."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_day(spark: SparkSession, root: str, ds: str,
             partition_col: str = "dt") -> DataFrame:
    """One day of a ``dt=``-partitioned dataset. Only its own folder is listed;
    a day without a folder has no rows."""
    folder = f"{root.rstrip('/')}/{partition_col}={ds}"
    try:
        return spark.read.option("basePath", root).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(root).where(F.lit(False))


def read_events_stream(spark: SparkSession, path: str, schema, fmt: str = "json",
                       max_files_per_batch: int = 1000, options: dict | None = None) -> DataFrame:
    """A stream of landed event files with a fixed schema (any other Spark
    streaming source can stand in for it unchanged). Micro-batches are
    bounded by ``max_files_per_batch``, also under ``availableNow``."""
    return (spark.readStream.schema(schema).format(fmt).options(**(options or {}))
            .option("maxFilesPerTrigger", max_files_per_batch).load(path))
