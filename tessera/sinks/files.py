"""File sinks (K1-K4, K7, K8). Writers are idempotent: a re-run of a task or
of the whole job rewrites the same files, so a lost executor only costs the
retry of its tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# Marker for NULL in CSV so that NULL and '' survive a round trip.
CSV_NULL = "\\N"
# Timestamps in text formats keep microseconds (the default drops them).
TS_FORMATS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


#: Files that one partition folder is written as, at most.
FILES_PER_FOLDER = 4


def layout_for_partitions(df: DataFrame, partition_by: Sequence[str], within: Sequence[str] = (),
                          files: int = FILES_PER_FOLDER) -> DataFrame:
    """Deal rows by (partition columns, hash of ``within``) before a partitioned
    write: a folder gets up to ``files`` files instead of one per task, and a
    hot partition value is written by as many tasks (raise ``files`` for large
    folders). One exchange, and the input is read once."""
    if not partition_by:
        return df
    # A fixed task count: AQE would coalesce small inputs into one task that
    # then writes every partition folder serially.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = [F.pmod(F.xxhash64(*within), F.lit(files))] if within else []
    return df.repartition(n, *partition_by, *bucket)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), within: Sequence[str] = (),
                  files: int = FILES_PER_FOLDER) -> str:
    """Write, by default in place of everything at ``path`` whatever the session's overwrite mode."""
    w = layout_for_partitions(df, partition_by, within, files).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       within: Sequence[str] = (), files: int = FILES_PER_FOLDER) -> str:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite) and keep every other one.

    A partition that became empty is not present; use ``replace_folder`` for it.
    """
    (layout_for_partitions(df, partition_by, within, files).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))
    return path


def replace_folder(df: DataFrame, root: str, partition: str, value: str) -> str:
    """Overwrite one partition folder, ``root/partition=value``; an empty ``df`` clears it."""
    path = f"{root.rstrip('/')}/{partition}={value}"
    df.drop(partition).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


#: Bytes of a Parquet row group in sorted files: the unit that a reader skips.
GROUP_BYTES = 1 << 20


def write_sorted(df: DataFrame, path: str, by: Sequence[str], files: int | None = None, group_bytes: int = GROUP_BYTES) -> str:
    """Range-partitioned files, sorted within, in small row groups: their bounds let a range read skip the rest.

    One exchange by sampled ranges (equal values stay together only as far as ``by`` tells rows apart: add a key
    to it, so that a frequent value is cut over files). ``files`` is the number of ranges (the session's partitions).
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *by).sortWithinPartitions(*by).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").option("parquet.block.size", group_bytes)
     .option("parquet.page.size.row.check.min", 100).option("parquet.block.size.row.check.min", 100).parquet(path))
    return path


def write_text(df: DataFrame, path: str, col: str = "value") -> str:
    """One element per line, one file per task (sharded text sink)."""
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              null_value: str | None = None) -> str:
    """CSV export with doubled-quote escaping; atomic columns only."""
    nested = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (ArrayType, MapType, StructType))]
    if nested:
        raise ValueError(f"CSV holds atomic columns only; nested: {nested}")
    w = (df.write.mode("overwrite").option("header", header).option("sep", sep)
         .option("quote", '"').option("escape", '"').options(**TS_FORMATS))
    if null_value is not None:
        w = w.option("nullValue", null_value).option("emptyValue", '""')
    w.csv(path)
    return path


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = (),
               mode: str = "overwrite") -> str:
    """JSON-lines documents, optionally under dated/run-keyed folders."""
    w = df.write.mode(mode).options(**TS_FORMATS).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
    return path
