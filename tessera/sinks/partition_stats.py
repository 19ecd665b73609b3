"""Dated datasets whose writer keeps statistics of each partition: rows, files, bytes.

The statistics are a small Parquet table below the dataset (``_stats``), one row for each partition, named by the
manifest (``sinks.manifest``). The newest partitions and the bytes of a scan come from it, so no reader lists the
dataset's folders. A writer stages its partitions, measures what it staged, then announces the
partitions as pending, moves them into place, and publishes the new statistics; if it stops in between, readers
measure the pending partitions themselves (their folders alone), and the next run of the same days puts things right.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.quality import GateFailed
from tessera.sinks import manifest
from tessera.sinks.files import FILES_PER_FOLDER, layout_for_partitions
from tessera.sinks.manifest import Files
from tessera.sources.files import partition_folder

STATS, STAGING = "_stats", "_staging"


def _schema(by: str, kind: str) -> str:
    return f"`{by}` {kind}, rows long, files long, bytes long"


def _measured(spark: SparkSession, root: str, base: str, by: str, kind: str, folders: list[str]) -> DataFrame:
    """Rows, files and bytes of partition folders, from file listing and footers: no data column is read."""
    if not folders:
        return spark.createDataFrame([], _schema(by, kind))
    rows = spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
    of_file = rows.groupBy(F.col(by).cast(kind).alias(by), F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    return of_file.groupBy(by).agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def replace_measured(df: DataFrame, root: str, by: str = "dt", within: Sequence[str] = (),
                     files: int = FILES_PER_FOLDER, emptied: Sequence[str] = ()) -> list[str]:
    """Replace the partitions that ``df`` holds, and clear the values ``emptied`` that it does not; other partitions stay.

    Returns the partition folders that were written. Rows without a partition value are refused.
    """
    spark, kind = df.sparkSession, df.schema[by].dataType.simpleString()
    at = Files(spark, root)
    staged = f"{STAGING}/{uuid.uuid4().hex}"
    present = df.withColumn(by, F.when(F.col(by).isNull(), F.raise_error(F.lit(f"no value of {by}"))).otherwise(F.col(by)))
    layout_for_partitions(present, [by], within, files).write.partitionBy(by).parquet(f"{at.root}/{staged}")
    folders = [n for n in at.names(staged) if n.startswith(f"{by}=")]
    cleared = [f for v in emptied if (f := partition_folder(by, v)) not in folders]
    version, known = manifest.load(at)
    old = stats(spark, root, by, kind)
    new = _measured(spark, root, f"{at.root}/{staged}", by, kind, folders)
    touched = [f.split("=", 1)[1] for f in folders + cleared]
    values = spark.createDataFrame([(v,) for v in touched], "value string")
    kept = old.join(F.broadcast(values), F.col(by).cast("string") == F.col("value"), "left_anti")
    table = f"{STATS}/{uuid.uuid4().hex}"
    kept.unionByName(new).coalesce(1).write.parquet(f"{at.root}/{table}")
    version = manifest.commit(at, version, {**known, "pending": sorted({*known.get("pending", []), *folders, *cleared})})
    for f in cleared:
        at.delete(f)
    for f in folders:
        at.delete(f)
        at.move(f"{staged}/{f}", f)
    left = sorted(set(known.get("pending", [])) - {*folders, *cleared})
    manifest.commit(at, version, {"stats": table, "pending": left})
    at.delete(staged)
    if known.get("stats"):
        at.delete(known["stats"])
    manifest.forget(at, keep=2)
    return folders


def stats(spark: SparkSession, root: str, by: str = "dt", kind: str = "date") -> DataFrame:
    """``by, rows, files, bytes``: one row for each partition that has files."""
    at = Files(spark, root)
    _, known = manifest.load(at)
    table = spark.read.schema(_schema(by, kind)).parquet(f"{at.root}/{known['stats']}") if known.get("stats") \
        else spark.createDataFrame([], _schema(by, kind))
    pending = known.get("pending", [])
    if pending:
        values = spark.createDataFrame([(f.split("=", 1)[1],) for f in pending], "value string")
        there = [f for f in pending if any(n.endswith(".parquet") for n in at.names(f))]
        table = table.join(F.broadcast(values), F.col(by).cast("string") == F.col("value"), "left_anti").unionByName(
            _measured(spark, root, at.root, by, kind, there))
    return table


def scan_cost(spark: SparkSession, root: str, where: Column | None = None, by: str = "dt", kind: str = "date") -> DataFrame:
    """One row: partitions, rows, files and bytes that a scan of the partitions ``where`` touches."""
    s = stats(spark, root, by, kind)
    s = s if where is None else s.where(where)
    return s.agg(F.count("*").alias("partitions"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "files", "bytes")])


def require_scan_cost(spark: SparkSession, root: str, max_bytes: int, where: Column | None = None, by: str = "dt",
                      kind: str = "date") -> int:
    """Refuse (raise) a scan of more than ``max_bytes``, before any of it is listed or read."""
    n = scan_cost(spark, root, where, by, kind).first()["bytes"]
    if n > max_bytes:
        raise GateFailed(f"scan of {n} bytes exceeds the cap of {max_bytes}")
    return n


def latest_rows(spark: SparkSession, root: str, k: int, order: Sequence[Column] = (), by: str = "dt", kind: str = "date",
                max_scan_bytes: int | None = None) -> DataFrame:
    """The ``k`` rows of the newest partitions, within a partition by ``order``; only the partitions needed are read.

    At most ``k`` partition values reach the driver. ``max_scan_bytes`` refuses a larger scan.
    """
    newest = stats(spark, root, by, kind).where("rows > 0").orderBy(F.col(by).desc()).limit(k).collect()
    need, rows, size = [], 0, 0
    for r in newest:
        need.append(partition_folder(by, r[by]))
        rows, size = rows + r["rows"], size + r["bytes"]
        if rows >= k:
            break
    if max_scan_bytes is not None and size > max_scan_bytes:
        raise GateFailed(f"scan of {size} bytes exceeds the cap of {max_scan_bytes}")
    if not need:
        raise AnalysisException(f"{root} holds no rows")
    at = Files(spark, root)
    found = spark.read.option("basePath", at.root).parquet(*[f"{at.root}/{f}" for f in need])
    return found.withColumn(by, F.col(by).cast(kind)).orderBy(F.col(by).desc(), *order).limit(k)
