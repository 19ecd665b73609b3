"""Data-quality gates and contracts (Q1-Q5).

Gates bring at most one row, or one aggregate row, to the driver; the data
itself is checked by Spark aggregates, never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class GateFailed(AssertionError):
    pass


def require_truthy(df: DataFrame, what: str = "check") -> DataFrame:
    """Fail unless the first result row exists and every cell is truthy."""
    rows = df.limit(1).collect()
    if not rows:
        raise GateFailed(f"{what}: no row returned")
    bad = [k for k, v in rows[0].asDict().items() if not v]
    if bad:
        raise GateFailed(f"{what}: falsy value in {bad}")
    return df


def require_nonempty(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail when ``df`` has no row (reads at most one row)."""
    if not df.limit(1).collect():
        raise GateFailed(f"{what}: empty")
    return df


def require_positive_total(df: DataFrame, col: str, what: str = "items") -> DataFrame:
    """Fail when the total of a count column (never negative) is zero: the
    first positive row settles it, so the rest is not read."""
    if df.where(F.col(col) > 0).limit(1).isEmpty():
        raise GateFailed(f"{what}: total is 0")
    return df


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, ``length`` and partition columns of a dataset's data files, from
    the listing alone: the content column is not asked for, so none is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .load(root).drop("content", "modificationTime"))


def scanned_bytes(spark: SparkSession, root: str, where=None) -> DataFrame:
    """Files and bytes that a scan of ``root`` touches; ``where`` filters on partition columns."""
    files = data_files(spark, root)
    if where is not None:
        files = files.where(where)
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("scanned_bytes"))


def require_scan_under(spark: SparkSession, root: str, max_bytes: int, where=None) -> int:
    """Refuse (raise) when a scan of ``root`` would read more than max_bytes."""
    n = scanned_bytes(spark, root, where).first()["scanned_bytes"]
    if n > max_bytes:
        raise GateFailed(f"scan of {n} bytes exceeds the cap of {max_bytes}")
    return n


def enforce_schema(df: DataFrame, contract: StructType, inline: bool = False) -> DataFrame:
    """Check names and types against ``contract`` and that REQUIRED
    (non-nullable) columns hold no NULL; return ``df`` in contract order.

    ``inline=True`` checks the NULLs while the result is produced (a
    ``raise_error`` in the projection fails the writing job before its
    commit) instead of running a separate aggregate pass first.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in contract.fields if f.name not in have]
    if missing:
        raise GateFailed(f"missing columns {missing}")
    wrong = [f.name for f in contract.fields if have[f.name] != f.dataType]
    if wrong:
        raise GateFailed(f"type mismatch in {wrong}")
    required = [f.name for f in contract.fields if not f.nullable]
    if inline:
        return df.select(*[
            (F.when(F.col(f.name).isNull(),
                    F.raise_error(F.lit(f"NULL in required column {f.name}")))
              .otherwise(F.col(f.name)) if f.name in required else F.col(f.name)).alias(f.name)
            for f in contract.fields])
    out = df.select(*[f.name for f in contract.fields])
    if required:
        nulls = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
        bad = [c for c in required if nulls[c]]
        if bad:
            raise GateFailed(f"NULL in required columns {bad}")
    return out
