"""Sorting and top-k (O1-O7).

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps its
own k best rows and only those reach the final merge, so no full sort or
shuffle of the input happens. Always add a unique tie-break for stable output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.quality import data_files, require_scan_under


def _desc(c) -> Column:
    return F.col(c).desc() if isinstance(c, str) else c


def top_k(df: DataFrame, by: Sequence, k: int, tiebreak: Sequence = ()) -> DataFrame:
    """First ``k`` rows by ``by`` (names sort DESC) then ``tiebreak`` (ASC)."""
    spec = [_desc(c) for c in by] + [F.col(c).asc() if isinstance(c, str) else c
                                     for c in tiebreak]
    return df.orderBy(*spec).limit(k)


def sort_report(df: DataFrame, *cols) -> DataFrame:
    """Global sort for a report (range exchange + per-partition sort)."""
    return df.orderBy(*cols)


def latest_partitions(spark: SparkSession, root: str, partition_col: str, k: int,
                      order: Sequence = (), tiebreak: Sequence = (),
                      max_scan_bytes: int | None = None) -> DataFrame:
    """Latest ``k`` rows by partition value, reading only needed partitions.

    Sort + limit alone does not prune partitions. A file holds at least one row
    as a rule, so the newest partitions with ``k`` files between them, known
    from the file listing, suffice; their rows are counted from the file footers
    and, should files be empty, older partitions are added. The top-k is then
    one pass over those partitions. A caller's ``max_scan_bytes`` refuses a scan
    whose files exceed it, before rows are read.
    """
    pc = F.col(partition_col)
    rows = spark.read.parquet(root)
    by_value = data_files(spark, root).where(pc.isNotNull()).groupBy(partition_col).agg(F.count("*").alias("files"))
    need, pruned, where = k, rows, None
    while True:
        # At most ``need`` values reach the driver.
        newest = by_value.orderBy(pc.desc()).limit(need).collect()
        files, cutoff = 0, None
        for value, n in newest:
            files, cutoff = files + n, value
            if files >= need:
                break
        if cutoff is None or files < need and len(newest) < need:
            break  # all partitions, with those without a value (sorted last)
        where = pc >= F.lit(cutoff)
        pruned = rows.where(where)
        if pruned.count() >= k:
            break
        need, pruned, where = need * 2, rows, None
    if max_scan_bytes is not None:
        require_scan_under(spark, root, max_scan_bytes, where)
    spec = [pc.desc()] + [_desc(c) for c in order]
    spec += [F.col(c).asc() if isinstance(c, str) else c for c in tiebreak]
    return pruned.orderBy(*spec).limit(k)
