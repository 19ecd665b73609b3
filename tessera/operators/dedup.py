"""Latest-row deduplication (W1): QUALIFY ROW_NUMBER() ... = 1.

Spark has no QUALIFY, so this is row_number over a key window followed by a
filter on 1. Catalyst rewrites that pattern into ``WindowGroupLimit``: a
partial top-1 per key runs inside each map task before the shuffle, so a key
holding a third of all rows ships at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(c) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence,
                 tiebreak: Sequence = ()) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (string names mean
    DESC NULLS LAST), ties broken by ``tiebreak`` (ascending unless given as a
    Column). Always pass a unique tie-break for a deterministic result."""
    spec = [_order(c) for c in order]
    spec += [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*spec)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)
