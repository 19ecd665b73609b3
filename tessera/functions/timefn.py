"""Time expressions: look-back windows and derived calendar fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_of_literal(as_of) -> Column:
    """A fixed instant (string or datetime) or, when None, the query start
    time as a wall-clock TIMESTAMP_NTZ in the session time zone (UTC), the
    type of the event-time columns."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def lookback(ts, as_of, interval: str) -> Column:
    """``ts BETWEEN as_of - INTERVAL <interval> AND as_of`` (both ends inclusive).

    The bounds are constants, so Catalyst folds them and pushes the range to
    the Parquet scan.
    """
    end = as_of_literal(as_of)
    return _c(ts).between(end - F.expr(f"INTERVAL {interval}"), end)


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_name(ts) -> Column:
    """Full English day name (Monday ... Sunday)."""
    return F.date_format(_c(ts), "EEEE")


def is_weekend(ts) -> Column:
    """Saturday or Sunday (weekday() counts Monday as 0)."""
    return F.weekday(_c(ts)) >= 5


def partition_day(ts) -> Column:
    """Partition value for dated folders: ``dt=yyyy-MM-dd`` (no slashes)."""
    return F.to_date(_c(ts))
