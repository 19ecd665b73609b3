"""Exact distinct counts that can be merged: bitmaps over dictionary numbers, stored by day (A1 over look-back windows).

Items get dense numbers once. Each day stores, for each group, the bitmaps of the items it saw, cut into buckets of
32,768 numbers. The distinct items of any window of days are the bits of the merged bitmaps: transactions
are not read again, and the state grows with days and items, not with transactions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

#: Parts in which items are numbered.
NUMBERED_PARTS = 1024


def number_items(df: DataFrame, item: str, parts: int = NUMBERED_PARTS) -> DataFrame:
    """``item, number``: the distinct items, numbered densely from 0, in parts that are each one task's work.

    Parts are cut by hash; their sizes are added up to know where each begins. Null is not an item.
    """
    items = df.select(F.col(item).alias("item")).where("item IS NOT NULL").distinct().withColumn(
        "part", F.pmod(F.xxhash64("item"), F.lit(parts)))
    sizes = items.groupBy("part").agg(F.count("*").alias("n"))
    # One row for each part.
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("item"))
    return items.withColumn("place", place).join(F.broadcast(starts), "part").select(
        F.col("item").alias(item), (F.col("start") + F.col("place") - 1).alias("number"))


def daily_bitmaps(df: DataFrame, day: str, groups: Sequence[str], number: str) -> DataFrame:
    """``day, groups, bucket, bits``: the numbers seen each day, combined before the exchange."""
    n = F.col(number)
    return df.where(n.isNotNull()).groupBy(F.col(day).alias("day"), *groups, F.bitmap_bucket_number(n).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits"))


def distinct_in_windows(daily: DataFrame, as_of: DataFrame, windows: Sequence[int], groups: Sequence[str]) -> DataFrame:
    """``as_of, days, groups, items``: distinct items of the last ``days`` days up to each ``as_of`` (a column of dates).

    Each day is sent to the dates whose windows it lies in, and bitmaps are merged before the exchange.
    """
    longest = max(windows)
    # A date has a window of ``longest`` days: an equality join on the days it holds.
    holds = (as_of.select("as_of").distinct()
             .withColumn("day", F.explode(F.expr(f"sequence(date_sub(as_of, {longest - 1}), as_of)")))
             .withColumn("days", F.explode(F.array(*[F.lit(w) for w in windows]))).where(F.datediff("as_of", "day") < F.col("days")))
    merged = daily.join(holds, "day").groupBy("as_of", "days", *groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("as_of", "days", *groups).agg(F.sum(F.bitmap_count("bits")).alias("items"))
