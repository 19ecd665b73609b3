"""Generators: table functions that yield 0..n rows for each input row and keep state between rows (FlatMap).

Where an array expression can say what a row yields, ``functions.text.flat_map`` stays in the JVM. A generator that
must remember earlier rows is a Python table function with a partitioned table argument: Spark deals the rows
by the partition columns, sorts each partition, and streams it through one instance of the generator, rows and results
in Arrow batches. ``analyze`` declares the columns, the partitioning and the order, so callers only hand over a table.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


class Volumes:
    """Items of known sizes, in order, put on the shelves of volumes that hold ``capacity`` each.

    An item goes to the open volume if it still fits; else to a new one. An item larger than a volume
    is cut over as many new ones as it needs, and the last of them stays open. Items without a size
    (null or zero) yield no row. One instance serves one shelf; its state is the open volume.
    """

    def __init__(self):
        self.volume, self.used = 0, 0

    @staticmethod
    def analyze(items: AnalyzeArgument, capacity: AnalyzeArgument) -> AnalyzeResult:
        if not items.isTable:
            raise ValueError("volumes: the first argument is a table")
        fields = {f.name: f for f in items.dataType.fields}
        missing = [c for c in ("shelf", "part", "id", "size") if c not in fields]
        if missing:
            raise ValueError(f"volumes: columns {missing} are missing")
        if not isinstance(fields["size"].dataType, IntegralType):
            raise ValueError("volumes: sizes are whole numbers")
        if not capacity.isConstantExpression or not capacity.value or capacity.value < 1:
            raise ValueError("volumes: the capacity is a constant of at least 1")
        return AnalyzeResult(
            StructType([fields["shelf"], fields["part"], fields["id"],
                        *(StructField(c, LongType(), False) for c in ("volume", "start", "length", "offset"))]),
            partitionBy=[PartitioningColumn("shelf"), PartitioningColumn("part")],
            orderBy=[OrderingColumn("id"), OrderingColumn("size")])

    def eval(self, item: Row, capacity: int) -> Iterator[tuple]:
        size = item["size"] or 0
        start = 0
        while start < size:
            left = size - start
            # A whole item may share a volume; the pieces of a cut one begin new volumes.
            if self.used and (start or left > capacity - self.used):
                self.volume, self.used = self.volume + 1, 0
            length = min(left, capacity)
            yield item["shelf"], item["part"], item["id"], self.volume, start, length, self.used
            self.used += length
            start += length


#: Ids of one part of a shelf: what one generator reads is bounded, however large a shelf is.
PART_IDS = 1024


def volumes(df: DataFrame, shelf: str, item: str, size, capacity: int, part_ids: int = PART_IDS) -> DataFrame:
    """Rows ``shelf, part, item, volume, start, length, offset`` of the items of ``df``.

    Shelves are cut into parts of ``part_ids`` consecutive whole-number ids, each with volumes of its own, so that
    a shelf with a third of all items is not one task's work. Null ids form a part.
    """
    items = df.select(F.col(shelf).alias("shelf"), F.expr(f"floor(`{item}` / {part_ids})").alias("part"),
                      F.col(item).alias("id"), (F.col(size) if isinstance(size, str) else size).cast("long").alias("size"))
    generate = F.udtf(Volumes, useArrow=True)
    return (generate(items.asTable(), F.lit(capacity))
            .withColumnRenamed("shelf", shelf).withColumnRenamed("id", item))
