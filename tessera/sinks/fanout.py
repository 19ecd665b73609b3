"""One input, several outputs, one scan (C3).

Every row is mapped to the elements that it gives each output, tagged with the output's name, and all are written by
one job to a folder for each output. The numbers of rows come from the same pass (observed metrics), so nothing is
read or computed twice, whatever the number of outputs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

TAG = "output"


def tag_outputs(df: DataFrame, outputs: Mapping[str, Column]) -> DataFrame:
    """``output, value``: one row for each element of each output's array. A null array has no elements; null elements stay."""
    def tagged(name: str, elements: Column) -> Column:
        return F.transform(F.coalesce(elements.cast("array<string>"), F.array().cast("array<string>")),
                           lambda v: F.struct(F.lit(name).alias(TAG), v.alias("value")))

    return df.select(F.explode(F.concat(*[tagged(n, c) for n, c in outputs.items()])).alias("o")).select("o.output", "o.value")


def write_outputs(df: DataFrame, outputs: Mapping[str, Column], root: str) -> dict[str, int]:
    """Write each output as lines of text below ``root/output=<name>``, all in one job, and return their rows.

    ``outputs``: name -> array of the 0..n elements that a row yields. The folders at ``root`` are replaced; an
    output without elements has none. Null elements are empty lines.
    """
    bad = [n for n in outputs if not n.replace("_", "").isalnum()]
    if bad or not outputs:
        raise ValueError(f"outputs need names of letters, digits and _: {bad}")
    seen = Observation()
    rows = tag_outputs(df, outputs).observe(
        seen, *[F.count_if(F.col(TAG) == n).alias(n) for n in outputs])
    # Rows of a task are sorted by output before they are written: one open file at a time.
    (rows.withColumn("value", F.coalesce("value", F.lit(""))).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(TAG).text(root))
    got = seen.get
    return {n: got[n] for n in outputs}


def read_outputs(spark, root: str) -> DataFrame:
    """``output, value`` of what ``write_outputs`` wrote."""
    return spark.read.schema(f"value string, {TAG} string").option("lineSep", "\n").text(root).select(TAG, "value")
