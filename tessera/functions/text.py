"""Line and word expressions (element-wise Map / Filter / FlatMap bodies)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a maximal run of characters outside Python's str.split()
# whitespace: ASCII whitespace, the separators U+001C-U+001F, U+0085 and
# every Unicode separator (category Z). Spelled out so the set does not
# depend on an engine's idea of \s.
WORD_PATTERN = r"([^\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}]+)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def word_count(col) -> Column:
    """len(line.split()) as a JVM expression; NULL line -> NULL. (Spark counts
    the elements of the extracted word list of each line.)"""
    return F.regexp_count(_c(col), F.lit(WORD_PATTERN)).cast("bigint")


def strip_cr(col) -> Column:
    """Drop one trailing carriage return, as a line reader does for CRLF."""
    return F.regexp_replace(_c(col), r"\r$", "")


def contains(col, needle: str) -> Column:
    """Case-sensitive substring test (``needle in line``)."""
    return F.contains(_c(col), F.lit(needle))


def flat_map(df: DataFrame, elements: Column, out: str) -> DataFrame:
    """FlatMap: one row for each of the 0..n elements that a row yields (an array expression)."""
    return df.withColumn(out, F.explode(elements))


def words(col) -> Column:
    """The words of a line, in order (as ``word_count`` counts them)."""
    return F.regexp_extract_all(_c(col), F.lit(WORD_PATTERN), F.lit(1))


def yield_if(col, pred: Column, element_type: str = "string") -> Column:
    """Array of 0 or 1 elements: the generator body ``if pred: yield value``.

    ``explode`` of this array is a FlatMap that stays a narrow JVM operator.
    """
    c = _c(col)
    return F.when(pred, F.array(c)).otherwise(F.array().cast(f"array<{element_type}>"))
