"""Lines of the ``documents`` texts: one row per line, whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip_cr


def document_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) for every line of every text (split on LF,
    trailing CR dropped); a narrow generator, no shuffle."""
    x = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return x.select("doc_id", "line_no", strip_cr("line").alias("line"))


LINES_SQL = r"""
lines AS (
SELECT doc_id, line_no, regexp_replace(line, '\r$', '') AS line
FROM (SELECT doc_id,
             CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no,
             unnest(string_split(text, chr(10))) AS line
      FROM documents))
"""
