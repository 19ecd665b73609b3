"""Workload E (element-wise part): lines, word counts, flat-map, filter,
fan-out and the text sink, over every line of every ``documents`` text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.generators import volumes
from tessera.functions.text import contains, flat_map, word_count, words, yield_if
from tessera.session import shared_dir
from tessera.sinks.fanout import read_outputs, write_outputs
from tessera.sinks.files import write_text
from tessera.sources.files import read_lines
from tessera.sources.lines import LINES_SQL, document_lines
from tessera.sources.tables import table

TERM = "the"


def _lines(spark, sf_dir):
    return document_lines(table(spark, sf_dir, "documents"))


def text_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


def line_word_count(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", "line_no", word_count("line").alias("words"))


def flatmap_lines(spark, sf_dir, term=TERM):
    """FlatMap with a 0-or-1 generator, as explode of a JVM array."""
    l = _lines(spark, sf_dir)
    return l.select("doc_id", "line_no",
                    F.explode(yield_if("line", contains("line", term))).alias("line"))


def flatmap_words(spark, sf_dir):
    """FlatMap with 0..n results: every word of every line."""
    return flat_map(_lines(spark, sf_dir), words("line"), "word").select("doc_id", "line_no", "word")


def filter_contains(spark, sf_dir, term=TERM):
    return _lines(spark, sf_dir).where(contains("line", term))


def fanout_counts(spark, sf_dir, term=TERM):
    """One input feeding several outputs, computed in a single scan."""
    l = _lines(spark, sf_dir)
    hit = contains("line", term)
    return l.agg(F.count(F.lit(1)).alias("lines"),
                 F.sum(word_count("line")).alias("words"),
                 F.count_if(hit).alias("flatmap_lines"),
                 F.count_if(hit).alias("filter_lines"))


def text_sink_roundtrip(spark, sf_dir):
    out = shared_dir(spark, "lines_text")
    write_text(_lines(spark, sf_dir), out, "line")
    return read_lines(spark, out).select(F.col("value").alias("line"))


def fanout_outputs(line: str = "line", term: str = TERM) -> dict:
    """The four outputs of the line pipeline, as the elements that each line yields."""
    return {"lines": F.array(line),
            "word_counts": F.array(word_count(line).cast("string")),
            "flatmap_lines": yield_if(line, contains(line, term)),
            "filter_lines": F.filter(F.array(line), lambda x: contains(x, term))}


def fanout_sinks(spark, sf_dir, term=TERM):
    """One scan feeds four text outputs, which are read back."""
    out = shared_dir(spark, "fanout")
    write_outputs(_lines(spark, sf_dir), fanout_outputs(term=term), out)
    return read_outputs(spark, out)


#: Characters that a volume holds.
VOLUME_CHARS = 4000


def volume_items(spark, sf_dir, capacity=VOLUME_CHARS):
    """A generator with state: the documents of a source, in order, shelved in volumes."""
    d = table(spark, sf_dir, "documents")
    return volumes(d, "source", "doc_id", F.length("text"), capacity)


QUERIES = {
    "fanout_sinks": fanout_sinks,
    "volume_items": volume_items,
    "text_lines": text_lines,
    "line_word_count": line_word_count,
    "flatmap_lines": flatmap_lines,
    "flatmap_words": flatmap_words,
    "filter_contains": filter_contains,
    "fanout_counts": fanout_counts,
    "text_sink_roundtrip": text_sink_roundtrip,
}

WL = "WITH " + LINES_SQL
_WORDS = r"len(regexp_extract_all(line, '[^\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}]+'))"

ORACLE = {
    "text_lines": WL + "SELECT doc_id, line_no, line FROM lines",
    "line_word_count": WL + f"SELECT doc_id, line_no, {_WORDS} AS words FROM lines",
    "flatmap_lines": WL + f"SELECT doc_id, line_no, line FROM lines WHERE contains(line, '{TERM}')",
    "flatmap_words": WL + f"SELECT doc_id, line_no, unnest({_WORDS[4:-1]}) AS word FROM lines",
    "filter_contains": WL + f"SELECT doc_id, line_no, line FROM lines WHERE contains(line, '{TERM}')",
    "fanout_counts": WL + f"""SELECT COUNT(*) AS lines, CAST(SUM({_WORDS}) AS BIGINT) AS words,
       COUNT(*) FILTER (WHERE contains(line, '{TERM}')) AS flatmap_lines,
       COUNT(*) FILTER (WHERE contains(line, '{TERM}')) AS filter_lines FROM lines""",
    "text_sink_roundtrip": WL + "SELECT line FROM lines",
    "fanout_sinks": WL + f"""SELECT 'lines' AS output, line AS value FROM lines
UNION ALL SELECT 'word_counts', CAST({_WORDS} AS VARCHAR) FROM lines
UNION ALL SELECT o.name, line FROM lines, (VALUES ('flatmap_lines'), ('filter_lines')) AS o(name)
WHERE contains(line, '{TERM}')""",
    "volume_items": f"""
WITH RECURSIVE items AS (
  SELECT source, CAST(floor(doc_id / 1024) AS BIGINT) AS part, doc_id, length(text) AS n,
         row_number() OVER (PARTITION BY source, floor(doc_id / 1024) ORDER BY doc_id, length(text)) AS k
  FROM documents WHERE length(text) > 0),
-- The volume that is open before item k, how full it is, and whether the item shares it.
placed AS (
  SELECT source, part, doc_id, n, k, CAST(0 AS BIGINT) AS first, CAST(0 AS BIGINT) AS shared,
         CAST((n - 1) // {VOLUME_CHARS} AS BIGINT) AS last, CAST((n - 1) % {VOLUME_CHARS} + 1 AS BIGINT) AS used
  FROM items WHERE k = 1
  UNION ALL
  SELECT i.source, i.part, i.doc_id, i.n, i.k,
         CASE WHEN p.used + i.n <= {VOLUME_CHARS} THEN p.last ELSE p.last + 1 END,
         CASE WHEN p.used + i.n <= {VOLUME_CHARS} THEN p.used ELSE 0 END,
         CASE WHEN p.used + i.n <= {VOLUME_CHARS} THEN p.last ELSE p.last + 1 + (i.n - 1) // {VOLUME_CHARS} END,
         CASE WHEN p.used + i.n <= {VOLUME_CHARS} THEN p.used + i.n ELSE (i.n - 1) % {VOLUME_CHARS} + 1 END
  FROM placed p JOIN items i ON i.source IS NOT DISTINCT FROM p.source AND i.part IS NOT DISTINCT FROM p.part AND i.k = p.k + 1)
SELECT source, part, doc_id, first + j AS volume, j * {VOLUME_CHARS} AS start,
       CAST(least({VOLUME_CHARS}, n - j * {VOLUME_CHARS}) AS BIGINT) AS length, CASE WHEN j = 0 THEN shared ELSE 0 END AS "offset"
FROM (SELECT *, unnest(range(0, (n - 1) // {VOLUME_CHARS} + 1)) AS j FROM placed)""",
}
