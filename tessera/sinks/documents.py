"""Whole documents as files: one indented JSON document for each run, one file each (K4, S7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.functions.envelope import pretty_json
from tessera.sinks.files import TS_FORMATS

#: Why a file is no document.
EMPTY, BAD_UTF8, DAMAGED = "empty", "bad utf8", "damaged"


def write_documents(df: DataFrame, root: str, document: Column | str, by: tuple[str, ...] = ("dt", "run_id"),
                    pretty: bool = True) -> str:
    """One file ``root/dt=.../run_id=.../part-*.json`` for each row of ``df``; ``by`` tells the rows apart.

    ``document`` is a struct (written as indented JSON) or, with ``pretty=False``, its text. What lies at
    ``root`` is replaced. Documents are dealt by their keys, so a day of many runs is written by many tasks.
    """
    text = pretty_json(document) if pretty else F.col(document) if isinstance(document, str) else document
    rows = df.select(text.alias("value"), *by)
    (rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").option("lineSep", "\n").partitionBy(*by).text(root))
    return root


def read_whole_documents(spark: SparkSession, root: str, schema: str, by: str = "dt string, run_id string") -> DataFrame:
    """One row for each file: ``path``, ``doc`` (struct of ``schema``), ``problem`` and ``raw``, with the folders' keys.

    A document may span lines. One that cannot be read keeps its place: ``doc`` is null, ``problem``
    says why (empty, bad utf8, damaged) and ``raw`` holds its text, where it is text. Files of zero bytes have no row, for Spark opens
    none of those; an empty document as ``write_documents`` writes it (a line break) has one.
    """
    files = (spark.read.format("binaryFile").schema(f"path string, modificationTime timestamp, length long, content binary, {by}")
             .option("pathGlobFilter", "part-*").load(root))
    keys = [f.strip().split()[0] for f in by.split(",")]
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    parsed = F.from_json(F.col("text"), f"{schema}, _corrupt string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", **TS_FORMATS})
    rows = files.select("path", *keys, "length", text.alias("text")).withColumn("parsed", parsed)
    blank = F.col("text").isNotNull() & (F.trim(F.regexp_replace("text", r"[\r\n\t]", " ")) == "")
    problem = (F.when((F.col("length") == 0) | blank, EMPTY).when(F.col("text").isNull(), BAD_UTF8)
               .when(F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull(), DAMAGED))
    return rows.select("path", *keys, F.when(problem.isNull(), F.col("parsed").dropFields("_corrupt")).alias("doc"),
                       problem.alias("problem"), F.when(problem.isNotNull(), F.col("text")).alias("raw"))
