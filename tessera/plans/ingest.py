"""Workload F: event and API-document ingest (batch and streaming)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.envelope import decode_envelope as decode, items_count as n_items, pretty_json
from tessera.functions.envelope import split_valid
from tessera.operators.quality import require_positive_total
from tessera.session import shared_dir
from tessera.sinks.files import TS_FORMATS, write_json, write_text
from tessera.sources.files import CORRUPT, read_documents, read_json
from tessera.sources.landing import (API_DOC_SCHEMA, API_DOCS_EXPECTED_SQL,
                                     ENVELOPE_EXPECTED_SQL, ENVELOPE_SCHEMA, api_document_lines,
                                     log_envelopes)
from tessera.sources.tables import table
from tessera.streaming.append_ingest import ingest_append
from tessera.streaming.compaction import compact, read_log, vacuum
from tessera.streaming.log_ingest import ingest_logs


def _envelopes(spark, sf_dir):
    return log_envelopes(table(spark, sf_dir, "events"))


def decode_envelope(spark, sf_dir):
    good, _ = split_valid(decode(_envelopes(spark, sf_dir)))
    return good.select("event_id", "publish_time", "payload")


def reject_split(spark, sf_dir):
    _, bad = split_valid(decode(_envelopes(spark, sf_dir)))
    return bad.select("event_id", "reject_reason")


def _land_envelopes(spark, sf_dir) -> str:
    landing = shared_dir(spark, "envelopes")
    write_json(_envelopes(spark, sf_dir), landing)
    return landing


def _land_api_docs(spark, sf_dir) -> str:
    landing = shared_dir(spark, "api_docs")
    write_text(api_document_lines(table(spark, sf_dir, "events")), landing)
    return landing


def stream_log_ingest(spark, sf_dir):
    landing = _land_envelopes(spark, sf_dir)
    out, ckpt = shared_dir(spark, "job_log"), shared_dir(spark, "job_log_ckpt")
    ingest_logs(spark, landing, out, ckpt)
    schema = "event_id BIGINT, publish_time TIMESTAMP_NTZ, payload STRING, dt DATE"
    return read_json(spark, out, schema).select("event_id", "publish_time", "payload", "dt")


LOG_SCHEMA = "event_id BIGINT, publish_time TIMESTAMP_NTZ, payload STRING"


def stream_log_compacted(spark, sf_dir, closed_before="2024-01-20"):
    """The log ingested in two parts of several batches each, its closed days compacted after each part."""
    landing = _land_envelopes(spark, sf_dir)
    more = spark.read.schema(ENVELOPE_SCHEMA).options(**TS_FORMATS).json(landing)
    out, ckpt, parts = shared_dir(spark, "job_log"), shared_dir(spark, "job_log_ckpt"), shared_dir(spark, "envelope_parts")
    for part in (0, 1):
        # Files of two batches land, then the closed days are rewritten.
        write_json(more.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part).repartition(2), parts, mode="append")
        ingest_logs(spark, parts, out, ckpt, max_files_per_batch=1)
        compact(spark, out, LOG_SCHEMA, closed_before, key="event_id")
        vacuum(spark, out)
    return read_log(spark, out, LOG_SCHEMA)


def stream_append_ingest(spark, sf_dir):
    landing = _land_api_docs(spark, sf_dir)
    out, rej = shared_dir(spark, "api_table"), shared_dir(spark, "api_rejects")
    ingest_append(spark, landing, out, rej, shared_dir(spark, "api_ckpt"))
    return spark.read.parquet(out).select("event_id", "user_id", "kind", "items")


def json_extract(spark, sf_dir):
    docs = read_documents(spark, _land_api_docs(spark, sf_dir), API_DOC_SCHEMA)
    return docs.select("event_id", "user_id", "kind", "items",
                       F.col(CORRUPT).isNotNull().alias("is_corrupt"))


def items_count(spark, sf_dir):
    docs = read_documents(spark, _land_api_docs(spark, sf_dir), API_DOC_SCHEMA)
    counted = docs.where(F.col(CORRUPT).isNull()).select(
        "event_id", n_items("items").alias("items_count"))
    return require_positive_total(counted, "items_count", "shopping items")


def pretty_documents(spark, sf_dir):
    """Each event as an indented JSON document."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", pretty_json(F.struct("event_id", "user_id", "event_type")).alias("document"))


QUERIES = {
    "decode_envelope": decode_envelope,
    "reject_split": reject_split,
    "stream_log_ingest": stream_log_ingest,
    "stream_log_compacted": stream_log_compacted,
    "stream_append_ingest": stream_append_ingest,
    "json_extract": json_extract,
    "items_count": items_count,
    "pretty_documents": pretty_documents,
}

WE = "WITH " + ENVELOPE_EXPECTED_SQL
WD = "WITH " + API_DOCS_EXPECTED_SQL

ORACLE = {
    "decode_envelope": WE + "SELECT event_id, publish_time, payload FROM checked WHERE reject_reason IS NULL",
    "reject_split": WE + "SELECT event_id, reject_reason FROM checked WHERE reject_reason IS NOT NULL",
    "stream_log_ingest": WE + """SELECT event_id, publish_time, payload, CAST(publish_time AS DATE) AS dt
FROM checked WHERE reject_reason IS NULL""",
    "stream_log_compacted": WE + """SELECT event_id, publish_time, payload, CAST(publish_time AS DATE) AS dt
FROM checked WHERE reject_reason IS NULL""",
    "stream_append_ingest": WD + "SELECT event_id, user_id, kind, items FROM docs WHERE NOT is_corrupt",
    "json_extract": WD + "SELECT event_id, user_id, kind, items, is_corrupt FROM docs",
    "pretty_documents": """
SELECT event_id, '{' || chr(10) || '  "event_id" : ' || event_id || ',' || chr(10) || '  "user_id" : ' || user_id
       || ',' || chr(10) || '  "event_type" : "' || event_type || '"' || chr(10) || '}' AS document FROM events""",
    "items_count": WD + "SELECT event_id, COALESCE(len(items), 0) AS items_count FROM docs WHERE NOT is_corrupt",
}
