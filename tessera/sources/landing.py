"""Landed inputs for the ingest workloads, derived from ``events``.

* ``log_envelopes``: one message envelope per event. Even event ids carry the
  payload in ``data``, odd ones in ``message.data``; the payload is base64 of
  the event's ``props`` JSON, except for ids = 0 (mod 50): not base64, = 10:
  base64 of a truncated JSON text, = 20: no payload at all.
* ``api_documents``: one JSON document line per event: purchase events carry
  an ``items`` list, others omit it; error events land as a malformed line.

Both are written by Spark to a folder under the shared checkpoint dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

ENVELOPE_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("publish_time", TimestampNTZType()),
    StructField("data", StringType()),
    StructField("message", StructType([StructField("data", StringType())])),
])

API_DOC_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("user_id", LongType()),
    StructField("kind", StringType()),
    StructField("items", ArrayType(IntegerType())),
])


def log_envelopes(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    props = F.col("props")
    payload = (F.when(eid % 50 == 0, F.lit("###"))
                .when(eid % 50 == 10, F.base64(F.encode(F.substring(props, 1, 3), "UTF-8")))
                .when(eid % 50 == 20, F.lit(None).cast("string"))
                .otherwise(F.base64(F.encode(props, "UTF-8"))))
    in_data = eid % 2 == 0
    return events.select(
        eid, F.col("ts").alias("publish_time"),
        F.when(in_data, payload).alias("data"),
        F.when(~in_data, F.struct(payload.alias("data"))).alias("message"))


def api_document_lines(events: DataFrame) -> DataFrame:
    """``value`` = one JSON text line per event (malformed for errors)."""
    k = F.get_json_object("props", "$.k").cast("int")
    doc = F.struct(
        F.col("event_id"), F.col("user_id"), F.col("event_type").alias("kind"),
        F.when(F.col("event_type") == "purchase", F.array(k, k + 1)).alias("items"))
    broken = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "user_id"'))
    return events.select(
        F.when(F.col("event_type") == "error", broken).otherwise(F.to_json(doc)).alias("value"))


# Expected decoded rows in DuckDB SQL (for the oracles).
ENVELOPE_EXPECTED_SQL = """
env AS (
  SELECT event_id, ts AS publish_time, props,
         CASE WHEN event_id % 50 = 0 THEN '###'
              WHEN event_id % 50 = 10 THEN to_base64(encode(substr(props, 1, 3)))
              WHEN event_id % 50 = 20 THEN NULL
              ELSE to_base64(encode(props)) END AS b64
  FROM events),
decoded AS (
  SELECT event_id, publish_time, b64,
         try(decode(try(from_base64(b64)))) AS payload,
         try(from_base64(b64)) AS raw
  FROM env),
checked AS (
  SELECT event_id, publish_time, payload,
         CASE WHEN b64 IS NULL THEN 'no data'
              WHEN raw IS NULL THEN 'bad base64'
              WHEN payload IS NULL THEN 'bad utf8'
              WHEN NOT json_valid(payload) THEN 'bad json' END AS reject_reason
  FROM decoded)
"""

API_DOCS_EXPECTED_SQL = """
docs AS (
  SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS event_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind,
         CASE WHEN event_type = 'purchase'
              THEN [CAST(json_extract_string(props, '$.k') AS INTEGER),
                    CAST(json_extract_string(props, '$.k') AS INTEGER) + 1] END AS items,
         event_type = 'error' AS is_corrupt
  FROM events)
"""
