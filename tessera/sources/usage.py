"""Warehouse-usage and billing relations derived from the driver tables.

* ``jobs``            one job per ``events`` row (user, type, bytes, slots,
                      query text, referenced tables as ARRAY<STRUCT>).
* ``access_log``      one query job per ``lineitem`` row referencing a part table.
* ``catalog_tables``  one table per ``part`` row.
* ``table_storage``   storage figures per ``part`` row.
* ``views``           one view per ``documents`` row (whole text as definition).
* ``billing_export``  one cost line per ``lineitem`` row, nested SKU/service.

Every builder is a projection (plus the one lineitem-part join for billing), so
the relations grow with the tables and keep Parquet pruning/pushdown.
Each relation also has its DuckDB text (``*_SQL``) for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed points in time of the driver data, used as ``as_of`` of look-backs.
LINEITEM_AS_OF = "2001-12-31 00:00:00"
BILLING_AS_OF = "2001-11-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
PROJECT = "proj"



# ---------------------------------------------------------------- jobs

def jobs(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    cents = F.round(F.col("value") * 100).cast("bigint")
    ds = F.concat(F.lit("ds"), (F.col("user_id") % 5).cast("string"))
    ref = F.struct(F.lit(PROJECT).alias("project_id"), ds.alias("dataset_id"),
                   F.concat(F.lit("t"), k).alias("table_id"))
    ref2 = F.struct(F.lit(PROJECT).alias("project_id"), F.lit("ds0").alias("dataset_id"),
                    F.lit("orders").alias("table_id"))
    return events.select(
        F.concat(F.lit("job_"), F.col("event_id").cast("string")).alias("job_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("user_email"),
        F.when(et.isin("view", "click", "purchase"), F.lit("QUERY"))
         .when(et == "signup", F.lit("LOAD")).otherwise(F.lit("EXTRACT")).alias("job_type"),
        F.when(et.isin("view", "click"), F.lit("SELECT"))
         .when(et == "purchase", F.lit("INSERT")).alias("statement_type"),
        F.when(F.col("value") < 2, F.lit("PENDING")).otherwise(F.lit("DONE")).alias("state"),
        F.when(et == "view", F.concat(F.lit("SELECT * FROM "), ds, F.lit(".t"), k))
         .otherwise(F.concat(F.lit("SELECT k FROM "), ds, F.lit(".t"), k,
                             F.lit(" WHERE k = "), k)).alias("query"),
        F.col("ts").alias("creation_time"),
        (cents * 10000).alias("total_bytes_processed"),
        F.when(et == "error", F.lit(0).cast("bigint")).otherwise(cents * 37).alias("total_slot_ms"),
        F.when(et == "purchase", F.array(ref, ref2))
         .when(et.isin("view", "click"), F.array(ref))
         .otherwise(F.array().cast(
             "array<struct<project_id:string,dataset_id:string,table_id:string>>"))
         .alias("referenced_tables"),
    )


JOBS_SQL = f"""
jobs AS (
SELECT 'job_' || event_id AS job_id,
       'user' || user_id || '@example.com' AS user_email,
       CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'QUERY'
            WHEN event_type = 'signup' THEN 'LOAD' ELSE 'EXTRACT' END AS job_type,
       CASE WHEN event_type IN ('view', 'click') THEN 'SELECT'
            WHEN event_type = 'purchase' THEN 'INSERT' END AS statement_type,
       CASE WHEN value < 2 THEN 'PENDING' ELSE 'DONE' END AS state,
       CASE WHEN event_type = 'view'
            THEN 'SELECT * FROM ds' || (user_id % 5) || '.t' || json_extract_string(props, '$.k')
            ELSE 'SELECT k FROM ds' || (user_id % 5) || '.t' || json_extract_string(props, '$.k')
                 || ' WHERE k = ' || json_extract_string(props, '$.k') END AS query,
       ts AS creation_time,
       CAST(round(value * 100) AS BIGINT) * 10000 AS total_bytes_processed,
       CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT)
            ELSE CAST(round(value * 100) AS BIGINT) * 37 END AS total_slot_ms,
       CASE WHEN event_type = 'purchase'
              THEN [{{'project_id': '{PROJECT}', 'dataset_id': 'ds' || (user_id % 5),
                      'table_id': 't' || json_extract_string(props, '$.k')}},
                    {{'project_id': '{PROJECT}', 'dataset_id': 'ds0', 'table_id': 'orders'}}]
            WHEN event_type IN ('view', 'click')
              THEN [{{'project_id': '{PROJECT}', 'dataset_id': 'ds' || (user_id % 5),
                      'table_id': 't' || json_extract_string(props, '$.k')}}]
            ELSE [] END AS referenced_tables
FROM events)
"""

# ------------------------------------------------- access log and catalog

def access_log(lineitem: DataFrame) -> DataFrame:
    """Query jobs (one per lineitem) each referencing one part table."""
    return lineitem.select(
        F.lit(PROJECT).alias("project_id"), F.lit("tpch").alias("dataset_id"),
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("table_name"),
        F.lit("QUERY").alias("job_type"),
        F.when(F.col("l_linestatus") == "F", F.lit("DONE")).otherwise(F.lit("RUNNING")).alias("state"),
        F.col("l_shipdate").alias("creation_time"),
    )


def catalog_tables(part: DataFrame) -> DataFrame:
    return part.select(
        F.lit(PROJECT).alias("table_catalog"), F.lit("tpch").alias("table_schema"),
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_name"))


def table_storage(part: DataFrame) -> DataFrame:
    size = (F.col("p_size") - 1).cast("bigint")
    return part.select(
        F.col("p_brand").alias("table_schema"),
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_name"),
        (size * 1000000).alias("total_logical_bytes"),
        (F.round(F.col("p_retailprice") * 100).cast("bigint") * 100).alias("total_physical_bytes"),
        (size * 600000).alias("active_logical_bytes"),
        (size * 400000).alias("long_term_logical_bytes"),
    )


STORAGE_SQL = """
table_storage AS (
SELECT p_brand AS table_schema, 'part_' || p_partkey AS table_name,
       CAST(p_size - 1 AS BIGINT) * 1000000 AS total_logical_bytes,
       CAST(round(p_retailprice * 100) AS BIGINT) * 100 AS total_physical_bytes,
       CAST(p_size - 1 AS BIGINT) * 600000 AS active_logical_bytes,
       CAST(p_size - 1 AS BIGINT) * 400000 AS long_term_logical_bytes
FROM part)
"""


def views(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("source").alias("table_schema"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("table_name"),
        F.col("text").alias("view_definition"))


VIEWS_SQL = """
views AS (
SELECT source AS table_schema, 'doc_' || doc_id AS table_name, text AS view_definition
FROM documents)
"""

# -------------------------------------------------------------- billing

def sku_description(p_type, p_name):
    """SKU text of a part line: a product family word per part type."""
    t, n = F.col(p_type), F.col(p_name)
    # Part type -> SKU family of the synthetic billing export.
    return (F.when(t == "MEDIUM", F.concat(F.lit("Analysis "), n))
             .when(t == "STANDARD", F.concat(F.lit("Active Storage "), n))
             .when(t == "LARGE", F.concat(F.lit("Streaming Insert "), n))
             .when(t == "PROMO", F.concat(F.lit("Load Job "), n))
             .when(t == "SMALL", F.concat(F.lit("Copy "), n))
             .otherwise(n))


SKU_SQL = """CASE p_type WHEN 'MEDIUM' THEN 'Analysis ' || p_name
       WHEN 'STANDARD' THEN 'Active Storage ' || p_name
       WHEN 'LARGE' THEN 'Streaming Insert ' || p_name
       WHEN 'PROMO' THEN 'Load Job ' || p_name
       WHEN 'SMALL' THEN 'Copy ' || p_name ELSE p_name END"""


def service_description(returnflag):
    return (F.when(F.col(returnflag) == "N", F.lit("Query Engine"))
             .otherwise(F.lit("Object Storage")))


SERVICE_SQL = "CASE WHEN l_returnflag = 'N' THEN 'Query Engine' ELSE 'Object Storage' END"


def billing_export(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Cost lines with nested ``sku`` and ``service`` records."""
    j = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    return j.select(
        F.col("l_extendedprice").alias("cost"),
        F.struct(sku_description("p_type", "p_name").alias("description")).alias("sku"),
        F.struct(service_description("l_returnflag").alias("description")).alias("service"),
        F.col("l_shipdate").alias("usage_start_time"),
        F.col("l_orderkey").alias("line_order"), F.col("l_linenumber").alias("line_number"),
    )
