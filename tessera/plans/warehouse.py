"""Workload C: warehouse usage analytics over job metadata, plus the
plain projection / filter / look-back operators they are built from.

Look-backs take ``as_of``: None is the clock; the default here is a fixed time after the driver's
events, so no pass over the data looks for their last one."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.cleansing import ratio_pct
from tessera.functions.timefn import lookback
from tessera.operators.topk import sort_report, top_k
from tessera.sources.tables import table
from tessera.sources.usage import (EVENTS_AS_OF, JOBS_SQL, LINEITEM_AS_OF, STORAGE_SQL, VIEWS_SQL,
                                   access_log, catalog_tables, jobs,
                                   table_storage, views)

EPOCH = "1970-01-01 00:00:00"


def _jobs(spark, sf_dir):
    return jobs(table(spark, sf_dir, "events"))


def usage_by_user(spark, sf_dir, as_of=EVENTS_AS_OF, k=10):
    j = _jobs(spark, sf_dir)
    recent = j.where((F.col("job_type") == "QUERY")
                     & lookback("creation_time", as_of, "7 DAYS"))
    agg = recent.groupBy("user_email").agg(
        F.sum("total_bytes_processed").alias("total_bytes_processed"),
        F.count("job_id").alias("total_queries"))
    return top_k(agg, ["total_bytes_processed"], k, tiebreak=["user_email"])


def storage_ratios(spark, sf_dir):
    s = table_storage(table(spark, sf_dir, "part"))
    out = s.select(
        "table_schema", "table_name", "total_logical_bytes", "total_physical_bytes",
        ratio_pct("total_physical_bytes", "total_logical_bytes").alias("compression_ratio"),
        "active_logical_bytes", "long_term_logical_bytes",
        # As in the source report, the long-term ratio is computed from active bytes.
        ratio_pct("active_logical_bytes", "total_logical_bytes").alias("long_term_ratio"))
    return out.orderBy(F.desc("compression_ratio"), "table_schema", "table_name")


def unfiltered_text_topk(spark, sf_dir, as_of=EVENTS_AS_OF, k=10, ignore_case=False):
    """Recent SELECT jobs whose text has no WHERE clause, by bytes."""
    j = _jobs(spark, sf_dir)
    pattern = "(?i)WHERE" if ignore_case else "WHERE"
    hits = j.where((F.col("job_type") == "QUERY") & (F.col("statement_type") == "SELECT")
                   & (F.col("total_bytes_processed") > 0)
                   & lookback("creation_time", as_of, "24 HOURS")
                   & ~F.col("query").rlike(pattern))
    top = top_k(hits, ["total_bytes_processed"], k, tiebreak=["job_id"])
    return top.select("query", "user_email", "total_bytes_processed")


def unnest_last_access(spark, sf_dir):
    """CROSS JOIN UNNEST(referenced_tables) + MAX(creation_time) per table."""
    j = _jobs(spark, sf_dir).where((F.col("job_type") == "QUERY") & (F.col("state") == "DONE"))
    rt = j.select("creation_time", F.explode("referenced_tables").alias("rt"))
    return rt.groupBy(F.col("rt.project_id").alias("project_id"),
                      F.col("rt.dataset_id").alias("dataset_id"),
                      F.col("rt.table_id").alias("table_name")).agg(
        F.max("creation_time").alias("last_access_time"))


def stale_entities(spark, sf_dir, as_of=LINEITEM_AS_OF, days=90):
    """Tables not accessed in the last ``days`` days, or never accessed."""
    keys = ["project_id", "dataset_id", "table_name"]
    # One row per part and status before names are built.
    log = access_log(table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linestatus")
                     .agg(F.max("l_shipdate").alias("l_shipdate")))
    recent = (log.where((F.col("job_type") == "QUERY") & (F.col("state") == "DONE"))
                 .groupBy(*keys).agg(F.max("creation_time").alias("last_access_time")))
    t = catalog_tables(table(spark, sf_dir, "part")).select(
        F.col("table_catalog").alias("project_id"),
        F.col("table_schema").alias("dataset_id"), "table_name")
    joined = t.join(recent, keys, "left")
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")
    stale = joined.where(F.coalesce(F.col("last_access_time"),
                                    F.lit(EPOCH).cast("timestamp_ntz")) < cutoff)
    return stale.orderBy(F.asc_nulls_first("last_access_time"), *keys)


def resource_by_job(spark, sf_dir, as_of=EVENTS_AS_OF):
    j = _jobs(spark, sf_dir)
    hits = j.where(lookback("creation_time", as_of, "1 HOUR") & (F.col("total_slot_ms") > 0))
    return hits.select("creation_time", "job_id", "user_email", "total_slot_ms").orderBy(
        F.desc("total_slot_ms"), "job_id")


def view_report(spark, sf_dir):
    v = views(table(spark, sf_dir, "documents"))
    return sort_report(v.select("table_schema", "table_name", "view_definition"),
                       "table_schema", "table_name")


def lookback_usage(spark, sf_dir, as_of=EVENTS_AS_OF):
    """Jobs and bytes per job type over the last 30 days."""
    j = _jobs(spark, sf_dir).where(lookback("creation_time", as_of, "30 DAYS"))
    return j.groupBy("job_type").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum("total_bytes_processed").alias("total_bytes_processed"))


def filter_eq_and(spark, sf_dir):
    j = _jobs(spark, sf_dir)
    return j.where((F.col("job_type") == "QUERY") & (F.col("statement_type") == "SELECT")).select(
        "job_id", "user_email", "creation_time")


def project_alias(spark, sf_dir):
    j = _jobs(spark, sf_dir)
    return j.select(F.col("job_id"), F.col("user_email").alias("user"),
                    F.col("creation_time").alias("created_at"),
                    F.col("total_bytes_processed").alias("bytes"))


QUERIES = {
    "usage_by_user": usage_by_user,
    "storage_ratios": storage_ratios,
    "unfiltered_text_topk": unfiltered_text_topk,
    "unnest_last_access": unnest_last_access,
    "stale_entities": stale_entities,
    "resource_by_job": resource_by_job,
    "view_report": view_report,
    "lookback_usage": lookback_usage,
    "filter_eq_and": filter_eq_and,
    "project_alias": project_alias,
}


def _ratio_sql(part, total):
    x = f"CAST({part} AS DOUBLE) / {total}"
    return (f"(CASE WHEN {total} = 0 THEN 0.0 ELSE "
            f"1.0 - sign({x}) * floor(abs({x}) * 100 + 0.5) / 100 END) * 100.0")


_EV = f"TIMESTAMP '{EVENTS_AS_OF}'"
WJ = "WITH " + JOBS_SQL

ORACLE = {
    "usage_by_user": WJ + f"""
SELECT user_email, CAST(SUM(total_bytes_processed) AS BIGINT) AS total_bytes_processed,
       COUNT(job_id) AS total_queries
FROM jobs
WHERE job_type = 'QUERY' AND creation_time BETWEEN {_EV} - INTERVAL 7 DAY AND {_EV}
GROUP BY user_email ORDER BY total_bytes_processed DESC, user_email LIMIT 10""",
    "storage_ratios": "WITH " + STORAGE_SQL + f"""
SELECT table_schema, table_name, total_logical_bytes, total_physical_bytes,
       {_ratio_sql('total_physical_bytes', 'total_logical_bytes')} AS compression_ratio,
       active_logical_bytes, long_term_logical_bytes,
       {_ratio_sql('active_logical_bytes', 'total_logical_bytes')} AS long_term_ratio
FROM table_storage ORDER BY compression_ratio DESC""",
    "unfiltered_text_topk": WJ + f"""
SELECT query, user_email, total_bytes_processed FROM jobs
WHERE job_type = 'QUERY' AND statement_type = 'SELECT' AND total_bytes_processed > 0
  AND creation_time BETWEEN {_EV} - INTERVAL 24 HOUR AND {_EV}
  AND NOT regexp_matches(query, 'WHERE')
ORDER BY total_bytes_processed DESC, job_id LIMIT 10""",
    "unnest_last_access": WJ + """
SELECT rt.project_id AS project_id, rt.dataset_id AS dataset_id, rt.table_id AS table_name,
       MAX(j.creation_time) AS last_access_time
FROM jobs AS j, unnest(j.referenced_tables) AS u(rt)
WHERE j.job_type = 'QUERY' AND j.state = 'DONE'
GROUP BY 1, 2, 3""",
    "stale_entities": f"""
SELECT 'proj' AS project_id, 'tpch' AS dataset_id, 'part_' || p_partkey AS table_name,
       (SELECT MAX(l_shipdate) FROM lineitem WHERE l_partkey = p_partkey AND l_linestatus = 'F') AS last_access_time
FROM part AS p
WHERE NOT EXISTS (SELECT 1 FROM lineitem AS l WHERE l.l_partkey = p.p_partkey AND l.l_linestatus = 'F'
                  AND l.l_shipdate >= TIMESTAMP '{LINEITEM_AS_OF}' - INTERVAL 90 DAY)""",
    "resource_by_job": WJ + f"""
SELECT creation_time, job_id, user_email, total_slot_ms FROM jobs
WHERE creation_time BETWEEN {_EV} - INTERVAL 1 HOUR AND {_EV} AND total_slot_ms > 0
ORDER BY total_slot_ms DESC""",
    "view_report": "WITH " + VIEWS_SQL + """
SELECT table_schema, table_name, view_definition FROM views ORDER BY table_schema, table_name""",
    "lookback_usage": WJ + f"""
SELECT job_type, COUNT(*) AS jobs, CAST(SUM(total_bytes_processed) AS BIGINT) AS total_bytes_processed
FROM jobs WHERE creation_time BETWEEN {_EV} - INTERVAL 30 DAY AND {_EV}
GROUP BY job_type""",
    "filter_eq_and": WJ + """
SELECT job_id, user_email, creation_time FROM jobs
WHERE job_type = 'QUERY' AND statement_type = 'SELECT'""",
    "project_alias": WJ + """
SELECT job_id, user_email AS "user", creation_time AS created_at, total_bytes_processed AS bytes
FROM jobs""",
}
