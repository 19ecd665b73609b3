"""Workload G and the table-level sources/sinks: joins, exports, round
trips through every sink, dated partitions, latest rows, scan budget and the
bucket-location policy audit."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.operators.policy import location_violations
from tessera.operators.quality import data_files, require_nonempty, scanned_bytes
from tessera.functions.envelope import pretty_json
from tessera.session import cut_lineage, shared_dir
from tessera.sinks.documents import read_whole_documents, write_documents
from tessera.sinks.files import (CSV_NULL, replace_partitions, write_csv,
                                 write_json, write_parquet, write_sorted)
from tessera.sinks.tables import replace_table
from tessera.sinks.partition_stats import latest_rows, replace_measured, stats as partition_stats
from tessera.sources.files import read_csv, read_json
from tessera.sources.memory import lookup
from tessera.sources.tables import read_day, read_parquet, table
from tessera.functions.timefn import partition_day as day_of

DAY = "2024-01-15"
RUN_DATE = "2024-02-01"
# The allowed bucket location prefix of the policy.
ALLOWED_PREFIX = "us-central1"
# Region key -> bucket location of the synthetic inventory
# (region 4 has no known location).
REGION_LOCATIONS = ((0, "us-central1"), (1, "us-east1"), (2, "europe-west1"),
                    (3, "asia-east1"), (4, None))
_LOC_SCHEMA = StructType([StructField("region", IntegerType(), False),
                          StructField("region_location", StringType(), True)])


def customer_order_count(spark, sf_dir):
    """Orders per customer: orders are pre-counted per key before the join,
    so a hot customer costs one partial row per task, not a skewed join."""
    o = table(spark, sf_dir, "orders")
    per = o.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    j = c.join(per, c.c_custkey == per.o_custkey)
    return j.groupBy(F.col("c_custkey").alias("cust_id")).agg(
        F.sum("n").alias("order_count"))


def overwrite_roundtrip(spark, sf_dir):
    """Truncate-and-write twice to one path; the second write replaces the first."""
    out = shared_dir(spark, "order_counts")
    stale = customer_order_count(spark, sf_dir).withColumn("order_count", F.col("order_count") * 2)
    write_parquet(stale, out)                                   # an earlier, different result
    write_parquet(customer_order_count(spark, sf_dir), out, mode="overwrite")
    return read_parquet(spark, out)


def table_replaced_from_itself(spark, sf_dir):
    """Truncate-and-write of a table by a query that reads it, twice: counts grow, small ones go."""
    name, base = f"order_counts_{uuid.uuid4().hex[:8]}", shared_dir(spark, "order_counts_table")
    try:
        replace_table(customer_order_count(spark, sf_dir), name, base)
        for least in (3, 6):
            now = spark.table(name)
            replace_table(now.withColumn("order_count", F.col("order_count") + 1).where(F.col("order_count") >= least), name, base)
        return cut_lineage(spark.table(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


HOUR = "2024-01-15 10:00:00"


def sorted_hour_scan(spark, sf_dir, start=HOUR):
    """Events stored by time, sorted within files; an hour of them, for which the other row groups are skipped."""
    out = shared_dir(spark, "events_sorted")
    write_sorted(table(spark, sf_dir, "events"), out, ["ts", "event_id"])
    from_ts = F.lit(start).cast("timestamp_ntz")
    return read_parquet(spark, out).where((F.col("ts") >= from_ts) & (F.col("ts") < from_ts + F.expr("INTERVAL 1 HOUR")))


#: Events of a run, and which runs' files are damaged or empty.
RUN_EVENTS, DAMAGED_EVERY, EMPTY_EVERY = 500, 7, 11
DOCUMENT = "run long, items array<struct<event_id long, kind string>>"


def document_files_roundtrip(spark, sf_dir):
    """One indented document for each run, one file each, some damaged or empty; read back whole, with their problems."""
    e = table(spark, sf_dir, "events").withColumn("run", F.expr(f"event_id div {RUN_EVENTS}"))
    item = F.struct("event_id", F.col("event_type").alias("kind"))
    runs = e.groupBy("run").agg(F.sort_array(F.collect_list(item)).alias("items"), F.min("ts").alias("first"))
    whole = pretty_json(F.struct("run", "items"))
    text = (F.when(F.col("run") % EMPTY_EVERY == 1, "").when(F.col("run") % DAMAGED_EVERY == 1, F.expr("substr(whole, 1, length(whole) - 9)"))
            .otherwise(F.col("whole")))
    out = shared_dir(spark, "documents")
    write_documents(runs.select("run", whole.alias("whole"), F.to_date("first").cast("string").alias("dt"), F.concat(F.lit("run-"), "run").alias("run_id"))
                    .withColumn("text", text), out, "text", pretty=False)
    back = read_whole_documents(spark, out, DOCUMENT)
    return back.select("dt", "run_id", "problem", F.size("doc.items").cast("long").alias("n_items"),
                       F.aggregate("doc.items", F.lit(0).cast("long"), lambda a, x: a + x["event_id"]).alias("id_sum"),
                       F.endswith("path", F.lit(".txt")).alias("own_file"))


def having_nonempty(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("row_count")).where(
        F.col("row_count") > 0)


def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


def scan_parquet(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def csv_export_roundtrip(spark, sf_dir, ds=RUN_DATE):
    """Gate, then sharded CSV export under a dated path; read back losslessly."""
    require_nonempty(having_nonempty(spark, sf_dir), "orders export gate")
    o = table(spark, sf_dir, "orders")
    out = shared_dir(spark, "csv_export") + f"/dt={ds}"
    write_csv(o, out, null_value=CSV_NULL)
    return read_csv(spark, out, o.schema, null_value=CSV_NULL)


def _events_by_day(spark, sf_dir) -> str:
    ev = table(spark, sf_dir, "events").withColumn("dt", day_of("ts"))
    out = shared_dir(spark, "events_by_day")
    write_parquet(ev, out, partition_by=["dt"], within=["event_id"])
    return out


def _measured_events(spark, sf_dir) -> str:
    """The events in dated partitions, with statistics."""
    ev = table(spark, sf_dir, "events").withColumn("dt", day_of("ts"))
    out = shared_dir(spark, "events_by_day")
    replace_measured(ev, out, within=["event_id"])
    return out


def partition_day(spark, sf_dir, ds=DAY):
    return read_day(spark, _events_by_day(spark, sf_dir), ds)


def partition_replace(spark, sf_dir, ds=DAY):
    """Re-run of one day: only that day's folder is replaced."""
    root = _events_by_day(spark, sf_dir)
    day = read_day(spark, root, ds).withColumn("value", F.col("value") * 2)
    staged = shared_dir(spark, "events_day_rerun")
    write_parquet(day, staged)  # cut lineage: the rerun reads its own input folder
    replace_partitions(read_parquet(spark, staged), root, ["dt"], within=["event_id"])
    return read_parquet(spark, root)


def latest_partition_topk(spark, sf_dir, k=5):
    """The newest rows, from the partitions that the writer's statistics name; no other folder is listed."""
    return latest_rows(spark, _measured_events(spark, sf_dir), k, order=[F.col("ts").desc(), F.col("event_id").asc()])


#: Scans that the budget query is asked for: name and days back from the last day.
BUDGETED_SCANS = (("day", 1), ("week", 7), ("all", 10_000))


def scan_budget(spark, sf_dir):
    """Which scans of the dated log a budget of half its bytes refuses, from the writer's statistics.

    ``bytes_are_right``: the statistics name exactly the bytes of the files (which SQL over the tables cannot know).
    """
    root = _measured_events(spark, sf_dir)
    days = partition_stats(spark, root)
    budget, last = days.agg(F.sum("bytes") / 2, F.max("dt")).first()
    on_disk = data_files(spark, root).groupBy("dt").agg(F.sum("length").alias("length"))
    scans = lookup(spark, BUDGETED_SCANS, StructType([StructField("scan", StringType()), StructField("back", IntegerType())]))
    asked = days.join(on_disk, "dt").join(scans, F.datediff(F.lit(last), "dt") < F.col("back"))
    return asked.groupBy("scan").agg(
        F.count("*").alias("partitions"), F.sum("rows").alias("rows"), (F.sum("bytes") > budget).alias("refused"),
        F.bool_and(F.col("bytes") == F.col("length")).alias("bytes_are_right"))


def scan_bytes(spark, sf_dir, ds=DAY):
    """What a one-day read of the dated log would scan, from the file listing:
    whether it has files, costs less than the whole log, and how many days it touches."""
    root = _events_by_day(spark, sf_dir)
    day = F.col("dt") == F.lit(ds).cast("date")
    one, whole = scanned_bytes(spark, root, day).first(), scanned_bytes(spark, root).first()
    return data_files(spark, root).where(day).agg(
        F.lit(one["files"] > 0).alias("has_files"),
        F.lit(0 < one["scanned_bytes"] < whole["scanned_bytes"]).alias("below_whole"),
        F.countDistinct("dt").alias("days"))


def json_sink_roundtrip(spark, sf_dir, ds=RUN_DATE, run_id="run-1"):
    d = table(spark, sf_dir, "documents").withColumns(
        {"dt": F.lit(ds), "run_id": F.lit(run_id)})
    out = shared_dir(spark, "documents_json")
    write_json(d, out, partition_by=["dt", "run_id"])
    back = read_json(spark, out, table(spark, sf_dir, "documents").schema)
    return back.select("doc_id", "text", "lang", "source", "n_chars")


def bucket_inventory(spark, sf_dir):
    """One bucket-creation request per supplier, located by its region."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    loc = lookup(spark, REGION_LOCATIONS, _LOC_SCHEMA)
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(loc, F.col("n_regionkey") == loc.region, "left")
    zone = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")),
                        (F.col("n_nationkey") % 3 + 1).cast("int"))
    return j.select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 0, F.lit("UPDATE")).otherwise(F.lit("CREATE")).alias("method"),
        F.lit("bucket").alias("resource_type"),
        F.concat(F.col("region_location"), F.lit("-"), zone).alias("location"))


def policy_violations(spark, sf_dir):
    return location_violations(bucket_inventory(spark, sf_dir), ALLOWED_PREFIX)


QUERIES = {
    "customer_order_count": customer_order_count,
    "overwrite_roundtrip": overwrite_roundtrip,
    "table_replaced_from_itself": table_replaced_from_itself,
    "sorted_hour_scan": sorted_hour_scan,
    "document_files_roundtrip": document_files_roundtrip,
    "having_nonempty": having_nonempty,
    "row_count": row_count,
    "scan_parquet": scan_parquet,
    "csv_export_roundtrip": csv_export_roundtrip,
    "partition_day": partition_day,
    "partition_replace": partition_replace,
    "latest_partition_topk": latest_partition_topk,
    "scan_bytes": scan_bytes,
    "scan_budget": scan_budget,
    "json_sink_roundtrip": json_sink_roundtrip,
    "policy_violations": policy_violations,
}

_COUNT_SQL = """
SELECT c.c_custkey AS cust_id, COUNT(o.o_orderkey) AS order_count
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey"""

_EVENTS_DT = "SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS dt FROM events"

ORACLE = {
    "customer_order_count": _COUNT_SQL,
    "overwrite_roundtrip": _COUNT_SQL,
    "table_replaced_from_itself": f"""
SELECT cust_id, order_count + 2 AS order_count FROM ({_COUNT_SQL}) WHERE order_count + 1 >= 3 AND order_count + 2 >= 6""",
    "sorted_hour_scan": f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{HOUR}' AND ts < TIMESTAMP '{HOUR}' + INTERVAL 1 HOUR""",
    "document_files_roundtrip": f"""
WITH r AS (SELECT event_id // {RUN_EVENTS} AS run, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS dt, COUNT(*) AS n,
                  CAST(SUM(event_id) AS BIGINT) AS ids FROM events GROUP BY 1),
p AS (SELECT *, CASE WHEN run % {EMPTY_EVERY} = 1 THEN 'empty' WHEN run % {DAMAGED_EVERY} = 1 THEN 'damaged' END AS problem FROM r)
SELECT dt, 'run-' || run AS run_id, problem, CASE WHEN problem IS NULL THEN n END AS n_items,
       CASE WHEN problem IS NULL THEN ids END AS id_sum, true AS own_file FROM p""",
    "having_nonempty": "SELECT COUNT(*) AS row_count FROM orders HAVING COUNT(*) > 0",
    "row_count": "SELECT COUNT(*) AS row_count FROM lineitem",
    "scan_parquet": "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem",
    "csv_export_roundtrip": "SELECT * FROM orders",
    "partition_day": _EVENTS_DT + f" WHERE CAST(ts AS DATE) = DATE '{DAY}'",
    "partition_replace": f"""SELECT event_id, ts, user_id, event_type,
       CASE WHEN CAST(ts AS DATE) = DATE '{DAY}' THEN value * 2 ELSE value END AS value,
       props, CAST(ts AS DATE) AS dt FROM events""",
    "latest_partition_topk": _EVENTS_DT + " ORDER BY dt DESC, ts DESC, event_id LIMIT 5",
    "scan_bytes": f"""
SELECT COUNT(*) FILTER (WHERE CAST(ts AS DATE) = DATE '{DAY}') > 0 AS has_files,
       COUNT(*) FILTER (WHERE CAST(ts AS DATE) = DATE '{DAY}') BETWEEN 1 AND COUNT(*) - 1 AS below_whole,
       COUNT(DISTINCT CAST(ts AS DATE)) FILTER (WHERE CAST(ts AS DATE) = DATE '{DAY}') AS days
FROM events""",
    "scan_budget": """
WITH e AS (SELECT CAST(ts AS DATE) AS dt FROM events),
s(scan, back) AS (VALUES ('day', 1), ('week', 7), ('all', 10000))
SELECT scan, COUNT(DISTINCT dt) AS partitions, COUNT(*) AS rows, COUNT(*) * 2 > (SELECT COUNT(*) FROM e) AS refused,
       true AS bytes_are_right
FROM e JOIN s ON (SELECT MAX(dt) FROM e) - dt < back GROUP BY scan""",
    "json_sink_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "policy_violations": f"""
WITH loc(region, region_location) AS (VALUES (0, 'us-central1'), (1, 'us-east1'),
        (2, 'europe-west1'), (3, 'asia-east1'), (4, NULL)),
inv AS (
  SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'UPDATE' ELSE 'CREATE' END AS method,
         'bucket' AS resource_type,
         region_location || '-' || ['a', 'b', 'c'][n_nationkey % 3 + 1] AS location
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN loc ON n_regionkey = loc.region)
SELECT * FROM inv
WHERE method IN ('CREATE') AND resource_type IN ('bucket')
  AND COALESCE(NOT starts_with(location, '{ALLOWED_PREFIX}'), true)""",
}
