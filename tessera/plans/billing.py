"""Workload D: classify billing cost lines and sum cost per class.

The classifier depends only on the SKU (a ``part`` attribute), so cost is
pre-aggregated per part key on the big side (partial aggregation inside the
scan stage, filters pushed into the lineitem scan) and only one row per part
meets the join. Decimal sums make the two-level aggregation exact.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.cleansing import classify
from tessera.functions.timefn import lookback
from tessera.operators.summaries import MONEY
from tessera.session import shared_dir
from tessera.sinks.files import write_parquet
from tessera.sources.tables import read_parquet, table
from tessera.sources.usage import (BILLING_AS_OF, SERVICE_SQL, SKU_SQL,
                                   billing_export, service_description,
                                   sku_description)

# SKU activity classes, first match wins, then 'Other: <sku>'.
ACTIVITY_RULES = (
    ("analysis", "Query (Analysis)"),
    ("storage", "Storage"),
    ("streaming insert", "Streaming Inserts"),
    ("load job", "Load Jobs"),
    ("copy", "Copy Jobs"),
)
OTHER_PREFIX = "Other: "


def cost_by_activity(spark, sf_dir, as_of=BILLING_AS_OF, service="Query Engine"):
    li = table(spark, sf_dir, "lineitem")
    usage = li.where((service_description("l_returnflag") == service)
                     & lookback("l_shipdate", as_of, "30 DAYS"))
    per_part = usage.groupBy("l_partkey").agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("cost"))
    part = table(spark, sf_dir, "part").select(
        "p_partkey", sku_description("p_type", "p_name").alias("sku_desc"))
    lines = per_part.join(part, per_part.l_partkey == part.p_partkey)
    classed = lines.select("cost", classify("sku_desc", ACTIVITY_RULES, OTHER_PREFIX).alias("activity"))
    return (classed.groupBy("activity")
            .agg(F.round(F.sum("cost"), 2).cast("double").alias("total_cost_usd"))
            .orderBy(F.desc("total_cost_usd"), "activity"))


def nested_field(spark, sf_dir):
    """Nested projection from a stored export with STRUCT columns; the read
    schema keeps only ``sku.description`` and ``service.description``."""
    out = shared_dir(spark, "billing_export")
    write_parquet(billing_export(table(spark, sf_dir, "lineitem"),
                                 table(spark, sf_dir, "part")), out)
    b = read_parquet(spark, out)
    return b.select("line_order", "line_number", "cost",
                    F.col("sku.description").alias("sku_desc"),
                    F.col("service.description").alias("service_desc"))


QUERIES = {
    "cost_by_activity": cost_by_activity,
    "nested_field": nested_field,
}

_CASE = "CASE " + " ".join(
    f"WHEN lower(sku_desc) LIKE '%{n}%' THEN '{label}'" for n, label in ACTIVITY_RULES
) + f" ELSE '{OTHER_PREFIX}' || sku_desc END"

ORACLE = {
    "cost_by_activity": f"""
WITH usage_lines AS (
  SELECT l_extendedprice AS cost, {SKU_SQL} AS sku_desc, {SERVICE_SQL} AS service_desc,
         l_shipdate AS usage_start_time
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE {SERVICE_SQL} = 'Query Engine'
    AND l_shipdate BETWEEN TIMESTAMP '{BILLING_AS_OF}' - INTERVAL 30 DAY AND TIMESTAMP '{BILLING_AS_OF}')
SELECT activity, CAST(ROUND(SUM(CAST(cost AS DECIMAL(38,9))), 2) AS DOUBLE) AS total_cost_usd
FROM (SELECT cost, {_CASE} AS activity FROM usage_lines)
GROUP BY activity ORDER BY total_cost_usd DESC""",
    "nested_field": f"""
SELECT l_orderkey AS line_order, l_linenumber AS line_number, l_extendedprice AS cost,
       {SKU_SQL} AS sku_desc, {SERVICE_SQL} AS service_desc
FROM lineitem JOIN part ON l_partkey = p_partkey""",
}
