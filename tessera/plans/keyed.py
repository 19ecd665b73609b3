"""Workload E (keyed part): combine, group and co-group by key, and a
literal lookup joined to a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.draws import sql_draw
from tessera.operators.combiners import combine_with, largest, mean
from tessera.operators.keyed import (PARTS, cogroup, combine_globally, combine_per_key,
                                     combine_per_key_with, group_by_key)
from tessera.operators.summaries import MONEY
from tessera.sources.memory import lookup
from tessera.sources.tables import table

# Order status code -> label.
STATUS_LABELS = (("F", "Fulfilled"), ("O", "Open"), ("P", "Partial"))
_LOOKUP_SCHEMA = StructType([StructField("code", StringType(), False),
                             StructField("label", StringType(), False)])


def group_values(spark, sf_dir):
    """GroupByKey of (nation, customer) pairs; each nation is split into parts."""
    c = table(spark, sf_dir, "customer")
    return group_by_key(c, "c_nationkey", "c_custkey", salt="c_custkey", out="custkeys")


def max_per_key(spark, sf_dir):
    """CombinePerKey with a Python combiner: the largest order of each customer."""
    o = table(spark, sf_dir, "orders")
    return combine_per_key_with(o, "o_custkey", "o_totalprice", np.maximum, out="largest")


def top_per_key(spark, sf_dir):
    """CombinePerKey with lists and with (sum, count) as accumulators: the three largest orders of each customer and
    their mean, in whole cents, so that sums do not depend on the order of rows."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    top = combine_with(o, "o_custkey", "cents", largest(3, "bigint"), out="top")
    means = combine_with(o, "o_custkey", "cents", mean(), out="mean_cents")
    return top.join(means, "o_custkey").select(
        "o_custkey", *[F.try_element_at("top", F.lit(i)).alias(f"top{i}") for i in (1, 2, 3)], "mean_cents")


def global_sum(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").cast(MONEY).alias("v"))
    return combine_globally(o, "v").select(F.col("total").cast("double").alias("total"))


def sum_per_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_totalprice").cast(MONEY).alias("v"))
    return combine_per_key(o, "key", "v").select("key", F.col("total").cast("double").alias("total"))


def cogroup_orders(spark, sf_dir):
    """Every customer key with its order amounts and its name(s)."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("salt"))
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("value"),
        F.col("c_custkey").alias("salt"))
    return cogroup({"orders": o, "customer": c})


def inline_rows(spark, sf_dir):
    """A literal status lookup (size-checked broadcast) joined to orders."""
    labels = lookup(spark, STATUS_LABELS, _LOOKUP_SCHEMA)
    o = table(spark, sf_dir, "orders")
    j = o.join(labels, o.o_orderstatus == labels.code)
    return j.groupBy("label").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("total"))


QUERIES = {
    "group_values": group_values,
    "max_per_key": max_per_key,
    "top_per_key": top_per_key,
    "global_sum": global_sum,
    "sum_per_key": sum_per_key,
    "cogroup_orders": cogroup_orders,
    "inline_rows": inline_rows,
}


def _salt_sql(x: str, integral: bool = True) -> str:
    if integral:
        return f"COALESCE({sql_draw(x, 'part', 0)}, 0)"
    return f"COALESCE(CAST('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8) AS BIGINT), 0)"


ORACLE = {
    "group_values": f"""
SELECT c_nationkey, {_salt_sql('c_custkey')} % {PARTS} AS part, list(c_custkey ORDER BY c_custkey) AS custkeys
FROM customer GROUP BY 1, 2""",
    "max_per_key": "SELECT o_custkey, MAX(o_totalprice) AS largest FROM orders GROUP BY o_custkey",
    "top_per_key": """
WITH c AS (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
t AS (SELECT o_custkey, list(cents ORDER BY cents DESC) AS l, CAST(SUM(cents) AS DOUBLE) / COUNT(*) AS mean_cents
      FROM c GROUP BY o_custkey)
SELECT o_custkey, l[1] AS top1, l[2] AS top2, l[3] AS top3, mean_cents FROM t""",
    "global_sum": "SELECT CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(38,9))), 0) AS DOUBLE) AS total FROM orders",
    "sum_per_key": """SELECT o_custkey AS key, CAST(SUM(CAST(o_totalprice AS DECIMAL(38,9))) AS DOUBLE) AS total
FROM orders GROUP BY o_custkey""",
    "cogroup_orders": f"""
WITH u AS (
  SELECT o_custkey AS key, 'orders' AS tag, CAST(o_orderkey AS BIGINT) AS salt,
         o_totalprice AS v_orders, CAST(NULL AS VARCHAR) AS v_customer FROM orders
  UNION ALL
  SELECT c_custkey, 'customer', CAST(c_custkey AS BIGINT), CAST(NULL AS DOUBLE), c_name FROM customer)
SELECT key, {_salt_sql('salt')} % {PARTS} AS part,
       COALESCE(list(v_orders ORDER BY v_orders) FILTER (WHERE tag = 'orders'), []) AS orders,
       COALESCE(list(v_customer ORDER BY v_customer) FILTER (WHERE tag = 'customer'), []) AS customer
FROM u GROUP BY 1, 2""",
    "inline_rows": """
WITH s(code, label) AS (VALUES ('F', 'Fulfilled'), ('O', 'Open'), ('P', 'Partial'))
SELECT label, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(38,9))) AS DOUBLE) AS total
FROM orders JOIN s ON o_orderstatus = code GROUP BY label""",
}
