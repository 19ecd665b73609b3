"""Keyed operators: CombineGlobally, CombinePerKey, GroupByKey, CoGroupByKey.

Combines are built-in aggregates, so Spark pre-combines map-side and a hot key
ships one partial row per map task.

Grouping collects values, which is where a hot key hurts: one key holding a
third of the rows would become one giant array in one task. So grouped output
is *split*: every key, large or small, has its values dealt over a fixed number
of ``parts`` by a hash of its rows' salt, a column that tells the rows apart
(a primary key). Each output row holds one part; the parts of a key together
hold exactly its multiset of values, also NULL values. One scan and one
exchange, on (key, part); nothing depends on how many rows a key has. Choose
``parts`` so that the largest key's values, divided by it, fit a task.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from tessera.functions.draws import draw
from tessera.operators.combiners import HELD_KEYS, Combiner, combine_with, of_series, reducing

#: Parts that each key is split into unless the caller says otherwise.
PARTS = 16


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


_INTEGRAL = (LongType, IntegerType, ShortType, ByteType)


def salt_bits(col, integral: bool = False) -> Column:
    """Unsigned 32-bit hash of a salt, reproducible by any SQL engine: the
    integer mixer of ``functions.draws`` for integral salts (a few integer
    operations), else an md5 prefix of the string form. NULL hashes to 0 (a
    row-unique salt is NULL at most once)."""
    if integral:
        h = draw(col, "part", 0)
    else:
        h = F.conv(F.substring(F.md5(_c(col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(h, F.lit(0).cast("bigint"))


def combine_globally(df: DataFrame, value: str, out: str = "total", zero=0) -> DataFrame:
    """Sum of all values; an empty input gives ``zero``, not NULL."""
    return df.agg(F.coalesce(F.sum(value), F.lit(zero)).alias(out))


def combine_per_key(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(out))


def _with_part(df: DataFrame, salt: str, parts: int) -> DataFrame:
    integral = isinstance(df.schema[salt].dataType, _INTEGRAL)
    return df.withColumn("part", F.pmod(salt_bits(salt, integral), F.lit(parts).cast("bigint")))


def group_by_key(df: DataFrame, key: str, value: str, salt, parts: int = PARTS,
                 out: str = "values", multiset: bool = False) -> DataFrame:
    """(key, part, sorted values) rows; NULL values are kept.

    ``salt`` tells rows apart (a primary key). With ``multiset=True`` it is not
    needed: copies are pre-aggregated map-side into (value, n) pairs before any
    shuffle and the parts hold distinct values with their multiplicity, so even
    a single value copied into a third of all rows yields one small struct.
    """
    if multiset:
        pairs = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
        tagged = _with_part(pairs.withColumn("__salt", F.col(value)), "__salt", parts)
        vals = F.array_sort(F.collect_list(F.struct(F.col(value).alias("value"), F.col("n"))))
        return tagged.groupBy(key, "part").agg(vals.alias(out))
    tagged = _with_part(df.select(key, value, _c(salt).alias("__salt")), "__salt", parts)
    vals = F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"))))
    return tagged.groupBy(key, "part").agg(F.transform(vals, lambda x: x["v"]).alias(out))


def cogroup(inputs: Mapping[str, DataFrame], key: str = "key", value: str = "value",
            salt: str = "salt", parts: int = PARTS) -> DataFrame:
    """CoGroupByKey: one row per (key, part) with one sorted list per input
    tag; ``[]`` where an input has no value for the key in that part. One union
    and one grouping shuffle; NULL keys group together and NULL values are kept.

    Each input has the columns ``key``, ``value`` and ``salt`` (row-unique).
    """
    tags = list(inputs)
    types = {t: d.schema[value].dataType for t, d in inputs.items()}
    # Integral salts everywhere keep the cheap integer hash; else hash strings.
    salt_type = "bigint" if all(isinstance(d.schema[salt].dataType, _INTEGRAL)
                                for d in inputs.values()) else "string"
    u = None
    for t, d in inputs.items():
        cols = [F.col(key).alias("__key"), F.lit(t).alias("__tag"),
                F.col(salt).cast(salt_type).alias("__salt")]
        cols += [(F.col(value) if o == t else F.lit(None)).cast(types[o]).alias(f"__v_{o}")
                 for o in tags]
        part = d.select(*cols)
        u = part if u is None else u.unionByName(part)
    tagged = _with_part(u, "__salt", parts)
    aggs = []
    for t in tags:
        lst = F.array_sort(F.collect_list(F.when(F.col("__tag") == t,
                                                 F.struct(F.col(f"__v_{t}").alias("v")))))
        aggs.append(F.transform(lst, lambda x: x["v"]).alias(t))
    return tagged.groupBy(F.col("__key").alias(key), "part").agg(*aggs)


def combine_per_key_with(df: DataFrame, key: str, value: str, fn, out: str = "total",
                         return_type: str = "double", held_keys: int = HELD_KEYS) -> DataFrame:
    """CombinePerKey with a user combiner: a ``Combiner``, a numpy ufunc, or a function ``pandas.Series -> scalar``.

    It must be associative and commutative (like sum, min, max), for it runs twice: in every task that reads, then
    over the partial results (see ``operators.combiners``). Only the last form is called for each key.
    """
    if isinstance(fn, np.ufunc):
        fn = reducing(fn, return_type)
    return combine_with(df, key, value, fn if isinstance(fn, Combiner) else of_series(fn, return_type), out, held_keys)
