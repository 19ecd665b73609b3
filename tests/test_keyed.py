"""Keyed operators: literal goldens and chunked grouping of a hot key."""

from pyspark.sql import functions as F

from tessera.operators.keyed import (cogroup, combine_globally, combine_per_key,
                                     group_by_key)

CITY_ZIP = [("Lexington", "40513"), ("Nashville", "37027"), ("Lexington", "40502"),
            ("Seattle", "98125"), ("Mountain View", "94041"), ("Seattle", "98133"),
            ("Lexington", "40591"), ("Mountain View", "94085")]
SALES = [("SP001", 1200.50), ("SP002", 950.00), ("SP001", 300.75), ("SP003", 2100.00),
         ("SP002", 400.25), ("SP004", 1800.00), ("SP003", 500.00), ("SP001", 700.00)]


def _merged(rows, col):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).extend(r[col])
    return {k: sorted(v) for k, v in out.items()}


def test_group_by_key_golden(spark):
    df = spark.createDataFrame(CITY_ZIP, "key string, value string")
    got = _merged(group_by_key(df, "key", "value", salt="value").collect(), 2)
    assert got == {"Lexington": ["40502", "40513", "40591"], "Mountain View": ["94041", "94085"],
                   "Nashville": ["37027"], "Seattle": ["98125", "98133"]}


def test_combines_golden(spark):
    df = spark.createDataFrame(SALES, "key string, value double").select(
        "key", F.col("value").cast("decimal(18,2)").alias("value"))
    assert float(combine_globally(df, "value").first()["total"]) == 7951.50
    per = {r["key"]: float(r["total"]) for r in combine_per_key(df, "key", "value").collect()}
    assert per == {"SP001": 2201.25, "SP002": 1350.25, "SP003": 2600.00, "SP004": 1800.00}
    empty = df.where(F.lit(False))
    assert combine_globally(empty, "value").first()["total"] == 0
    assert combine_per_key(empty, "key", "value").count() == 0


def _salted(df):
    return df.withColumn("salt", F.monotonically_increasing_id())


def _lists(rows, tag):
    out = {}
    for r in rows:
        out.setdefault(r["key"], []).extend(r[tag])
    return out


def test_cogroup_golden_missing_side(spark):
    amounts = spark.createDataFrame([(f"ORD100{i}", 10.0 * i) for i in range(1, 9)], "key string, value double")
    dates = spark.createDataFrame([(f"ORD100{i}", f"2025-08-{13 + i}") for i in range(1, 8)],
                                  "key string, value string")
    rows = cogroup({"orders": _salted(amounts), "shipping": _salted(dates)}).collect()
    assert _lists(rows, "orders") == {f"ORD100{i}": [10.0 * i] for i in range(1, 9)}
    assert _lists(rows, "shipping") == {f"ORD100{i}": [f"2025-08-{13 + i}"] if i < 8 else [] for i in range(1, 9)}


def test_cogroup_null_keys_and_values(spark):
    a = spark.createDataFrame([(None, 1.0), (None, None), ("k", 2.0)], "key string, value double")
    b = spark.createDataFrame([(None, "x")], "key string, value string")
    rows = cogroup({"a": _salted(a), "b": _salted(b)}).collect()
    assert sorted(_lists(rows, "a")[None], key=lambda v: (v is None, v)) == [1.0, None]
    assert _lists(rows, "b") == {None: ["x"], "k": []}


def test_every_key_is_split_into_the_same_parts(spark):
    # One key holds a third of all rows, of two values, one of them NULL.
    n = 6000
    df = spark.range(n).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('k', id % 10)) AS key",
                                   "IF(id % 2 = 0, 7, NULL) AS value")
    grouped = group_by_key(df, "key", "value", salt="id", parts=8)
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    out = grouped.collect()
    hot = [r for r in out if r["key"] == "hot"]
    assert len(hot) == 8 and max(len(r["values"]) for r in hot) < 2 * (n // 3) / 8
    assert sorted((v is None for r in hot for v in r["values"])) == [False] * 1000 + [True] * 1000
    assert sum(len(r["values"]) for r in out) == n
    assert plan.count("Exchange") == 1 and "Join" not in plan and plan.count("Range") == 1


def test_parts_match_duckdb(spark, duck):
    from tessera.plans.keyed import _salt_sql
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_orderstatus").alias("key"), F.col("o_orderkey").alias("value"))
    got = {(r["key"], r["part"]): r["values"]
           for r in group_by_key(df, "key", "value", salt="value", parts=5).collect()}
    q = f"""SELECT o_orderstatus, {_salt_sql('o_orderkey')} % 5, list(o_orderkey ORDER BY o_orderkey)
            FROM orders GROUP BY 1, 2"""
    want = {(k, p): v for k, p, v in duck.execute(q).fetchall()}
    assert got == want and len(want) == 15


def test_multiset_grouping_of_copies(spark):
    # One (key, value) pair copied into a third of all rows.
    rows = [("hot", 7)] * 1000 + [("hot", i) for i in range(1000)] + [(f"k{i % 10}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, value bigint")
    out = group_by_key(df, "key", "value", None, parts=10, multiset=True).collect()
    hot = [x for r in out if r["key"] == "hot" for x in r["values"]]
    counts = {x["value"]: x["n"] for x in hot}
    assert counts[7] == 1001 and len(counts) == 1000
    assert sum(x["n"] for r in out for x in r["values"]) == len(rows)
    assert max(len(r["values"]) for r in out) < 200


def test_callable_combiner_passes_on_one_partial_per_key_and_task(spark):
    import pandas as pd

    from tessera.operators.keyed import combine_per_key_with
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(0, 9000, 1, 3).selectExpr("IF(id % 3 = 0, 0, id % 7) AS key", "id AS value")

        def total(s: pd.Series) -> int:
            return int(s.sum())

        out = combine_per_key_with(df, "key", "value", total, return_type="bigint")
        got = {r[0]: r[1] for r in out.collect()}
        assert got == {r[0]: r[1] for r in df.groupBy("key").agg(F.sum("value")).collect()}
        plan = out._jdf.queryExecution().optimizedPlan()
        assert plan.toString().count("MapInArrow") == 2 and "InPandas" not in plan.toString()
        held = combine_per_key_with(df, "key", "value", total, return_type="bigint", held_keys=2)
        assert {r[0]: r[1] for r in held.collect()} == got     # small memory, same result
        # Thirty batches in each of three tasks, yet each task hands on one row per key.
        partials = plan
        while "MapInArrow" not in partials.children().apply(0).nodeName():
            partials = partials.children().apply(0)
        while "MapInArrow" not in partials.nodeName():
            partials = partials.children().apply(0)
        partials = partials.children().apply(0)
        while "MapInArrow" not in partials.nodeName():
            partials = partials.children().apply(0)
        from pyspark.sql import DataFrame
        rows = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, partials), spark)
        assert rows.groupBy("key", F.spark_partition_id()).count().agg(F.max("count")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


BIG = 1 << 53
KEYED = [(BIG, BIG + 1), (BIG + 1, BIG + 3), (None, 5), (None, None), (BIG + 1, None), (BIG, 2), (7, None), (BIG, BIG + 1)]


def _keyed(spark):
    return spark.createDataFrame(KEYED, "key bigint, value bigint").repartition(3)


def test_combiners_keep_large_keys_and_values_beside_nulls(spark):
    import numpy as np

    from tessera.operators.combiners import combine_with, largest, mean, reducing
    df = _keyed(spark)

    def found(combiner, source=df):
        return {r[0]: r[1] for r in combine_with(source, "key", "value", combiner).collect()}

    assert found(reducing(np.maximum, "bigint")) == {BIG: BIG + 1, BIG + 1: BIG + 3, None: 5, 7: None}
    assert found(reducing(np.add, "bigint")) == {BIG: 2 * BIG + 4, BIG + 1: BIG + 3, None: 5, 7: None}
    assert found(largest(2, "bigint")) == {BIG: [BIG + 1, BIG + 1], BIG + 1: [BIG + 3], None: [5], 7: []}
    assert found(mean())[None] == 5.0 and found(mean())[7] is None
    words = df.selectExpr("key", "CAST(value AS STRING) AS value")
    assert found(reducing(max, "string"), words)[BIG] == str(BIG + 1)          # any function of two values
    floats = spark.createDataFrame([(float("nan"), 1), (float("nan"), 2), (0.0, 3), (-0.0, 4), (None, 5)], "key double, value bigint")
    got = combine_with(floats.repartition(4), "key", "value", reducing(np.add, "bigint")).collect()
    assert sorted((str(r[0]), r[1]) for r in got) == [("0.0", 7), ("None", 5), ("nan", 3)]
    assert combine_with(df.limit(0), "key", "value", mean()).count() == 0


def test_series_combiner_keeps_large_keys(spark):
    from tessera.operators.keyed import combine_per_key_with
    got = combine_per_key_with(_keyed(spark), "key", "value", lambda s: s.max(), return_type="bigint")
    assert {r[0]: r[1] for r in got.collect()} == {BIG: BIG + 1, BIG + 1: BIG + 3, None: 5, 7: None}


def test_combiner_over_many_batches_and_a_hot_key(spark):
    import numpy as np

    from tessera.operators.combiners import combine_with, largest, reducing
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df = spark.range(0, 6000, 1, 4).selectExpr("IF(id % 3 = 0, 0, id) AS key", "id * 7 % 1000 AS value")
        want = {r[0]: r[1] for r in df.groupBy("key").agg(F.sum("value")).collect()}
        for held in (200_000, 10):
            got = combine_with(df, "key", "value", reducing(np.add, "bigint"), held_keys=held).collect()
            assert len(got) == len(want) and {r[0]: r[1] for r in got} == want
        top = {r[0]: r[1] for r in combine_with(df, "key", "value", largest(4, "bigint"), held_keys=10).collect()}
        assert top[0] == sorted((i * 7 % 1000 for i in range(0, 6000, 3)), reverse=True)[:4] and len(top) == len(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
