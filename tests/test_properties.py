"""Randomised agreement between the Spark expressions and their oracle SQL
(one DataFrame of many generated strings per property, so it stays fast)."""

import random

from pyspark.sql import functions as F

from tessera.functions.cleansing import (blank_to_null, parse_date_multi, safe_int,
                                         safe_numeric, standardise_status)
from tessera.sources.staging import (sql_blank_to_null, sql_parse_dates, sql_safe_int,
                                     sql_safe_numeric, sql_status)

RNG = random.Random(7)
PIECES = ["", " ", "\t", "0", "7", "12", "-3", "+4", "1.5", "1e2", "0x1F", "abc", "n/a", "$5",
          "1,000", "2023", "-", "/", "01", "1", "13", "31", "Jan", "JAN", "Feb", "30", "\xa0", "Done",
          "Pending", "Completed", "done"]


def _strings(n=600):
    out = set()
    while len(out) < n:
        out.add("".join(RNG.choice(PIECES) for _ in range(RNG.randint(1, 5))))
    dates = [f"{RNG.randint(1990, 2030)}-{RNG.randint(0, 13)}-{RNG.randint(0, 32)}" for _ in range(150)]
    dates += [f"{RNG.randint(0, 13)}/{RNG.randint(0, 32)}/{RNG.randint(1990, 2030)}" for _ in range(150)]
    dates += [f"{RNG.randint(1, 31):02d}-{RNG.choice(['Jan', 'Feb', 'Mar', 'Dec', 'Foo'])}-{RNG.randint(1990, 2030)}"
              for _ in range(100)]
    return sorted(out) + dates + [None]


def _compare(spark, duck, spark_expr, sql_of):
    values = _strings()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: r["x"] for r in df.select("i", spark_expr(F.col("s")).alias("x")).collect()}
    duck.execute("CREATE OR REPLACE TEMP TABLE prop(i INTEGER, s VARCHAR)")
    duck.executemany("INSERT INTO prop VALUES (?, ?)", list(enumerate(values)))
    want = dict(duck.execute(f"SELECT i, {sql_of('s')} FROM prop").fetchall())
    bad = [(values[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not bad, bad[:5]


def test_safe_int_agrees(spark, duck):
    _compare(spark, duck, safe_int, sql_safe_int)


def test_safe_numeric_agrees(spark, duck):
    _compare(spark, duck, safe_numeric, sql_safe_numeric)


def test_dates_agree(spark, duck):
    _compare(spark, duck, parse_date_multi, sql_parse_dates)


def test_blank_to_null_agrees(spark, duck):
    _compare(spark, duck, blank_to_null, sql_blank_to_null)


def test_status_agrees(spark, duck):
    _compare(spark, duck, standardise_status, sql_status)


def test_word_count_agrees_with_python_split(spark, duck):
    from tessera.functions.text import word_count
    from tessera.plans.text import _WORDS
    pool = list("ab€é1_-.,") + ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", " ", "\x85", "\xa0",
                                " ", " ", " ", "​", " ", " ", " ",
                                " ", "　", "﻿"]
    texts = ["".join(RNG.choice(pool) for _ in range(RNG.randint(0, 12))) for _ in range(800)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, line string")
    got = {r["i"]: r["w"] for r in df.select("i", word_count("line").alias("w")).collect()}
    assert all(got[i] == len(t.split()) for i, t in enumerate(texts))
    duck.execute("CREATE OR REPLACE TEMP TABLE wc(i INTEGER, line VARCHAR)")
    duck.executemany("INSERT INTO wc VALUES (?, ?)", list(enumerate(texts)))
    want = dict(duck.execute(f"SELECT i, {_WORDS} FROM wc").fetchall())
    assert all(want[i] == len(t.split()) for i, t in enumerate(texts))


def test_draw_column_and_sql_text_agree(spark, duck):
    from tessera.functions.draws import draw, draw_sql, sql_draw, weighted_pick_sql
    choices = (("a", 15), ("b", 60), ("c", 25))
    df = spark.range(0, 20000, 7).withColumnRenamed("id", "k")
    got = df.select("k", draw("k", "s", 1).alias("d1"), F.expr(draw_sql("k", "s", 1)).alias("d2"),
                    F.expr(weighted_pick_sql(f"{draw_sql('k', 's', 1)} % 100", choices)).alias("p1")
                    ).collect()
    assert all(r["d1"] == r["d2"] for r in got)
    duck_vals = dict(duck.execute(f"SELECT k, {sql_draw('k', 's', 1)} FROM range(0, 20000, 7) t(k)").fetchall())
    assert all(duck_vals[r["k"]] == r["d1"] for r in got)
    shares = {c: sum(r["p1"] == c for r in got) / len(got) for c, _ in choices}
    assert abs(shares["b"] - 0.60) < 0.03
