"""One scan into several sinks, and generators that keep state between rows."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.generators import volumes
from tessera.plans.text import fanout_outputs
from tessera.session import shared_dir
from tessera.sinks.fanout import read_outputs, tag_outputs, write_outputs


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def test_outputs_of_one_pass_are_counted_and_read_back(spark):
    out = shared_dir(spark, "t_fanout")
    lines = ["King Lear the first", "", "nothing", "the end of the play", None]
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = _lines(spark, lines).repartition(3).mapInArrow(seen, "line string")
    rows = write_outputs(df, fanout_outputs(), out)
    assert rows == {"lines": 5, "word_counts": 5, "flatmap_lines": 2, "filter_lines": 2}
    assert reads.value == len(lines)  # the input was computed once
    got = sorted(map(tuple, read_outputs(spark, out).collect()))
    hits = ["King Lear the first", "the end of the play"]
    assert got == sorted([("lines", x or "") for x in lines] + [("word_counts", n) for n in ("4", "0", "1", "5", "")]
                         + [(o, x) for o in ("flatmap_lines", "filter_lines") for x in hits])
    # A second run replaces what the first wrote.
    assert write_outputs(_lines(spark, ["x"]), fanout_outputs(), out)["lines"] == 1
    assert sorted(map(tuple, read_outputs(spark, out).collect())) == [("lines", "x"), ("word_counts", "1")]


def test_outputs_need_one_scan_and_no_exchange(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnRenamed("text", "line")
    plan = tag_outputs(d, fanout_outputs())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan


def test_outputs_with_bad_names_are_refused(spark):
    for names in ({"a/b": F.array("line")}, {}):
        with pytest.raises(ValueError):
            write_outputs(_lines(spark, ["x"]), names, "unused")


def _volumes(spark, items, capacity, **kw):
    df = spark.createDataFrame(items, "s string, id long, n int")
    return [tuple(r) for r in volumes(df, "s", "id", "n", capacity, **kw).orderBy("s", "part", "id", "volume").collect()]


def test_generator_keeps_its_open_volume_between_rows(spark):
    got = _volumes(spark, [("a", 3, 4), ("a", 1, 6), ("a", 2, 4), ("b", 1, 25), ("b", 2, 5), ("a", 4, 0), ("a", 5, None)], 10)
    assert got == [("a", 0, 1, 0, 0, 6, 0), ("a", 0, 2, 0, 0, 4, 6), ("a", 0, 3, 1, 0, 4, 0),
                   ("b", 0, 1, 0, 0, 10, 0), ("b", 0, 1, 1, 10, 10, 0), ("b", 0, 1, 2, 20, 5, 0), ("b", 0, 2, 2, 0, 5, 5)]


def test_generator_on_nulls_parts_and_no_rows(spark):
    got = _volumes(spark, [(None, None, 3), (None, 1, 3), (None, 7, 3), ("a", -1, 3), ("a", 1, 3)], 10, part_ids=5)
    assert got == [(None, None, None, 0, 0, 3, 0), (None, 0, 1, 0, 0, 3, 0), (None, 1, 7, 0, 0, 3, 0),
                   ("a", -1, -1, 0, 0, 3, 0), ("a", 0, 1, 0, 0, 3, 0)]
    assert _volumes(spark, [], 10) == []


def test_generator_states_what_it_needs(spark):
    df = spark.createDataFrame([("a", 1, "x")], "s string, id long, n string")
    with pytest.raises(Exception, match="capacity"):
        volumes(df, "s", "id", F.length("n"), 0)


def test_generator_spreads_one_large_shelf_over_parts(spark):
    df = spark.range(5000).selectExpr("'hot' AS s", "id", "7 AS n")
    got = volumes(df, "s", "id", "n", 100)
    assert got.select("part").distinct().count() == 5 and got.count() == 5000
    assert got.groupBy("part", "volume").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] == 98
