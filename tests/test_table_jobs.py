"""Table swap, whole documents as files, mergeable distinct counts, sorted storage."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tessera.operators.bitmaps import daily_bitmaps, distinct_in_windows, number_items
from tessera.session import shared_dir
from tessera.sinks.documents import read_whole_documents, write_documents
from tessera.sinks.files import write_sorted
from tessera.sinks.manifest import Files
from tessera.sinks.tables import replace_table


@pytest.fixture()
def numbers(spark):
    """A table of the numbers 0 to 9, and the folder of its versions."""
    name, base = "t_replaced", shared_dir(spark, "t_replaced")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    replace_table(spark.range(10), name, base)
    yield name, base
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_a_table_is_replaced_from_itself(spark, numbers):
    name, base = numbers
    reading = spark.table(name)
    reading.count()
    for k in range(1, 4):
        replace_table(spark.table(name).where(f"id >= {k}"), name, base)
        assert _ids(spark.table(name)) == list(range(k, 10))
        if k == 1:
            assert _ids(reading) == list(range(10))  # a reader that began before the swap
    assert len(Files(spark, base).names()) == 2  # the contents and those before


def test_a_failing_write_leaves_the_table(spark, numbers):
    name, base = numbers
    bad = spark.table(name).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        replace_table(bad, name, base)
    assert _ids(spark.table(name)) == list(range(10))
    replace_table(spark.table(name).where("id > 3"), name, base)
    assert _ids(spark.table(name)) == list(range(4, 10))


def test_columns_may_change_and_contents_may_vanish(spark, numbers):
    name, base = numbers
    replace_table(spark.table(name).selectExpr("CAST(id AS STRING) AS id", "1 AS more"), name, base)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 10
    replace_table(spark.table(name).limit(0), name, base)
    assert spark.table(name).count() == 0


def test_documents_are_one_indented_file_each(spark):
    out = shared_dir(spark, "t_docs")
    df = spark.createDataFrame([("2024-01-01", "r1", [1, 2]), ("2024-01-01", "r2", []), ("2024-01-02", "r1", None)],
                               "dt string, run_id string, items array<int>")
    write_documents(df, out, F.struct("run_id", "items"))
    at = Files(spark, out)
    names = at.names("dt=2024-01-01/run_id=r1")
    assert len([n for n in names if n.startswith("part-")]) == 1
    text = at.read(f"dt=2024-01-01/run_id=r1/{[n for n in names if n.startswith('part-')][0]}")
    assert text.count("\n") > 3 and json.loads(text) == {"run_id": "r1", "items": [1, 2]}
    got = read_whole_documents(spark, out, "run_id string, items array<int>").collect()
    assert sorted((r.dt, r.run_id, r.doc["items"], r.problem) for r in got) == [
        ("2024-01-01", "r1", [1, 2], None), ("2024-01-01", "r2", [], None), ("2024-01-02", "r1", None, None)]


def test_damaged_documents_keep_their_place(spark):
    out = shared_dir(spark, "t_docs")
    texts = {"a": '{"n": 1,\n "s": "x"}', "b": '{"n": 1', "c": "", "d": " \n\t ", "e": '{"n": "no number"}', "f": "[1, 2]", "g": "plain words",
             "h": '{"other": 1}'}
    df = spark.createDataFrame([("2024-01-01", k, v) for k, v in texts.items()], "dt string, run_id string, text string")
    write_documents(df, out, "text", pretty=False)
    stream = Files(spark, out)
    stream.publish("dt=2024-01-01/run_id=i/part-x.txt", "")
    write = stream._fs.create(stream.path("dt=2024-01-01/run_id=j/part-y.txt"))
    write.write(bytearray(b'{"s": "\xff\xfe"}'))
    write.close()
    got = {r.run_id: r for r in read_whole_documents(spark, out, "n int, s string").collect()}
    assert {k: r.problem for k, r in got.items()} == {
        "a": None, "b": "damaged", "c": "empty", "d": "empty", "e": "damaged", "f": "damaged", "g": "damaged", "h": None, "j": "bad utf8"}  # Spark opens no file of zero bytes (i)
    assert got["a"].doc.n == 1 and got["h"].doc.n is None and got["b"].doc is None
    assert got["b"].raw.startswith('{"n": 1') and "run_id=b" in got["b"].path and got["j"].raw is None


def test_items_are_numbered_densely(spark):
    df = spark.range(500).selectExpr("CAST(id * 37 % 211 AS STRING) AS item").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS item"))
    got = number_items(df, "item", parts=16).collect()
    assert sorted(r.number for r in got) == list(range(211)) and len({r.item for r in got}) == 211
    assert number_items(df.limit(0), "item").count() == 0


def test_windows_of_bitmaps_equal_distinct_counts(spark):
    first = datetime.date(2024, 1, 1)
    rows = [(i * i % 97 + 40_000 * (i % 3), "ab"[i % 2], first + datetime.timedelta(i % 50)) for i in range(900)]
    df = spark.createDataFrame([*rows, (None, "a", first)], "number long, g string, day date")
    daily = daily_bitmaps(df, "day", ["g"], "number")
    assert daily.select("bucket").distinct().count() > 2
    ends = [datetime.date(2024, 1, 5), datetime.date(2024, 1, 31), datetime.date(2024, 3, 1)]
    got = {(r.as_of, r.days, r.g): r["items"] for r in distinct_in_windows(
        daily, spark.createDataFrame([(e,) for e in ends], "as_of date"), (1, 7, 30), ["g"]).collect()}
    want = {}
    for e in ends:
        for w in (1, 7, 30):
            for n, g, d in rows:
                if 0 <= (e - d).days < w:
                    want.setdefault((e, w, g), set()).add(n)
    assert got == {k: len(v) for k, v in want.items()}


def _scanned(df):
    """Rows that the scans of a finished query gave on, from its plan."""
    plan = df._jdf.queryExecution().executedPlan()
    seen, todo = 0, [plan]
    while todo:
        p = todo.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            todo.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan"):
            seen += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return seen


def test_sorted_files_let_a_range_skip_most_rows(spark):
    out = shared_dir(spark, "t_sorted")
    df = spark.range(200_000).selectExpr("id * 7919 % 200000 AS t", "id", "md5(CAST(id AS STRING)) AS pad")
    write_sorted(df, out, ["t", "id"], files=4, group_bytes=200_000)
    read = spark.read.parquet(out)
    assert len({f.rsplit("/", 1)[1] for f in read.inputFiles()}) == 4
    hour = read.where("t BETWEEN 120000 AND 120999")
    assert len(hour.collect()) == 1000
    assert 1000 <= _scanned(hour) < 20_000
    flat = shared_dir(spark, "t_flat")
    df.write.parquet(flat)
    plain = spark.read.parquet(flat).where("t BETWEEN 120000 AND 120999")
    assert len(plain.collect()) == 1000 and _scanned(plain) == 200_000
