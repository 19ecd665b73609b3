"""Sink/source round trips and their edge cases."""

from pyspark.sql import functions as F

from tessera.plans.elt import elt_clean_dedup
from tessera.session import shared_dir
from tessera.sinks.files import CSV_NULL, write_csv, write_parquet, write_text
from tessera.sources.files import read_csv, read_lines, register_external


def test_csv_keeps_null_empty_quotes_and_newlines(spark):
    rows = [(1, None), (2, ""), (3, 'say "hi"'), (4, "a,b"), (5, "two\nlines")]
    df = spark.createDataFrame(rows, "id bigint, s string")
    out = shared_dir(spark, "t_csv")
    write_csv(df, out, null_value=CSV_NULL)
    back = {r["id"]: r["s"] for r in read_csv(spark, out, df.schema, null_value=CSV_NULL, line_breaks=True).collect()}
    assert back == dict(rows)


def test_text_sink_strips_trailing_cr_only(spark):
    df = spark.createDataFrame([("a\r",), ("b\rc",), ("",)], "line string")
    out = shared_dir(spark, "t_txt")
    write_text(df, out, "line")
    assert sorted(r["value"] for r in read_lines(spark, out).collect()) == ["", "a", "b\rc"]


def test_external_table_drop_keeps_files(spark):
    out = shared_dir(spark, "t_ext")
    write_parquet(spark.range(10).withColumn("dt", F.lit("2024-01-01").cast("date")), out,
                  partition_by=["dt"])
    assert register_external(spark, "t_ext_tbl", out, partitioned=True).count() == 10
    assert register_external(spark, "t_ext_tbl", out, partitioned=True).count() == 10
    spark.sql("DROP TABLE t_ext_tbl")
    assert spark.read.parquet(out).count() == 10


def test_explode_drops_empty_and_null_arrays(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    assert sorted(r["id"] for r in df.select("id", F.explode("a")).collect()) == [1, 1]


def test_dedup_by_clean_date_picks_latest_parsed(spark):
    faithful = {r["transaction_id"]: r["clean_order_date"]
                for r in elt_clean_dedup(spark, "/root/testdata/sf0.001").collect()}
    latest = {r["transaction_id"]: r["clean_order_date"]
              for r in elt_clean_dedup(spark, "/root/testdata/sf0.001", "clean_order_date").collect()}
    assert faithful.keys() == latest.keys()
    assert all(latest[k] is None or faithful[k] is None or latest[k] >= faithful[k] for k in latest)


def test_csv_refuses_nested_columns(spark):
    import pytest
    df = spark.createDataFrame([(1, [1])], "id int, a array<int>")
    with pytest.raises(ValueError):
        write_csv(df, shared_dir(spark, "t_csv_nested"))


def test_partitioned_external_table_needs_partition_discovery(spark):
    out = shared_dir(spark, "t_ext2")
    write_parquet(spark.range(6).withColumn("dt", F.lit("2024-01-02").cast("date")), out,
                  partition_by=["dt"])
    assert register_external(spark, "t_ext_nodisc", out, partitioned=False).count() == 0
    assert register_external(spark, "t_ext_nodisc", out, partitioned=True).count() == 6


def test_malformed_json_lines_are_kept_as_corrupt_records(spark):
    from pyspark.sql.types import LongType, StructField, StructType

    from tessera.sinks.files import write_text
    from tessera.sources.files import CORRUPT, read_documents
    lines = spark.createDataFrame([('{"id": 1}',), ('{"id": 2, "x"',), ('{"id"',)], "value string")
    out = shared_dir(spark, "t_json_bad")
    write_text(lines, out)
    docs = read_documents(spark, out, StructType([StructField("id", LongType())]))
    rows = sorted(docs.collect(), key=lambda r: (r["id"] is None, r["id"] or 0, r[CORRUPT] or ""))
    assert rows[0]["id"] == 1 and rows[0][CORRUPT] is None
    assert [r[CORRUPT] is not None for r in rows[1:]] == [True, True]


def test_overwrite_mode_is_explicit(spark):
    """Static and dynamic overwrites do what they say whatever the session's default."""
    from tessera.sinks.files import replace_folder, replace_partitions
    two = spark.range(8).withColumn("dt", F.when(F.col("id") < 4, "2024-01-01").otherwise("2024-01-02").cast("date"))
    one = two.where("dt = DATE '2024-01-01'")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            out = shared_dir(spark, "t_modes")
            write_parquet(two, out, partition_by=["dt"])
            replace_partitions(one, out, ["dt"], within=["id"])
            assert spark.read.parquet(out).count() == 8
            write_parquet(one, out, partition_by=["dt"])
            assert spark.read.parquet(out).count() == 4
            replace_folder(one.where("id < 0"), out, "dt", "2024-01-01")
            assert spark.read.parquet(out).count() == 0
        finally:
            spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_one_day_is_read_from_its_folder_alone(spark):
    from tessera.sources.tables import read_day
    out = shared_dir(spark, "t_day")
    df = spark.range(10).withColumn("dt", F.when(F.col("id") < 4, "2024-01-01").otherwise("2024-01-02").cast("date"))
    write_parquet(df, out, partition_by=["dt"])
    day = read_day(spark, out, "2024-01-01")
    assert day.schema["dt"].dataType.simpleString() == "date" and day.count() == 4
    assert all("dt=2024-01-01" in f for f in day.inputFiles())
    assert read_day(spark, out, "2030-01-01").count() == 0
