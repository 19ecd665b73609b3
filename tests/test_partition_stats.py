"""Dated partitions with statistics: what the writer knows, crashes between its steps, daily loads and their gate."""

import datetime

import pytest
from pyspark.sql import functions as F

from tessera.operators.quality import GateFailed, data_files
from tessera.plans.customer import load_days
from tessera.session import shared_dir
from tessera.sinks import partition_stats as ps
from tessera.sinks.manifest import Files, load


def _rows(spark, days, n=10, first=0):
    return spark.range(first, first + n * len(days)).select(
        "id", F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % len(days) + 1).cast("int")).cast("date").alias("dt"))


def _stats(spark, root):
    return {str(r.dt): (r.rows, r.files) for r in ps.stats(spark, root).collect()}


def _right(spark, root):
    """The statistics equal the files and the rows that are there."""
    there = {str(r.dt): (r.files, r.bytes) for r in data_files(spark, root).groupBy("dt").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")).collect()}
    assert {str(r.dt): (r.files, r.bytes) for r in ps.stats(spark, root).collect()} == there
    rows = {str(r.dt): r["count"] for r in spark.read.parquet(root).groupBy("dt").count().collect()}
    assert {d: n for d, (n, _) in _stats(spark, root).items()} == rows


def test_statistics_follow_every_write(spark):
    root = shared_dir(spark, "t_stats")
    assert ps.stats(spark, root).count() == 0
    ps.replace_measured(_rows(spark, ["2024-01-01", "2024-01-02", "2024-01-03"]), root, within=["id"])
    _right(spark, root)
    assert ps.replace_measured(_rows(spark, ["2024-01-02", "2024-01-04"], 5), root, emptied=["2024-01-02", "2024-01-03"]) == [
        "dt=2024-01-02", "dt=2024-01-04"]
    _right(spark, root)
    assert {d: n for d, (n, _) in _stats(spark, root).items()} == {"2024-01-01": 10, "2024-01-02": 5, "2024-01-04": 5}
    assert [n for n in Files(spark, root).names() if not n.startswith("dt=")] == ["_manifest", "_staging", "_stats"]
    assert len(Files(spark, root).names("_stats")) == 1 and Files(spark, root).names("_staging") == []


def test_rows_without_a_partition_are_refused(spark):
    root = shared_dir(spark, "t_stats")
    with pytest.raises(Exception, match="no value of dt"):
        ps.replace_measured(spark.range(3).selectExpr("id", "CAST(NULL AS DATE) AS dt"), root)
    assert ps.stats(spark, root).count() == 0


@pytest.mark.parametrize("step", ["move", "delete"])
@pytest.mark.parametrize("after", [0, 1, 2])
def test_a_writer_that_stops_half_way(spark, monkeypatch, step, after):
    root = shared_dir(spark, "t_stats")
    ps.replace_measured(_rows(spark, ["2024-01-01", "2024-01-02"]), root)
    done, original = [], getattr(Files, step)

    def some(self, name, *to):
        if name.startswith(("dt=", "_staging")) and len(done) >= after:
            raise RuntimeError("lost")
        done.append(name)
        return original(self, name, *to)

    monkeypatch.setattr(Files, step, some)
    with pytest.raises(RuntimeError):
        ps.replace_measured(_rows(spark, ["2024-01-01", "2024-01-02", "2024-01-03"], 20, 1000), root)
    monkeypatch.setattr(Files, step, original)
    _right(spark, root)  # partly old, partly new, but measured as it is
    ps.replace_measured(_rows(spark, ["2024-01-01", "2024-01-02", "2024-01-03"], 20, 1000), root)
    _right(spark, root)
    assert {n for n, _ in _stats(spark, root).values()} == {20} and load(Files(spark, root))[1]["pending"] == []


def test_latest_rows_read_only_their_partitions(spark):
    root = shared_dir(spark, "t_stats")
    days = [f"2024-01-{d:02}" for d in range(1, 21)]
    ps.replace_measured(_rows(spark, days, 3), root)
    got = ps.latest_rows(spark, root, 5, order=[F.col("id")])
    assert len(got.inputFiles()) <= 2 * 4 and all("dt=2024-01-20" in f or "dt=2024-01-19" in f for f in got.inputFiles())
    assert [(r.id, str(r.dt)) for r in got.collect()] == [(19, "2024-01-20"), (39, "2024-01-20"), (59, "2024-01-20"), (18, "2024-01-19"), (38, "2024-01-19")]
    assert ps.latest_rows(spark, root, 1000).count() == 60
    with pytest.raises(GateFailed):
        ps.latest_rows(spark, root, 5, max_scan_bytes=10)
    cost = ps.scan_cost(spark, root, F.col("dt") >= F.lit("2024-01-19").cast("date")).first()
    assert (cost.partitions, cost["rows"]) == (2, 6)
    assert ps.require_scan_cost(spark, root, cost.bytes, F.col("dt") >= F.lit("2024-01-19").cast("date")) == cost.bytes
    with pytest.raises(GateFailed):
        ps.require_scan_cost(spark, root, cost.bytes)


def _transactions(spark, day_rows):
    rows = [(c, i, "c", "p", 1.5, datetime.date.fromisoformat(d)) for i, (d, c) in enumerate(day_rows)]
    return spark.createDataFrame(rows, "customer_id long, transaction_id long, category string, payment_method string, amount double, dt date")


def test_daily_loads_of_one_table_over_several_runs(spark):
    root, name = shared_dir(spark, "t_days"), "t_daily_loads"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = _transactions(spark, [("2024-01-01", 1), ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 1)])
    assert load_days(spark, first, root, ["2024-01-01", "2024-01-02"], name) == {"2024-01-01": 2, "2024-01-02": 1}
    second = _transactions(spark, [("2024-01-03", 9), ("2024-01-01", 5)])
    assert load_days(spark, second, root, ["2024-01-03"], name) == {"2024-01-03": 1}  # other days of the input are left out
    again = _transactions(spark, [("2024-01-01", 7)])
    load_days(spark, again, root, ["2024-01-01"], name)
    got = sorted((str(r.dt), r.customer_id, r.unique_transactions) for r in spark.table(name).collect())
    assert got == [("2024-01-01", 7, 1), ("2024-01-02", 1, 1), ("2024-01-03", 9, 1)]
    # A day that lost its rows is emptied, and the gate names it.
    with pytest.raises(GateFailed, match="2024-01-02"):
        load_days(spark, again, root, ["2024-01-01", "2024-01-02"], name)
    assert sorted(str(r.dt) for r in spark.table(name).collect()) == ["2024-01-01", "2024-01-03"]
    # A table that was lost learns of all days at once.
    spark.sql(f"DROP TABLE {name}")
    load_days(spark, again, root, ["2024-01-01"], name)
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_many_partitions_are_added_in_few_statements(spark, monkeypatch):
    from tessera.sources import files
    root, name = shared_dir(spark, "t_days"), "t_many_days"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    days = [str(datetime.date(2024, 1, 1) + datetime.timedelta(d)) for d in range(7)]
    ps.replace_measured(_rows(spark, days), root)
    monkeypatch.setattr(files, "PARTITIONS_AT_ONCE", 3)
    assert files.declare_external(spark, name, root, spark.read.parquet(root).schema)
    assert not files.declare_external(spark, name, root, spark.read.parquet(root).schema)
    files.add_partitions(spark, name, root, days)
    assert spark.table(name).count() == 70 and spark.sql(f"SHOW PARTITIONS {name}").count() == 7
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError):
        files.partition_folder("dt", "a/b")
