"""Gates, schema contract, scan budget and the policy audit."""

import pytest
from pyspark.sql.types import LongType, StructField, StructType

from tessera.operators.policy import location_violations
from tessera.operators.quality import (GateFailed, enforce_schema, require_nonempty,
                                       require_positive_total, require_scan_under,
                                       require_truthy, scanned_bytes)


def test_truthy_gate(spark):
    assert require_truthy(spark.createDataFrame([(3,)], "n bigint"))
    with pytest.raises(GateFailed):
        require_truthy(spark.createDataFrame([(0,)], "n bigint"))
    with pytest.raises(GateFailed):
        require_nonempty(spark.createDataFrame([], "n bigint"))
    with pytest.raises(GateFailed):
        require_positive_total(spark.createDataFrame([(0,), (0,)], "n bigint"), "n")
    assert require_positive_total(spark.createDataFrame([(0,), (2,)], "n bigint"), "n").count() == 2


def test_schema_contract(spark):
    contract = StructType([StructField("k", LongType(), True), StructField("n", LongType(), False)])
    ok = spark.createDataFrame([(1, 2)], "k bigint, n bigint")
    assert enforce_schema(ok, contract).columns == ["k", "n"]
    with pytest.raises(GateFailed):
        enforce_schema(spark.createDataFrame([(1, None)], "k bigint, n bigint"), contract)
    with pytest.raises(GateFailed):
        enforce_schema(spark.createDataFrame([(1, 2)], "k bigint, n int"), contract)


def test_scan_budget_counts_only_pruned_files(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 4 AS dt")
    df.write.partitionBy("dt").parquet(str(tmp_path / "t"))
    root = str(tmp_path / "t")
    listed = scanned_bytes(spark, root, "dt = 1")
    full, one = scanned_bytes(spark, root).first()["scanned_bytes"], listed.first()["scanned_bytes"]
    assert 0 < one < full
    assert require_scan_under(spark, root, full, "dt = 1") == one
    with pytest.raises(GateFailed):
        require_scan_under(spark, root, one)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "PartitionFilters: [isnotnull(dt" in plan


def test_policy_null_location_is_reported(spark):
    df = spark.createDataFrame(
        [("CREATE", "bucket", "us-central1-a"), ("CREATE", "bucket", "europe-west1-b"),
         ("CREATE", "bucket", None), ("UPDATE", "bucket", "asia-east1-a"),
         ("CREATE", "other", "asia-east1-a")],
        "method string, resource_type string, location string")
    got = {r["location"] for r in location_violations(df, "us-central1").collect()}
    assert got == {"europe-west1-b", None}


def test_inline_contract_fails_the_job(spark):
    contract = StructType([StructField("k", LongType(), True), StructField("n", LongType(), False)])
    ok = enforce_schema(spark.createDataFrame([(1, 2)], "k bigint, n bigint"), contract, inline=True)
    assert ok.collect()[0]["n"] == 2
    bad = enforce_schema(spark.createDataFrame([(1, None)], "k bigint, n bigint"), contract, inline=True)
    with pytest.raises(Exception, match="NULL in required column n"):
        bad.collect()


def test_latest_partitions_respects_the_scan_budget(spark, tmp_path):
    from tessera.operators.topk import latest_partitions
    df = spark.range(400).selectExpr("id", "CAST(date_add(DATE '2024-01-01', CAST(id % 8 AS INT)) AS DATE) AS dt")
    df.write.partitionBy("dt").parquet(str(tmp_path / "p"))
    root = str(tmp_path / "p")
    top = latest_partitions(spark, root, "dt", 5, tiebreak=["id"], max_scan_bytes=10 ** 9).collect()
    assert [r["id"] for r in top] == [7, 15, 23, 31, 39]
    assert {r["dt"].isoformat() for r in top} == {"2024-01-08"}
    with pytest.raises(GateFailed):
        latest_partitions(spark, root, "dt", 5, max_scan_bytes=10)
    # more rows asked than the newest days hold: older days are read too
    assert len(latest_partitions(spark, root, "dt", 120).collect()) == 120
    assert len(latest_partitions(spark, root, "dt", 1000).collect()) == 400


def test_latest_partitions_passes_over_empty_files(spark, tmp_path):
    from tessera.operators.topk import latest_partitions
    root = str(tmp_path / "e")
    spark.range(6).coalesce(1).write.parquet(f"{root}/dt=2024-01-01")
    spark.range(6).where("id > 9").write.parquet(f"{root}/dt=2024-01-02")
    assert len(latest_partitions(spark, root, "dt", 2, tiebreak=["id"]).collect()) == 2
