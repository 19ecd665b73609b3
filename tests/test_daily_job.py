"""The daily customer job: one day in, one dated partition out, re-runnable."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.quality import GateFailed
from tessera.plans.customer import run_daily_etl
from tessera.session import shared_dir
from tessera.sinks.files import write_parquet
from tessera.sources.synth import synth_transactions


def test_daily_job_replaces_only_its_day(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    txn = synth_transactions(orders).withColumn("dt", F.to_date("timestamp"))
    src, out = shared_dir(spark, "txn_by_day"), shared_dir(spark, "daily_out")
    write_parquet(txn, src, partition_by=["dt"], within=["transaction_id"])
    days = [r["dt"].isoformat() for r in txn.select("dt").distinct().orderBy("dt").limit(2).collect()]
    n1 = run_daily_etl(spark, src, out, days[0], "t_daily")
    n2 = run_daily_etl(spark, src, out, days[1], "t_daily")
    again = run_daily_etl(spark, src, out, days[0], "t_daily")       # re-run of day 1
    assert again == n1
    table = spark.table("t_daily")
    per_day = {r["dt"].isoformat(): r["n"] for r in table.groupBy("dt").agg(F.count("*").alias("n")).collect()}
    assert per_day == {days[0]: n1, days[1]: n2}
    want = txn.where(F.col("dt") == days[0]).select("customer_id").distinct().count()
    assert n1 == want
    with pytest.raises(GateFailed):
        run_daily_etl(spark, src, out, "1900-01-01", "t_daily")


def test_an_emptied_day_is_emptied_and_fails_the_gate(spark):
    from tessera.sources.tables import read_day
    txn = synth_transactions(spark.read.parquet("/root/testdata/sf0.001/orders.parquet")).withColumn("dt", F.to_date("timestamp"))
    days = [r["dt"].isoformat() for r in txn.select("dt").distinct().orderBy("dt").limit(2).collect()]
    src, out, less = (shared_dir(spark, n) for n in ("txn_full", "daily_emptied", "txn_less"))
    write_parquet(txn, src, partition_by=["dt"], within=["transaction_id"])
    write_parquet(txn.where(F.col("dt") != days[0]), less, partition_by=["dt"], within=["transaction_id"])
    assert run_daily_etl(spark, src, out, days[0], "t_emptied") > 0
    n2 = run_daily_etl(spark, src, out, days[1], "t_emptied")
    with pytest.raises(GateFailed):
        run_daily_etl(spark, less, out, days[0], "t_emptied")
    assert read_day(spark, out, days[0]).count() == 0
    assert spark.table("t_emptied").count() == n2


def test_mean_and_cost_are_not_rounded_before_the_end(spark, tmp_path):
    from tessera.operators.summaries import customer_daily_summary
    from tessera.plans.billing import cost_by_activity
    df = spark.createDataFrame([(1, 1, "a", "x", 0.004), (1, 2, "a", "x", 0.004)],
                               "customer_id bigint, transaction_id bigint, category string, payment_method string, amount double")
    assert customer_daily_summary(df).first()["avg_transaction_amount"] == pytest.approx(0.004)
    for t in ("lineitem", "part"):
        d = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        if t == "lineitem":
            d = d.withColumn("l_extendedprice", F.lit(0.004))
        d.write.parquet(str(tmp_path / f"{t}.parquet"))
    lines = spark.read.parquet(str(tmp_path / "lineitem.parquet"))
    total = sum(r["total_cost_usd"] for r in cost_by_activity(spark, str(tmp_path)).collect())
    n = lines.where("l_shipdate BETWEEN TIMESTAMP_NTZ '2001-10-02' AND TIMESTAMP_NTZ '2001-11-01'").count()
    assert 0 < total <= 0.004 * n + 0.03


def test_daily_mean_is_avg(spark, duck):
    from tessera.plans.customer import customer_etl
    got = {r["customer_id"]: r["avg_transaction_amount"] for r in customer_etl(spark, "/root/testdata/sf0.001").collect()}
    want = dict(duck.execute("SELECT o_custkey, AVG(o_totalprice) FROM orders GROUP BY 1").fetchall())
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
