"""The command-line jobs, run in-process on the test session."""

from pyspark.sql import functions as F

from tessera.cli import main
from tessera.session import shared_dir
from tessera.sinks.files import write_parquet
from tessera.sources.synth import synth_transactions

SF = "/root/testdata/sf0.001"


def test_customer_etl_job_on_flat_and_dated_input(spark):
    txn = synth_transactions(spark.read.parquet(f"{SF}/orders.parquet"))
    flat = shared_dir(spark, "cli_flat")
    write_parquet(txn, flat)
    day = txn.select(F.to_date("timestamp").alias("d")).first()["d"].isoformat()
    out = shared_dir(spark, "cli_out")
    assert main(["customer-etl", "--input_path", flat, "--output_path", out,
                 "--date", day, "--table", "cli_summary"], spark) == 0
    got = spark.table("cli_summary").where(F.col("dt") == day).count()
    want = txn.where(F.to_date("timestamp") == day).select("customer_id").distinct().count()
    assert got == want > 0


def test_export_csv_job(spark):
    out = shared_dir(spark, "cli_csv")
    assert main(["export-csv", "--input_path", f"{SF}/customer.parquet", "--output_path", out,
                 "--date", "2024-02-01"], spark) == 0
    back = spark.read.option("header", True).csv(f"{out}/dt=2024-02-01")
    assert back.count() == spark.read.parquet(f"{SF}/customer.parquet").count()
