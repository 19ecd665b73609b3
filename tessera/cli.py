"""Command-line jobs for ``spark-submit`` (or ``python -m tessera.cli``).

    customer-etl   --input_path P --output_path O --date YYYY-MM-DD [--table T]
    ingest-logs    --landing L --output_path O --checkpoint C [--rejects R]
    ingest-append  --landing L --output_path O --rejects R --checkpoint C
    export-csv     --input_path P --output_path O --date YYYY-MM-DD

Each job uses the session it is given by the cluster (``getOrCreate``); the
checkpoint locations must be on storage shared by all executors.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):       # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _customer_etl(spark: SparkSession, a) -> int:
    from tessera.plans.customer import load_day

    src = spark.read.parquet(a.input_path)
    day = F.lit(a.date).cast("date")
    if "dt" in src.columns:                      # dated folders: partition pruning
        src = src.where(F.col("dt") == day)
    elif "timestamp" in src.columns:             # flat files: filter on the event day
        src = src.where(F.to_date("timestamp") == day)
    load_day(spark, src, a.output_path, a.date, a.table)
    return 0


def _ingest_logs(spark: SparkSession, a) -> int:
    from tessera.streaming.log_ingest import ingest_logs
    ingest_logs(spark, a.landing, a.output_path, a.checkpoint, rejects=a.rejects)
    return 0


def _ingest_append(spark: SparkSession, a) -> int:
    from tessera.streaming.append_ingest import ingest_append
    ingest_append(spark, a.landing, a.output_path, a.rejects, a.checkpoint)
    return 0


def _export_csv(spark: SparkSession, a) -> int:
    from tessera.operators.quality import require_nonempty
    from tessera.sinks.files import write_csv
    src = spark.read.parquet(a.input_path)
    require_nonempty(src.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0), a.input_path)
    write_csv(src, f"{a.output_path.rstrip('/')}/dt={a.date}")
    return 0


def main(argv=None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("customer-etl")
    p.add_argument("--input_path", required=True)
    p.add_argument("--output_path", required=True)
    p.add_argument("--date", required=True)
    p.add_argument("--table")
    p = sub.add_parser("ingest-logs")
    p.add_argument("--landing", required=True)
    p.add_argument("--output_path", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--rejects")
    p = sub.add_parser("ingest-append")
    p.add_argument("--landing", required=True)
    p.add_argument("--output_path", required=True)
    p.add_argument("--rejects", required=True)
    p.add_argument("--checkpoint", required=True)
    p = sub.add_parser("export-csv")
    p.add_argument("--input_path", required=True)
    p.add_argument("--output_path", required=True)
    p.add_argument("--date", required=True)
    a = ap.parse_args(argv)
    if spark is None:
        from tessera.session import build_session
        spark = build_session(app=f"tessera-{a.job}")
    jobs = {"customer-etl": _customer_etl, "ingest-logs": _ingest_logs,
            "ingest-append": _ingest_append, "export-csv": _export_csv}
    return jobs[a.job](spark, a)


if __name__ == "__main__":
    sys.exit(main())
