"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; it is written as Parquet and read again for the next one.
All but the last keep the columns of ``docs``. Each stage is one operator of
``tessera.llm`` with its production parameters; see there for the results on
nulls, empty and long texts, ties, repeated rows and empty tables.

No SQL oracle: the classifiers, fingerprints and packing are beyond SQL, so
the stages are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, packing, quality_rules, secret_scan, simhash_dups
from tessera.session import shared_dir
from tessera.sources.tables import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash_dups.keep_one(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words inside a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays."""
    ctx = secret_scan.context(docs)
    return secret_scan.redact(docs, ctx, secret_scan.train(docs, ctx))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into training sequences: one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", keep_distinct),
    ("benchmark_decontamination", keep_uncontaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
