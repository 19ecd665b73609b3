"""Append ingest (T2): JSON documents -> table with ingest time, plus a
reject table with the reason, one ``foreachBatch`` per micro-batch.

Each micro-batch overwrites only its own (``stream_id``, ``batch_id``) partition
(dynamic partition overwrite), so replaying a batch after a failure rewrites
the same files instead of appending duplicates. The stream id is the one that
the checkpoint folder keeps: a second stream into the same table, or a new
checkpoint, whose batches start at 0 again, adds its rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.files import CORRUPT
from tessera.sources.landing import API_DOC_SCHEMA

MALFORMED = "malformed json"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint folder."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def _write_batch(out: str, rejects: str, checkpoint: str):
    def run(df, batch_id: int):
        df = df.withColumns({"inserted_at": F.current_timestamp(),
                             "stream_id": F.lit(stream_id(df.sparkSession, checkpoint)),
                             "batch_id": F.lit(batch_id).cast("bigint")}).persist()
        try:
            good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
            bad = df.where(F.col(CORRUPT).isNotNull()).select(
                F.col(CORRUPT).alias("raw"), F.lit(MALFORMED).alias("reject_reason"),
                "inserted_at", "stream_id", "batch_id")
            for frame, path in ((good, out), (bad, rejects)):
                (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("stream_id", "batch_id").parquet(path))
        finally:
            df.unpersist()
    return run


def ingest_append(spark: SparkSession, landing: str, out: str, rejects: str,
                  checkpoint: str, schema=API_DOC_SCHEMA, available_now: bool = True,
                  max_files_per_batch: int = 1000):
    full = schema
    if CORRUPT not in schema.fieldNames():
        full = StructType(list(schema.fields)).add(CORRUPT, "string")
    stream = (spark.readStream.schema(full).option("mode", "PERMISSIVE")
              .option("maxFilesPerTrigger", max_files_per_batch)
              .option("columnNameOfCorruptRecord", CORRUPT).json(landing))
    w = (stream.writeStream.foreachBatch(_write_batch(out, rejects, checkpoint))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
