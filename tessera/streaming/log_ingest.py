"""Log ingest (T1): message envelopes -> decoded JSON entries in dated folders.

One stateless Structured Streaming query: each micro-batch is decoded once, its
entries go to ``dt=`` folders and its undecodable envelopes, with their reason,
to the reject folder. Both are written to partitions of the stream and batch
(see ``append_ingest``), so a restart or a lost executor neither duplicates nor
drops a row. The query's progress reports how many envelopes and rejects each
batch held (observed metrics ``log_ingest``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.functions.envelope import decode_envelope
from tessera.sinks.files import TS_FORMATS, layout_for_partitions
from tessera.sources.landing import ENVELOPE_SCHEMA
from tessera.sources.tables import read_events_stream
from tessera.streaming.append_ingest import stream_id


def _write_batch(out: str, rejects: str, checkpoint: str):
    def run(df, batch_id: int):
        df = df.withColumns({"stream_id": F.lit(stream_id(df.sparkSession, checkpoint)),
                             "batch_id": F.lit(batch_id).cast("bigint")}).persist()
        try:
            good = df.where(F.col("reject_reason").isNull()).select(
                "event_id", "publish_time", "payload",
                F.to_date("publish_time").alias("dt"), "stream_id", "batch_id")
            bad = df.where(F.col("reject_reason").isNotNull()).select(
                "event_id", "publish_time", "data", F.col("message.data").alias("message_data"),
                "reject_reason", "stream_id", "batch_id")
            # Few files in each day's folder, however many tasks read the batch.
            good = layout_for_partitions(good, ["dt"], ["event_id"])
            for frame, path, by in ((good, out, ("dt", "stream_id", "batch_id")),
                                    (bad, rejects, ("stream_id", "batch_id"))):
                (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .options(**TS_FORMATS).partitionBy(*by).json(path))
        finally:
            df.unpersist()
    return run


def ingest_logs(spark: SparkSession, landing: str, out: str, checkpoint: str,
                schema=ENVELOPE_SCHEMA, available_now: bool = True,
                max_files_per_batch: int = 1000, rejects: str | None = None):
    """Decoded entries go to ``out`` by day, undecodable envelopes to
    ``rejects`` (``<out>_rejects`` unless named)."""
    # Bounded micro-batches: a large backlog is split into several batches
    # (availableNow honours the limit) instead of one batch over every file.
    stream = read_events_stream(spark, landing, schema, "json", max_files_per_batch, TS_FORMATS)
    decoded = decode_envelope(stream).drop("entry").observe(
        "log_ingest", F.count(F.lit(1)).alias("envelopes"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejects"))
    rejects = rejects or f"{out.rstrip('/')}_rejects"
    w = (decoded.writeStream.foreachBatch(_write_batch(out, rejects, checkpoint))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
