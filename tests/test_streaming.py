"""Streaming ingest: exactly-once output across a restart on one checkpoint."""

from pyspark.sql import functions as F

from tessera.plans.ingest import _land_api_docs, _land_envelopes
from tessera.session import shared_dir
from tessera.sources.files import read_json
from tessera.streaming.append_ingest import ingest_append
from tessera.streaming.log_ingest import ingest_logs

SF = "/root/testdata/sf0.001"
SCHEMA = "event_id BIGINT, publish_time TIMESTAMP_NTZ, payload STRING, dt DATE"


def test_log_ingest_rerun_is_idempotent(spark):
    landing = _land_envelopes(spark, SF)
    out, ckpt = shared_dir(spark, "t_log"), shared_dir(spark, "t_log_ckpt")
    ingest_logs(spark, landing, out, ckpt)
    first = read_json(spark, out, SCHEMA).count()
    ingest_logs(spark, landing, out, ckpt)          # restart: nothing new
    assert read_json(spark, out, SCHEMA).count() == first > 0
    events = spark.read.parquet(f"{SF}/events.parquet").count()
    rejected = spark.read.json(out + "_rejects").count()
    assert 0 < rejected and first + rejected == events   # rejects are kept, in the same pass


def test_append_ingest_splits_and_replays(spark):
    landing = _land_api_docs(spark, SF)
    out, rej, ckpt = (shared_dir(spark, n) for n in ("t_api", "t_rej", "t_api_ckpt"))
    ingest_append(spark, landing, out, rej, ckpt)
    good, bad = spark.read.parquet(out), spark.read.parquet(rej)
    n_good, n_bad = good.count(), bad.count()
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert n_good + n_bad == events.count()
    assert n_bad == events.where("event_type = 'error'").count()
    assert set(bad.select("reject_reason").distinct().toPandas()["reject_reason"]) == {"malformed json"}
    assert "inserted_at" in good.columns
    ingest_append(spark, landing, out, rej, ckpt)   # restart: same table
    assert spark.read.parquet(out).count() == n_good


def test_log_ingest_picks_up_only_new_files(spark):
    from pyspark.sql import functions as F

    from tessera.functions.envelope import decode_envelope
    from tessera.sinks.files import write_json
    from tessera.sources.landing import log_envelopes

    events = spark.read.parquet(f"{SF}/events.parquet")
    first, second = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    landing = shared_dir(spark, "t_land")
    out, ckpt = shared_dir(spark, "t_log2"), shared_dir(spark, "t_log2_ckpt")
    write_json(log_envelopes(first), landing)
    ingest_logs(spark, landing, out, ckpt)
    n1 = read_json(spark, out, SCHEMA).count()
    write_json(log_envelopes(second), landing, mode="append")     # new files arrive
    ingest_logs(spark, landing, out, ckpt)
    got = read_json(spark, out, SCHEMA)
    want = decode_envelope(log_envelopes(events)).where(F.col("reject_reason").isNull())
    assert got.count() == want.count() > n1
    assert got.select("event_id").distinct().count() == got.count()   # no duplicates


def test_log_ingest_can_keep_rejects(spark):
    landing = _land_envelopes(spark, SF)
    out, rej, ckpt = (shared_dir(spark, n) for n in ("t_log3", "t_rej3", "t_log3_ckpt"))
    ingest_logs(spark, landing, out, ckpt, rejects=rej)
    good = read_json(spark, out, SCHEMA).count()
    bad = spark.read.schema("event_id BIGINT, reject_reason STRING").json(rej)
    events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert good + bad.count() == events
    assert {r[0] for r in bad.select("reject_reason").distinct().collect()} <= {
        "no data", "bad base64", "bad utf8", "bad json"}


def test_two_checkpoints_into_one_table_add_up(spark):
    from tessera.sinks.files import write_text
    out, rej = shared_dir(spark, "t_two"), shared_dir(spark, "t_two_rej")
    for name, n in (("a", 10), ("b", 4)):
        landing = shared_dir(spark, f"t_land_{name}")
        write_text(spark.range(n).selectExpr(f"concat('{{\"event_id\": ', id, '}}') AS value"), landing)
        for _ in range(2):                       # the second call is a restart
            ingest_append(spark, landing, out, rej, landing + "_ck")
    assert spark.read.parquet(out).count() == 14


def test_envelopes_are_decoded_once(spark):
    from tessera.functions.envelope import decode_envelope
    from tessera.sources.landing import log_envelopes
    df = decode_envelope(log_envelopes(spark.read.parquet(f"{SF}/events.parquet")))
    for result in (df.where("reject_reason IS NULL").select("event_id", "payload"),
                   df.where("reject_reason IS NOT NULL").select("event_id", "reject_reason")):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("try_parse_json") + plan.count("parse_json(") <= 2 and plan.count("to_binary") <= 1, plan


def test_log_ingest_reports_rejects(spark):
    landing = _land_envelopes(spark, SF)
    q = ingest_logs(spark, landing, shared_dir(spark, "t_log4"), shared_dir(spark, "t_log4_ckpt"))
    seen = [p.observedMetrics["log_ingest"] for p in q.recentProgress if p.observedMetrics]
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert sum(r["envelopes"] for r in seen) == events.count()
    assert sum(r["rejects"] for r in seen) > 0
    assert events.agg(F.count("*")).first()[0] > sum(r["rejects"] for r in seen)
