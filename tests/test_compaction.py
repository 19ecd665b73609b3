"""Compaction of the ingested log: same rows at any point, few files, whatever stops half-way."""

import pytest
from pyspark.sql import functions as F

from tessera.plans.ingest import LOG_SCHEMA, _envelopes
from tessera.session import shared_dir
from tessera.sinks import manifest
from tessera.sinks.files import write_json
from tessera.sinks.manifest import Conflict, Files
from tessera.streaming.compaction import compact, read_log, vacuum
from tessera.streaming.log_ingest import ingest_logs

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def log(spark):
    """A log of four batches, and a function that ingests one more batch of late rows."""
    landing, out, ckpt = (shared_dir(spark, n) for n in ("t_land", "t_clog", "t_clog_ckpt"))
    events = _envelopes(spark, SF).where("event_id % 5 < 4").persist()
    write_json(events.where("event_id % 5 < 3").repartition(4), landing)
    ingest_logs(spark, landing, out, ckpt, max_files_per_batch=1)

    def late():
        write_json(events.where("event_id % 5 = 3").coalesce(1), landing, mode="append")
        ingest_logs(spark, landing, out, ckpt)

    return out, late


def _rows(spark, out, **days):
    got = read_log(spark, out, LOG_SCHEMA, **days)
    return sorted((r.event_id, str(r.publish_time), r.payload, str(r.dt)) for r in got.collect())


def _data_files(spark, out, day):
    _, known = manifest.load(Files(spark, out))
    return [n for n in Files(spark, out).names(f"{known[day]['folder']}/dt={day}") if n.startswith("part-")]


def test_same_rows_and_few_files(spark, log):
    out, late = log
    raw = _rows(spark, out)
    assert len(raw) > 300 and compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id") == [f"2024-01-{d:02}" for d in range(1, 20)]
    assert _rows(spark, out) == raw
    assert all(len(_data_files(spark, out, f"2024-01-{d:02}")) == 1 for d in range(1, 20))
    assert compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id") == []  # nothing new
    late()
    more = _rows(spark, out)
    assert len(more) > len(raw) and set(raw) < set(more)  # late rows of closed days are seen at once
    compact(spark, out, LOG_SCHEMA, "2024-01-25", "event_id")
    assert _rows(spark, out) == more
    assert vacuum(spark, out) > 0 and _rows(spark, out) == more
    assert vacuum(spark, out) == 0
    # What the first manifest covered is gone; the batches of later days and of the last run are there.
    assert [r for r in more if r[3] == "2024-01-03"] == _rows(spark, out, from_day="2024-01-03", to_day="2024-01-03")


def test_large_days_are_dealt_over_files(spark, log):
    out, _ = log
    raw = _rows(spark, out)
    compact(spark, out, LOG_SCHEMA, "2024-01-03", "event_id", file_bytes=1000)
    assert len(_data_files(spark, out, "2024-01-02")) >= 2 and _rows(spark, out) == raw


def test_a_run_that_stops_before_the_manifest(spark, log):
    out, late = log
    raw = _rows(spark, out)

    def stop():
        raise RuntimeError("lost")

    for _ in range(2):
        with pytest.raises(RuntimeError):
            compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id", before_publishing=stop)
        assert _rows(spark, out) == raw
    assert len(Files(spark, out).names("_compacted")) == 2
    compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id")
    assert vacuum(spark, out) == 2 and _rows(spark, out) == raw  # folders that no manifest names


def test_a_run_that_stops_after_the_manifest(spark, log, monkeypatch):
    out, late = log
    raw = _rows(spark, out)
    compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id")  # its vacuum never ran
    late()
    more = _rows(spark, out)
    compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id")
    # A vacuum that stops after a few folders; the next one goes on.
    done, delete = [], Files.delete

    def some(self, name):
        if len(done) == 3:
            raise RuntimeError("lost")
        done.append(name)
        delete(self, name)

    monkeypatch.setattr(Files, "delete", some)
    with pytest.raises(RuntimeError):
        vacuum(spark, out)
    monkeypatch.setattr(Files, "delete", delete)
    assert _rows(spark, out) == more and set(raw) < set(more)
    assert vacuum(spark, out) > 0 and _rows(spark, out) == more


def test_a_reader_that_began_with_the_manifest_before(spark, log):
    out, late = log
    compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id")
    reading, rows = read_log(spark, out, LOG_SCHEMA), len(_rows(spark, out))
    late()
    compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id")
    vacuum(spark, out)
    assert reading.count() == rows


def test_two_writers_of_one_version(spark):
    files = Files(spark, shared_dir(spark, "t_manifest"))
    assert manifest.load(files) == (0, {})
    assert manifest.commit(files, 0, {"a": 1}) == 1
    with pytest.raises(Conflict):
        manifest.commit(files, 0, {"a": 2})
    assert manifest.load(files) == (1, {"a": 1}) and files.names("_manifest") == ["0000000001.json"]


def test_an_empty_log(spark):
    out = shared_dir(spark, "t_empty_log")
    assert compact(spark, out, LOG_SCHEMA, "2024-01-20", "event_id") == [] and vacuum(spark, out) == 0
    assert read_log(spark, out, LOG_SCHEMA).agg(F.count("*")).first()[0] == 0
