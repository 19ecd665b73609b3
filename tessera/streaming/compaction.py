"""Compaction of an ingested log: closed days as few files, seen through a manifest.

The log ingest adds a folder for each (day, stream, batch). ``compact`` rewrites closed days into few files of about
``file_bytes``, in one Spark job over all days that have something new, and then publishes a manifest. For each day it says
which folder holds the compacted rows, and up to which batch of each stream they are in it. (A stream's batches are numbered in
order and a replayed batch holds the same rows, so a batch number bounds them all.) ``read_log`` reads the compacted
folders and the batch folders that they do not cover: rows that arrive late for a closed day are seen at once, and
compacted next time.

A job that stops

* before the manifest appears leaves a folder that no manifest names: readers see the earlier set;
* after it leaves folders that the manifest covers: readers no longer look at them.

``vacuum`` deletes both kinds: batch folders that already the manifest before the latest covers, so that readers which
began with that one finish, and compacted folders that neither names. One compaction runs at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tessera.sinks import manifest
from tessera.sinks.files import TS_FORMATS, layout_for_partitions
from tessera.sinks.manifest import Files

COMPACTED = "_compacted"
FILE_BYTES = 128 << 20
_KEYS = ("dt", "stream_id", "batch_id")


def _value(folder: str, key: str) -> str | None:
    return folder[len(key) + 1:] if folder.startswith(key + "=") else None


def _days(files: Files) -> list[str]:
    return [d for n in files.names() if (d := _value(n, "dt")) is not None]


def _batches(files: Files, day: str, covered: dict[str, int]) -> dict[str, list[int]]:
    """The day's batch folders, by stream, that ``covered`` (stream -> last batch) does not reach."""
    out = {}
    for s in files.names(f"dt={day}"):
        if (stream := _value(s, "stream_id")) is not None:
            new = [int(b) for n in files.names(f"dt={day}/{s}") if (b := _value(n, "batch_id")) is not None
                   and int(b) > covered.get(stream, -1)]
            if new:
                out[stream] = sorted(new)
    return out


def _folders(files: Files, day: str, batches: dict[str, list[int]]) -> list[str]:
    return [f"{files.root}/dt={day}/stream_id={s}/batch_id={b}" for s, bs in batches.items() for b in bs]


def _read(spark: SparkSession, files: Files, days: dict[str, dict], batches: dict[str, dict[str, list[int]]], schema: str) -> DataFrame:
    """Rows of compacted days (their entries of the manifest) and of batch folders, with ``dt``."""
    reader = spark.read.schema(f"{schema}, dt DATE").options(**TS_FORMATS)
    parts = []
    if days:
        parts.append(reader.option("basePath", f"{files.root}/{COMPACTED}").json(
            [f"{files.root}/{e['folder']}/dt={d}" for d, e in sorted(days.items())]))
    if raw := [f for d, b in batches.items() for f in _folders(files, d, b)]:
        parts.append(reader.option("basePath", files.root).json(raw))
    if not parts:
        return spark.createDataFrame([], f"{schema}, dt DATE")
    columns = [*StructType.fromDDL(schema).names, "dt"]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def read_log(spark: SparkSession, root: str, schema: str, from_day: str | None = None, to_day: str | None = None) -> DataFrame:
    """The log's rows, columns ``schema`` and ``dt``: compacted days and what came after. Only the days asked for are listed."""
    files = Files(spark, root)
    _, known = manifest.load(files)

    def asked(d: str) -> bool:
        return (from_day is None or d >= from_day) and (to_day is None or d <= to_day)

    days = {d: e for d, e in known.items() if asked(d)}
    raw = {d: _batches(files, d, days.get(d, {}).get("through", {})) for d in _days(files) if asked(d)}
    return _read(spark, files, days, {d: b for d, b in raw.items() if b}, schema)


def compact(spark: SparkSession, root: str, schema: str, closed_before: str, key: str,
            file_bytes: int = FILE_BYTES, before_publishing: Callable[[], None] = lambda: None) -> list[str]:
    """Rewrite the days before ``closed_before`` (yyyy-mm-dd) that have batches of their own; returns them.

    ``key`` tells rows apart and deals a large day over several tasks and files. ``before_publishing``
    runs between the written files and the manifest (a check of what was written, for example).
    """
    files = Files(spark, root)
    version, known = manifest.load(files)
    todo = {d: b for d in _days(files) if d < closed_before
            if (b := _batches(files, d, known.get(d, {}).get("through", {})))}
    if not todo:
        return []
    before = {d: known[d] for d in todo if d in known}
    folder = f"{COMPACTED}/run={uuid.uuid4().hex}"
    # Sizes of the folders that are read, so that each day gets its number of files.
    size = {d: sum(files.size(f[len(files.root) + 1:]) for f in _folders(files, d, b)) + before.get(d, {}).get("bytes", 0)
            for d, b in todo.items()}
    counts = spark.createDataFrame([(d, max(1, -(-n // file_bytes))) for d, n in size.items()], "day string, files long")
    rows = _read(spark, files, before, todo, schema).join(F.broadcast(counts), F.col("dt").cast("string") == F.col("day"))
    dealt = layout_for_partitions(rows.withColumn("file", F.pmod(F.xxhash64(key), F.col("files"))), ["dt", "file"])
    (dealt.drop("day", "files", "file").write.mode("overwrite").options(**TS_FORMATS)
     .option("partitionOverwriteMode", "static").partitionBy("dt").json(f"{files.root}/{folder}"))
    before_publishing()
    entry = {d: {"folder": folder, "bytes": size[d],
                 "through": {**known.get(d, {}).get("through", {}), **{s: bs[-1] for s, bs in b.items()}}} for d, b in todo.items()}
    manifest.commit(files, version, {**known, **entry})
    return sorted(todo)


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete what no reader of the latest two manifests looks at; returns the number of folders."""
    files = Files(spark, root)
    version, known = manifest.load(files)
    if not version:
        return _delete(files, [f"{COMPACTED}/{n}" for n in files.names(COMPACTED)])
    there = manifest.versions(files)
    earlier = manifest.load(files, there[-2])[1] if len(there) > 1 else {}
    gone = []
    for day in _days(files):
        through = earlier.get(day, {}).get("through", {})
        for s in files.names(f"dt={day}") if through else []:
            stream = _value(s, "stream_id")
            old = [n for n in files.names(f"dt={day}/{s}") if (b := _value(n, "batch_id")) is not None
                   and int(b) <= through.get(stream, -1)]
            gone += [f"dt={day}/{s}/{n}" for n in old]
    used = {e["folder"] for m in (known, earlier) for e in m.values()}
    gone += [f for n in files.names(COMPACTED) if (f := f"{COMPACTED}/{n}") not in used]
    manifest.forget(files, keep=2)
    return _delete(files, gone)


def _delete(files: Files, folders: list[str]) -> int:
    for f in folders:
        files.delete(f)
    return len(folders)
