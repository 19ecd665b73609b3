"""WARC records in ZIP archives: a writer, and a reader that range-reads records.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, one JSON line per record
with its offset and length in that member. The reader never extracts a member:
it reads the end of the file for the (ZIP64) end record, the central directory,
the local headers, the index, and then the records' byte ranges. Records are
dealt out by ranges, so one large archive is read by many tasks.

Writing goes to the shared folder that the cluster names. Each task writes
archives under names of its own attempt, and the list of archives that counts
is the one the finished tasks returned, so a lost executor leaves at worst
unused files. Payloads of at least ``DEDUP_BYTES`` that are equal are stored
once: the page with the smallest id is the response, others revisit it.

Defined results: a null payload is empty; pages with the same id and payload
are responses together if that id is the smallest; pages without an id revisit
one with an id, and are responses if none has; ties, small and empty payloads
are responses; an empty table gives no archive and an empty result. Extra
columns are not read.
"""

from __future__ import annotations

import io
import json
import re
import struct
import urllib.parse
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import column_bytes
from tessera.session import cut_lineage, shared_dir

DEDUP_BYTES = 100
#: Bytes of compressed records after which an archive is closed; a larger record has an archive of its own.
ARCHIVE_BYTES = 32 << 20
#: Bytes of an archive that one read fetches.
RANGE_BYTES = 4 << 20
#: Up to so many repeated payloads (40 bytes each) are broadcast, more are joined by a shuffle.
BROADCAST_ROWS = 500_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

_EOCD, _EOCD64, _LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; ``file:`` names the shared local mount."""
    parsed = urllib.parse.urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), urllib.parse.unquote(parsed.path)
    return fs.FileSystem.from_uri(uri)


# --- records ---------------------------------------------------------------

def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header (names in lower case) and payload."""
    def fields(block: bytes) -> dict[str, str]:
        pairs = (line.split(": ", 1) for line in block.decode().split("\r\n")[1:] if ": " in line)
        return {k.lower(): v for k, v in pairs}

    head, rest = raw.split(b"\r\n\r\n", 1)
    warc = fields(head)
    http, payload = rest[:int(warc["content-length"])].split(b"\r\n\r\n", 1)
    return warc, fields(http), payload


# --- ZIP -------------------------------------------------------------------

def _zip64_extra(extra: bytes, wanted: list[int]) -> list[int]:
    """Values that the ZIP64 extra field holds in place of 32-bit ones at their limit."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            wide = extra[at + 4:at + 4 + n]
        at += 4 + n
    out, at = [], 0
    for v in wanted:
        if v == 0xFFFFFFFF:
            v, at = struct.unpack_from("<Q", wide, at)[0], at + 8
        out.append(v)
    return out


def stored_members(read_at, size: int) -> dict[str, tuple[int, int]]:
    """Data offset and length of each stored member, from range reads: ``read_at(length, offset)``."""
    tail_at = max(0, size - (22 + 0xFFFF + 20))
    tail = read_at(size - tail_at, tail_at)
    end = tail.rfind(_EOCD)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20:end - 16] == _LOCATOR:
        at = struct.unpack_from("<Q", tail, end - 12)[0]
        wide = read_at(56, at)
        if wide[:4] != _EOCD64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", wide, 32)
    directory, at, out = read_at(length, offset), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full, name_n, extra_n, note_n = struct.unpack_from("<IIHHH", directory, at + 20)
        local, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + name_n].decode()
        extra = directory[at + 46 + name_n:at + 46 + name_n + extra_n]
        full, packed, local = _zip64_extra(extra, [full, packed, local])
        if method == 0:
            name_there, extra_there = struct.unpack_from("<HH", read_at(30, local), 26)
            out[name] = (local + 30 + name_there + extra_there, packed)
        at += 46 + name_n + extra_n + note_n
    return out


def _archive(parts: list[bytes], index: list[dict]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as f:
            for p in parts:
                f.write(p)
        z.writestr(zipfile.ZipInfo(INDEX), "".join(json.dumps(x) + "\n" for x in index))
    return out.getvalue()


# --- Spark -----------------------------------------------------------------

def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write all pages below ``folder`` (shared by all executors); returns the list ``path, bytes, records``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    repeated = cut_lineage(rows.where(F.octet_length("html") >= DEDUP_BYTES).groupBy("digest")
                           .agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1").select("digest", "first"))
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    typed = rows.join(repeated, "digest", "left").select(
        "id", "url", "html", "digest", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(folder)
        context = TaskContext.get()
        parts, index, size, n = [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal parts, index, size, n
            name = f"{root}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{n:04d}.wacz"
            data = _archive(parts, index)
            with store.open_output_stream(name) as out:
                out.write(data)
            made = pa.RecordBatch.from_pydict({"path": [name], "bytes": [len(data)], "records": [len(index)]})
            parts, index, size, n = [], [], 0, n + 1
            return made

        for b in batches:
            html = column_bytes(b.column("html"))
            for i, (page, url, digest, refers) in enumerate(zip(*(b.column(c).to_pylist() for c in ("id", "url", "digest", "refers_to")), strict=True)):
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(record(page, url, html[i], digest, refers)) + packer.flush()
                if parts and size + len(data) > ARCHIVE_BYTES:
                    yield close()
                index.append({"offset": size, "length": len(data), "id": page})
                parts.append(data)
                size += len(data)
        if parts:
            yield close()

    store, root = open_fs(folder)
    store.create_dir(root, recursive=True)
    # The list is written down: the archives are those of the attempts that it names.
    return cut_lineage(typed.mapInArrow(run, "path string, bytes long, records long"))


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record: ``page_id, url, payload, record_type, refers_to, http_bytes, stated_digest``.

    ``archives`` has the column ``path``. First the directories and indexes are read, one archive at a time; the
    records are then dealt out by ranges of ``RANGE_BYTES``, and neighbours are fetched by one read.
    """
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_fs(folder)
        for b in batches:
            for path in b.column("path").to_pylist():
                with store.open_input_file(path) as f:
                    members = stored_members(f.read_at, f.size())
                    start, _ = members[DATA]
                    at, length = members[INDEX]
                    lines = [json.loads(x) for x in f.read_at(length, at).splitlines()]
                for k in range(0, len(lines), 10_000):
                    some = lines[k:k + 10_000]
                    yield pa.RecordBatch.from_pydict({
                        "path": [path] * len(some), "at": [start + x["offset"] for x in some],
                        "length": [x["length"] for x in some]})

    spots = archives.select("path").mapInArrow(locate, "path string, at long, length long")
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = (spots.withColumn("range", F.expr(f"at div {RANGE_BYTES}")).repartition(n, "path", "range")
             .sortWithinPartitions("path", "at").select("path", "at", "length"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_fs(folder)
        for b in batches:
            found, files = [], {}
            spans = list(zip(*(b.column(c).to_pylist() for c in ("path", "at", "length")), strict=True))
            i = 0
            while i < len(spans):
                path, start, length = spans[i]
                j, end = i + 1, start + length
                while j < len(spans) and spans[j][0] == path and spans[j][1] == end and end - start < RANGE_BYTES:
                    end += spans[j][2]
                    j += 1
                if path not in files:
                    files = {path: store.open_input_file(path)}
                data = files[path].read_at(end - start, start)
                for _, at, n in spans[i:j]:
                    warc, http, payload = parse_record(zlib.decompress(data[at - start:at - start + n], 31))
                    urn = lambda name: (warc.get(name, "").rstrip(">").rpartition(":")[2] or None)
                    page, refers = urn("warc-record-id"), urn("warc-refers-to")
                    found.append((None if page is None else int(page), warc.get("warc-target-uri", ""), payload,
                                  warc["warc-type"], None if refers is None else int(refers), int(http["content-length"]),
                                  warc["warc-payload-digest"].removeprefix("sha256:")))
                i = j
                if sum(len(x[2]) for x in found) > 8 * RANGE_BYTES:
                    yield _records(found)
                    found = []
            yield _records(found)

    return spots.mapInArrow(fetch, "page_id long, url string, payload binary, record_type string, refers_to long, "
                                   "http_bytes long, stated_digest string")


def _records(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["page_id", "url", "payload", "record_type", "refers_to", "http_bytes", "stated_digest"]
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(kinds)], names)


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Pages written as archives below the shared folder, and the records read back from them."""
    folder = shared_dir(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, **columns), folder)


def digests(records: DataFrame) -> DataFrame:
    """Per record, of the full payload: length and digest. A revisit states those of the payload it refers to."""
    response = F.col("record_type") == "response"
    return records.select(
        "page_id", F.when(response, F.octet_length("payload")).otherwise(F.col("http_bytes")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", "refers_to")
