"""Secret scans: pattern candidates, false positives removed by a random forest.

Candidates are the passwords of URLs, values of assignments (quoted or not, of
any length and any signs but spaces), runs of 16 and more of the characters that
keys are written in, and key blocks up to their END line, or else the text's
end. A value ends where another assignment starts. Features of a candidate: its
length and alphabet, how its characters follow each other (changes of character
class, and mean log-probability under character transitions counted over the
words of all documents), the share covered by dictionary pieces, words beside
it, and the document's path. A random forest fitted on labelled findings
decides. Labelled findings are the seeds below (made by a rule), and findings
of a bounded sample of documents that clear evidence labels (or a caller's).

Defined results: null and empty texts have no findings; repeated rows are
scanned each; a null path is an empty one, as is that of a table without the path column; with ``None`` for a dictionary its
coverage is zero, and a dictionary that is not there is an error; an empty table gives an empty result. ``redact`` keeps all rows and
columns, replaces findings by a mark, and leaves other texts byte for byte.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.blocks import SPACE, blocks, column_bytes, joined, slices
from tessera.llm.forest import Forest, grow

#: Documents whose findings the forest is fitted on (by hash; twice as many at the very most).
TRAIN_DOCS = 3000
#: Labelled findings that the forest is fitted on at most.
TRAIN_FINDINGS = 20_000
SECRET_PROBABILITY = 0.5
MARK = "[SECRET]"
#: Public vocabulary whose pieces serve as the dictionary; another path may be given.
DICTIONARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Values before runs, so that a long name does not hide its value; the = of padding is not that of an assignment.
_CANDIDATE = re.compile(
    rb"""://[^\s:/@"']*:(?P<credential>[^\s"'/]+)@"""
    rb"""|(?:\ ?=>?+|:=?+)\s{0,3}(["'`])(?![A-Za-z][\w+.-]{0,30}://)(?P<value>(?:(?!\2)[^\s\\]|\\\S)+)\2"""
    rb"""|(?<=[\w"'`\])\x80-\xff])(?:\ ?=>?+|:=?+)[\ \t]{0,3}["'`]?(?![A-Za-z][\w+.-]{0,30}://|//)"""
    rb"""(?P<bare>(?:(?![(\[{,;&|?]["']?[\w.-]{1,40}["']?[:=])\S)+)"""
    rb"""|(?P<run>[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![\w"'=]|\s{0,3}["']))?)""")
_FIELD = re.compile(rb"[\n,;&|?{(]")
_TRAIL = b".,;:)]}>\"'`"
_BLOCK = re.compile(rb"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----.*?"
                    rb"(?:-----END [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----|\Z)", re.S)
_MARKS = re.compile(rb"-----[A-Z0-9 ]+-----")
_HEX, _UUID = re.compile(rb"[0-9a-fA-F]+\Z"), re.compile(rb"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\Z", re.I)
_ISSUED = re.compile(rb"(AKIA|ASIA)[0-9A-Z]{16}\Z|gh[pousr]_[A-Za-z0-9]{36}\Z|xox[abprs]-|AIza[0-9A-Za-z_-]{35}\Z|sk_live_")
_SECRET_WORDS = re.compile(rb"secret|token|passw|pwd|api.?key|access.?key|private.?key|credential|bearer|auth", re.I)
_OTHER_WORDS = re.compile(rb"(?<![.@\w])(commit|sha\d*|hash|uuid|checksum|digest|md5|etag|revision|build|integrity|example|dummy|sample)\b(?![.@]\w)", re.I)
_QUIET_PATH = re.compile(r"test|example|sample|fixture|mock|doc|lock", re.I)
FEATURES = ("length", "digits", "upper", "lower", "other", "entropy", "changes", "transitions", "dictionary", "hex", "uuid",
            "issued", "secret_word", "other_word", "assigned", "quoted", "quiet_path", "block", "credential")

# Character classes for transitions: a-z (case folded), each digit alike, anything else.
_CLASS = np.full(256, 27, np.uint8)
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = np.arange(26)
_CLASS[48:58] = 26
_CLASSES = 28


@dataclass
class Context:
    """What features are computed with: transition log-probabilities and dictionary pieces."""

    transitions: np.ndarray
    pieces: frozenset


def transition_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each character class follows another inside words, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CLASSES * _CLASSES, np.int64)
        for b in slices(batches):
            texts = column_bytes(b.column(0))
            for i, j in blocks(texts):
                data, _ = joined(texts[i:j])
                c = _CLASS[data].astype(np.int16)
                inside = ~(SPACE[data[1:]] | SPACE[data[:-1]])
                total += np.bincount((c[:-1] * _CLASSES + c[1:])[inside], minlength=len(total))
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(len(total)), pa.int32()), "n": total})

    counts = np.zeros(_CLASSES * _CLASSES)
    rows = docs.select(text_col).mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for cell, n in rows.collect():  # at most 784 rows
        counts[cell] = n
    return counts.reshape(_CLASSES, _CLASSES)


def dictionary(path: str | None = DICTIONARY, shortest: int = 4) -> frozenset:
    """Lower-case letter pieces of a public vocabulary file (its size is the bound); empty for no path.

    Read where the job is started, and sent to the tasks; verdicts so do not depend on the machines that run them.
    """
    if not path:
        return frozenset()
    with open(path, "rb") as f:
        pieces = (base64.b64decode(line.split()[0]).strip().lower() for line in f if line.strip())
        return frozenset(p for p in pieces if len(p) >= shortest and p.isalpha() and p.isascii())


def context(docs: DataFrame, text_col: str = "text", dictionary_path: str | None = DICTIONARY) -> Context:
    counts = transition_counts(docs, text_col) + 0.5
    return Context(np.log(counts / counts.sum(1, keepdims=True)), dictionary(dictionary_path))


def _covered(value: bytes, pieces: frozenset) -> float:
    """Share of the characters inside dictionary pieces, longest first from the left."""
    low, i, n = value.lower(), 0, 0
    while i < len(low):
        step = next((k for k in range(min(14, len(low) - i), 3, -1) if low[i:i + k] in pieces), 0)
        n += step
        i += step or 1
    return n / max(len(low), 1)


@dataclass
class Candidate:
    start: int
    end: int
    kind: str
    value: bytes


def candidates(text: bytes) -> list[Candidate]:
    """Non-overlapping spans in order."""
    found = [Candidate(*m.span(), "private_key", m[0]) for m in _BLOCK.finditer(text)] if b"-----BEGIN " in text else []
    ends = [c.end for c in found]
    for m in _CANDIDATE.finditer(text):
        kind = m.lastgroup
        start, value = m.start(kind), m[kind]
        if kind == "bare":  # what closes a sentence or bracket is not the value's
            value = value.rstrip(_TRAIL) or value
        end = start + len(value)
        at = bisect.bisect_right(ends, start)
        if at < len(ends) and found[at].start < end and found[at].kind == "private_key":
            continue
        found.append(Candidate(start, end, "value" if kind == "bare" else kind, value))
    return sorted(found, key=lambda c: c.start)


def features(text: bytes, c: Candidate, path: str, ctx: Context) -> list[float]:
    v = (_MARKS.sub(b"", c.value).strip() if c.kind == "private_key" else c.value) or c.value
    a = np.frombuffer(v, np.uint8)
    n, k = len(a), _CLASS[a]
    digit, upper, lower = (a >= 48) & (a < 58), (a >= 65) & (a < 91), (a >= 97) & (a < 123)
    group = digit + 2 * upper + 3 * lower
    share = np.array(list(Counter(v).values())) / n
    before, after = text[max(0, c.start - 60):c.start], text[c.end:c.end + 30]
    beside = b" ".join(before.split()[-4:]) + b" " + b" ".join(after.split()[:2])
    tail = before.rstrip(b" \"'\t")
    # A value's name stands in its own field, not in the one before.
    name = _FIELD.split(before[-40:].rstrip(b" \"'`\t:=>"))[-1] if c.kind == "value" else before[-40:]
    return [min(n, 400), digit.mean(), upper.mean(), lower.mean(), (group == 0).mean(), float(-(share * np.log2(share)).sum()),
            float((np.diff(group) != 0).mean()) if n > 1 else 0.0,
            float(ctx.transitions[k[:-1], k[1:]].mean()) if n > 1 else 0.0,
            _covered(v, ctx.pieces), bool(_HEX.match(v)), bool(_UUID.match(v)), bool(_ISSUED.match(v)),
            bool(_SECRET_WORDS.search(name)), bool(_OTHER_WORDS.search(beside)), tail[-1:] in (b"=", b":"),
            before[-1:] in (b'"', b"'"), bool(_QUIET_PATH.search(path or "")), c.kind == "private_key",
            c.kind == "credential"]


def evidence(f: list[float]) -> int:
    """Label of a finding from clear evidence: 1 secret, 0 none, -1 unclear."""
    x = dict(zip(FEATURES, f, strict=True))
    random_looking = x["digits"] > 0 and x["entropy"] > 3.0 and x["dictionary"] < 0.5 and x["length"] >= 16
    named = x["secret_word"] and x["assigned"] and not x["other_word"]
    signs = sum(x[k] > 0 for k in ("digits", "upper", "lower", "other"))
    mixed = signs >= 3 and x["length"] >= 6 and x["dictionary"] < 0.5 and x["digits"] > 0
    if x["block"]:
        return int(x["dictionary"] < 0.5)
    if x["issued"] or (named and (random_looking or mixed)) or (x["credential"] and mixed):
        return 1
    if x["credential"] or (named and x["length"] >= 8 and x["dictionary"] < 0.3):
        return -1
    if x["digits"] == 0 or x["uuid"] or x["other_word"] or (x["dictionary"] > 0.6 and not x["secret_word"]):
        return 0
    return -1


def seeds(n: int = 60) -> list[tuple[bytes, int]]:
    """Texts with one finding each, and its label, made from counters by SHA-256 (the same every time)."""
    out = []
    for i in range(n):
        d = hashlib.sha256(b"seed%d" % i).digest()
        hexa, b64 = d[:20].hex().encode(), base64.b64encode(d[:24]).replace(b"/", b"x").replace(b"+", b"y")
        word = [b"token", b"secret", b"password", b"api_key", b"auth_token", b"ACCESS_KEY", b"client_secret"][i % 7]
        uid = b"-".join([hexa[:8], hexa[8:12], hexa[12:16], hexa[16:20], hexa[20:32]])
        plain = [b"configuration_directory", b"international-development", b"responsibilities/management2",
                 b"example_placeholder_value1", b"your_password_goes_here1", b"background-color-transparent2"][i % 6]
        block = b"\n".join(base64.b64encode(hashlib.sha256(d + b"%d" % k).digest() * 2)[:64] for k in range(2 + i % 5))
        name = [b"RSA ", b"EC ", b"", b"OPENSSH "][i % 4]
        mixed_case = bytes((65 if x & 1 else 97) + (x >> 1) % 26 for x in d[:12 + i % 13])
        digits = bytes(48 + x % 10 for x in d[:12 + i % 9])
        short = (bytes(b"abcdefghkmnpqrstuvwxyzABCDEFGHKMNPQRSTUVWXYZ"[x % 44] for x in d[:4 + i % 5]) + b"%d" % (d[9] % 90 + 10)
                 + b"!@#$%^*?"[i % 8:i % 8 + 1] + base64.b64encode(d[10:13]).replace(b"/", b"-")[:1 + i % 4])
        common = [b"required", b"value", b"see", b"the", b"changed", b"string", b"true", b"none", b"important", b"Monday"][i % 10]
        number = b"%d" % (d[0] * d[1])
        given = [b"${" + word.upper() + b"}", b"$" + word.upper(), b"os.environ", b"get_" + word + b"()"][i % 4]
        out += [(word + b"=" + short, 1), (word + b': "' + short + b'"', 1), (b"DB_" + word.upper() + b"='" + short + b"'", 1),
                (b"db://admin:" + short + b"@db.example.com/x", 1), (b"https://user%d:" % i + mixed_case + b"@host", 1),
                (word + b"=" + mixed_case, 1), (word + b': "' + mixed_case + b'"', 1), (word + b": " + digits, 1),
                (word + b'="' + base64.b64encode(hashlib.sha512(d).digest() * (1 + i % 9)) + b'"', 1),
                (b"-----BEGIN " + name + b"PRIVATE KEY-----\n" + block, 1),
                (b"-----BEGIN PRIVATE KEY----- starts " + (b"the %s line of a key file, and " % common) * (2 + i % 9), 0),
                (word + b": " + common, 0), (word + b'="' + common + b'"', 0), (b"note: " + common, 0), (word + b"=" + given, 0),
                (b"count=" + number, 0), (b"id: " + digits, 0), (b"at 1%d:%d" % (i % 10, 10 + i % 50), 0),
                (b"date: 20%d-0%d-1%d" % (10 + i % 15, 1 + i % 9, i % 10), 0), (b"price: $" + number + b".50", 0),
                (b"mail: " + common + number + b"@example.com", 0), (b"path=/usr/local/lib/" + common, 0),
                (b"http://user:" + [b"password", b"pass", b"<password>", b"$PASSWORD"][i % 4] + b"@host", 0)]
        out += [(b"-----BEGIN " + name + b"PRIVATE KEY-----\n" + block + b"\n-----END " + name + b"PRIVATE KEY-----", 1),
                (word + b' = "' + hexa + b'"', 1), (word + b": '" + b64 + b"'", 1), (b"export " + word + b"=" + b64, 1),
                (word + b' = "' + hexa[:32].upper() + b'" ', 1), (b'key = "AKIA' + base64.b32encode(d[:10]) + b'"', 1),
                (b"commit " + hexa + b" merged", 0), (b'sha256 = "' + hexa + hexa[:24] + b'"', 0),
                (b"see uuid " + uid + b" there", 0), (word + b' = "' + plain + b'"', 0), (b"path " + plain + b" of", 0),
                (b'name: "' + plain + b'"', 0), (b"the checksum " + b64 + b" is", 0)]
    return out


def _path(docs: DataFrame, path_col: str) -> Column:
    return (F.col(path_col).cast("string") if path_col in docs.columns else F.lit("")).alias("path")


def train(docs: DataFrame, ctx: Context, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
          train_docs: int = TRAIN_DOCS, labelled: DataFrame | None = None) -> Forest:
    """Fit on the seeds, findings of about ``train_docs`` documents, and ``labelled`` rows (text, path, label)."""
    rows = docs.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text"), _path(docs, path_col))
    # Rows whose hash falls below the share wanted, repeated ones once: about train_docs of them, whatever their number
    # in all. They stay dealt over tasks, which send findings only, so no task holds all texts of the sample.
    share = int(min(1.0, train_docs / max(docs.count(), 1)) * 2**31)
    sample = (rows.where("text IS NOT NULL").where(F.pmod("h", F.lit(2**31)) < share)
              .groupBy("h").agg(F.min(F.struct("text", "path")).alias("x"))
              .select("x.text", "x.path", F.lit(-1).alias("label")))
    if labelled is not None:
        sample = sample.unionByName(labelled.select("text", "path", F.col("label").cast("int")).limit(TRAIN_FINDINGS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[list[float], int]] = []
        for b in slices(batches):
            for text, path, label in zip(column_bytes(b.column(0)), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                for c in candidates(text):
                    f = features(text, c, path, ctx)
                    if (y := label if label >= 0 else evidence(f)) >= 0:
                        found.append((f, y))
        if found:
            yield pa.RecordBatch.from_pydict({"f": pa.array([f for f, _ in found], pa.list_(pa.float64())),
                                              "y": pa.array([y for _, y in found], pa.int32())})

    findings = sample.mapInArrow(run, "f array<double>, y int")
    # Secrets are rare: both classes are kept up to half of the bound, in hash order.
    spark = docs.sparkSession
    rows = findings.where("y = 1").orderBy(F.xxhash64("f")).limit(TRAIN_FINDINGS // 2).unionByName(
        findings.where("y = 0").orderBy(F.xxhash64("f")).limit(TRAIN_FINDINGS // 2))
    made = []
    for line, y in seeds():
        c = max(candidates(line), key=lambda c: c.end - c.start)
        made.append(([float(v) for v in features(line, c, "", ctx)], y))
    rows = rows.unionByName(spark.createDataFrame(made, "f array<double>, y int"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for b in slices(batches):
            x += b.column(0).to_pylist()
            y += b.column(1).to_pylist()
        order = sorted(range(len(y)), key=lambda i: (x[i], y[i]))  # whatever order tasks delivered
        g = grow(np.array([x[i] for i in order], float), np.array([y[i] for i in order], float))
        yield pa.RecordBatch.from_pydict({"forest": [json.dumps({k: v.tolist() for k, v in vars(g).items()})]})

    # One task fits the bounded findings; the forest has at most 30 * 2^9 nodes.
    text = rows.coalesce(1).mapInArrow(fit, "forest string").collect()[0][0]
    return Forest(**{k: np.array(v) for k, v in json.loads(text).items()})


def _scan(texts: list[bytes], paths: list, ctx: Context, forest: Forest) -> list[tuple[int, Candidate, float]]:
    found = [(i, c) for i, t in enumerate(texts) for c in candidates(t)]
    if not found:
        return []
    x = np.array([features(texts[i], c, paths[i], ctx) for i, c in found], float)
    return [(i, c, float(p)) for (i, c), p in zip(found, forest.probability(x), strict=True)]


FINDING_SCHEMA = "kind string, start long, length long, finding_sha256 string, probability double, is_secret boolean"


def scan(docs: DataFrame, ctx: Context, forest: Forest, id_col: str = "doc_id", text_col: str = "text",
         path_col: str = "source") -> DataFrame:
    """One row per candidate: its span in code points, digest, probability and verdict."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, ids = column_bytes(b.column(1)), b.column(0)
            hits = _scan(texts, b.column(2).to_pylist(), ctx, forest)
            starts, last, at, chars = [], -1, 0, 0  # code points before each candidate, counted on from the one before
            for i, c, _ in hits:
                at, chars = (at, chars) if i == last else (0, 0)
                chars += len(texts[i][at:c.start].decode("utf-8", "replace"))
                last, at = i, c.start
                starts.append(chars)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array([i for i, _, _ in hits], pa.int64())), pa.array([c.kind for _, c, _ in hits], pa.string()),
                pa.array(starts, pa.int64()),
                pa.array([len(c.value.decode("utf-8", "replace")) for _, c, _ in hits], pa.int64()),
                pa.array([hashlib.sha256(c.value).hexdigest() for _, c, _ in hits], pa.string()),
                pa.array([p for _, _, p in hits], pa.float64()),
                pa.array([p >= SECRET_PROBABILITY for _, _, p in hits], pa.bool_())],
                ["id", *(x.split()[0] for x in FINDING_SCHEMA.split(", "))])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _path(docs, path_col))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, {FINDING_SCHEMA}").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, ctx: Context, forest: Forest, text_col: str = "text", path_col: str = "source",
           chars_col: str | None = "n_chars", mark: str = MARK) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; ``chars_col``, where present, follows the text."""
    names = docs.columns
    at, path_at = names.index(text_col), names.index(path_col) if path_col in names else -1
    chars_at = names.index(chars_col) if chars_col in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = column_bytes(b.column(at))
            spans: dict[int, list[Candidate]] = {}
            for i, c, p in _scan(texts, [str(x or "") for x in b.column(path_at).to_pylist()] if path_at >= 0 else [""] * len(texts), ctx, forest):
                if p >= SECRET_PROBABILITY:
                    spans.setdefault(i, []).append(c)
            if spans:
                columns, out = list(b.columns), b.column(at).to_pylist()
                chars = columns[chars_at].to_pylist() if chars_at >= 0 else None
                for i, found in spans.items():
                    t, end, pieces = texts[i], 0, []
                    for c in found:
                        pieces += [t[end:c.start], mark.encode()]
                        end = c.end
                    out[i] = b"".join([*pieces, t[end:]]).decode("utf-8", "replace")
                    if chars:
                        chars[i] = len(out[i])
                columns[at] = pa.array(out, b.column(at).type)
                if chars:
                    columns[chars_at] = pa.array(chars, columns[chars_at].type)
                b = pa.RecordBatch.from_arrays(columns, schema=b.schema)
            yield b

    return docs.mapInArrow(run, docs.schema)
