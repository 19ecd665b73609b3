"""Quality rules: fixed base rules and a calibrated hashed n-gram classifier.

Hashed word (one and two words) and character (four bytes) n-grams feed a
logistic regression fitted on labelled rows; its margin is turned into a
probability on held-out labelled rows (sigmoid calibration). All documents are
then scored in Arrow batches against fixed thresholds, in one pass without a
shuffle.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows are judged alike, one result each; without labelled rows of both
classes there is no classifier and the base rules decide; an empty table gives
an empty result. Extra columns stay in the rows that ``keep_good`` returns and
never meet the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import SpanHasher, U64, blocks, column_bytes, joined, mix, slices, window_hashes, word_spans

#: Labelled rows that the classifier is fitted on at most (lowest hash of doc_id first).
TRAIN_ROWS = 3000
#: Bytes of text that the classifier is fitted on at most: texts beyond an even share of them are scored, not learnt from.
TRAIN_BYTES = 512 << 20
#: Fixed thresholds.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_PROBABILITY = 0.5

_CHAR_BITS, _WORD_BITS = 18, 17
_SIZE = (1 << _CHAR_BITS) + 2 * (1 << _WORD_BITS)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

RULE_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "base_failed boolean, probability double, kept boolean")


@dataclass
class Classifier:
    """Weights by feature bucket, and the calibration ``sigmoid(scale * margin + shift)``."""

    weights: np.ndarray
    scale: float
    shift: float


class _Block:
    """Words, hashes and bounds of a few texts."""

    def __init__(self, texts: list[bytes], hasher: SpanHasher):
        self.texts = texts
        self.data, self.bounds = joined(texts)
        starts, ends = word_spans(self.data)
        self.words = hasher(self.data, starts, ends)
        self.at = np.searchsorted(starts, self.bounds)
        self.n_words = np.diff(self.at)
        self.owner = np.repeat(np.arange(len(texts)), self.n_words)

    def repeat_words(self, size: int = 5) -> np.ndarray:
        """Per text, the words inside windows that occur twice or more in it."""
        keys = window_hashes(self.words, size)
        fits = self.owner[size - 1:] == self.owner[:len(keys)]
        at = np.flatnonzero(fits)
        keys = keys[at] ^ mix(self.owner[at].astype(U64) + U64(1))
        ordered = np.sort(keys)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        inside = np.zeros(len(self.words), bool)
        if len(again):
            spot = np.minimum(np.searchsorted(again, keys), len(again) - 1)
            twice = at[again[spot] == keys]
            for k in range(size):
                inside[twice + k] = True
        return np.bincount(self.owner[inside], minlength=len(self.texts))

    def sums(self, mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, self.bounds[:-1], dtype=np.int64)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each n-gram family: the bucket of every n-gram, and per text its first and last."""
        c = self.data.astype(np.uint32)
        n = max(len(c) - 3, 0)
        grams = c[:n] | c[1:n + 1] << np.uint32(8) | c[2:n + 2] << np.uint32(16) | c[3:n + 3] << np.uint32(24)
        first = self.bounds[:-1]
        yield ((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - _CHAR_BITS)).astype(np.int32), \
            np.stack([first, np.maximum(first, self.bounds[1:] - 4)])
        base, shift = 1 << _CHAR_BITS, U64(64 - _WORD_BITS)
        yield (self.words >> shift).astype(np.int32) + base, np.stack([self.at[:-1], self.at[1:]])
        base += 1 << _WORD_BITS
        yield (window_hashes(self.words, 2) >> shift).astype(np.int32) + base, \
            np.stack([self.at[:-1], np.maximum(self.at[:-1], self.at[1:] - 1)])

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Per text, the sum over families of the mean weight of its n-grams."""
        out = np.zeros(len(self.texts))
        for ids, (first, last) in self.features():
            sums = np.zeros(len(ids) + 1)
            np.cumsum(weights[ids], out=sums[1:], dtype=np.float64)
            first, last = np.minimum(first, len(ids)), np.minimum(last, len(ids))
            out += (sums[last] - sums[first]) / np.maximum(last - first, 1)
        return out


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def judge_texts(texts: list[bytes], model: Classifier | None, hasher: SpanHasher) -> dict[str, np.ndarray]:
    """The columns of ``RULE_SCHEMA`` for whole texts."""
    parts: list[dict] = []
    for i, j in blocks(texts):
        b = _Block(texts[i:j], hasher)
        inside = np.ones(len(b.data), bool)
        inside[(b.data == 0x20) | ((b.data >= 0x09) & (b.data <= 0x0D))] = False
        repeat = b.repeat_words()
        failed = (b.n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * b.n_words)
        p = np.ones(j - i)
        if model is not None:
            z = model.scale * b.margins(model.weights) + model.shift
            p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        parts.append({
            "n_words": b.n_words, "word_chars": b.sums(inside & ((b.data & 0xC0) != 0x80)),
            "n_symbols": b.sums(_SYMBOL[b.data]), "n_dup_lines": np.array([_dup_lines(t) for t in b.texts], np.int64),
            "n_repeat_words": repeat, "base_failed": failed, "probability": p,
            "kept": ~failed & (p >= KEEP_PROBABILITY)})
    return {k: np.concatenate([x[k] for x in parts]) for k in parts[0]} if parts else {}


def fit(texts: list[bytes], good: np.ndarray, rounds: int = 60, rate: float = 0.5) -> Classifier | None:
    """Logistic regression by scaled gradient steps on three quarters, calibrated on the other quarter."""
    held = np.arange(len(texts)) % 4 == 3
    if not all(len(np.unique(good[m])) == 2 for m in (held, ~held)):
        return None
    hasher, ids, values, at = SpanHasher(), [], [], [0]
    margins = lambda w: np.concatenate([_Block(texts[i:j], hasher).margins(w) for i, j in blocks(texts)])
    for i in np.flatnonzero(~held):
        found = [(f[a:b], 1.0 / max(b - a, 1)) for f, ((a,), (b,)) in _Block([texts[i]], hasher).features()]
        u, counts = np.unique(np.concatenate([f for f, _ in found]), return_counts=True)
        share = np.empty(3, np.float32)
        share[:] = [v for _, v in found]
        family = (u >= 1 << _CHAR_BITS).astype(np.int8) + (u >= (1 << _CHAR_BITS) + (1 << _WORD_BITS))
        ids.append(u)
        values.append(counts.astype(np.float32) * share[family])
        at.append(at[-1] + len(u))
    ids, values, at = np.concatenate(ids), np.concatenate(values), np.array(at)
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
    y = good[~held].astype(np.float64)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w, seen, bias, bias_seen = np.zeros(_SIZE), np.full(_SIZE, 1e-12), 0.0, 1e-12
    for _ in range(rounds):
        z = np.bincount(owner, values * w[ids], len(y)) + bias
        error = balance * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        grad = np.bincount(ids, values * error[owner], _SIZE) + 1e-9 * w
        seen += grad * grad
        w -= rate * grad / np.sqrt(seen)
        bias_seen += error.sum() ** 2
        bias -= rate * error.sum() / np.sqrt(bias_seen)
    w = w.astype(np.float32)
    z, t = margins(w)[held] + bias, good[held].astype(np.float64)
    # Sigmoid calibration by Newton steps; targets are pulled in as for small samples.
    t = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
    x, theta = np.stack([z, np.ones_like(z)]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -50, 50)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hessian, x @ (p - t) + 1e-6 * (theta - [1.0, 0.0])), -2, 2)
    return Classifier(w, float(theta[0]), float(theta[1] + theta[0] * bias))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> Classifier | None:
    """Fit on the ``rows`` labelled rows with the lowest hash; only the weights reach the driver.

    A document with several labels counts as good only if all say so. ``rows``
    bounds the ids that are broadcast, the texts in the fitting task and the model;
    texts longer than ``TRAIN_BYTES / rows`` bytes are left out of the fit, which bounds that task in bytes too.
    """
    # Only ids whose hash falls below the share wanted (with room to spare) are considered, so tasks send few.
    share = int(min(1.0, 2 * rows / max(labels.count(), 1)) * 2**31)
    picked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (F.pmod(F.xxhash64(id_col), F.lit(2**31)) < share))
              .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("good"))
              .orderBy(F.pmod(F.xxhash64("id"), F.lit(2**31)), "id").limit(rows))
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .where(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_BYTES // max(rows, 1))
              .join(F.broadcast(picked), "id")
              .orderBy(F.pmod(F.xxhash64("id"), F.lit(2**31)), "id", F.xxhash64("text")).limit(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, good = [], []
        for b in slices(batches):
            texts += column_bytes(b.column("text"))
            good += b.column("good").to_pylist()
        if model := fit(texts, np.array(good)):
            yield pa.RecordBatch.from_pydict({"weights": pa.array([model.weights.tobytes()], pa.binary()),
                                              "scale": [model.scale], "shift": [model.shift]})

    # LIMIT leaves one partition: the bounded sample is fitted in one task, in hash order.
    found = sample.select("text", "good").coalesce(1).mapInArrow(run, "weights binary, scale double, shift double").collect()
    return Classifier(np.frombuffer(found[0][0], np.float32), found[0][1], found[0][2]) if found else None


def quality_rules(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and the columns of ``RULE_SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for b in slices(batches):
            found = judge_texts(column_bytes(b.column("text")), model, hasher)
            yield pa.RecordBatch.from_arrays([b.column("id"), *map(pa.array, found.values())], ["id", *found])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, {RULE_SCHEMA}").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Classifier | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for b in slices(batches):
            yield b.filter(pa.array(judge_texts(column_bytes(b.column(at)), model, hasher)["kept"]))

    return docs.mapInArrow(run, docs.schema)
