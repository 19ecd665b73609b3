"""Vectors as whole numbers, packed for shuffles.

A vector with a null, infinite or NaN component, or none at all, takes no part. The others become
``floor(scale * c)`` for each component c, taken as double; values beyond 2^61 are cut to it, so that differences fit a long.
A packed vector is one byte (the width of a number in bytes) and the numbers, little-endian.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_LARGEST = float(1 << 61)


def _width(largest: int) -> int:
    return next(w for w in (1, 2, 4, 8) if largest < 1 << (8 * w - 1) or w == 8)


def pack(matrix: np.ndarray) -> list[bytes]:
    """Each row of whole numbers in the fewest bytes a number that hold it."""
    top = np.maximum(matrix.max(1, initial=0), -(matrix.min(1, initial=0) + 1))
    out: list[bytes] = [b""] * len(matrix)
    widths = np.array([_width(int(t)) for t in top])
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        narrow = matrix[at].astype(f"<i{w}")
        for i, row in zip(at.tolist(), narrow, strict=True):
            out[i] = bytes([w]) + row.tobytes()
    return out


def unpack(packed: list[bytes]) -> np.ndarray:
    """The packed vectors, all of one length, as rows of longs."""
    if not packed:
        return np.zeros((0, 0), np.int64)
    dim = (len(packed[0]) - 1) // packed[0][0]
    out = np.empty((len(packed), dim), np.int64)
    widths = np.array([p[0] for p in packed])
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        flat = np.frombuffer(b"".join(packed[i][1:] for i in at.tolist()), f"<i{w}")
        out[at] = flat.reshape(len(at), dim)
    return out


def by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length that occurs and the rows that have it."""
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n)


def whole_numbers(rows: DataFrame, vector_col: str, scale: int, keep: dict) -> DataFrame:
    """The columns ``keep`` (name -> expression), ``dim`` and ``x`` (packed), for rows whose vector takes part."""
    v = F.col(vector_col).cast("array<double>")
    fits = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * F.lit(float(scale))) == float("inf")))
    given = rows.where(F.col(vector_col).isNotNull() & fits).select(*[e.alias(n) for n, e in keep.items()], v.alias("v"))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            flat = np.asarray(lists.flatten(), np.float64)
            ends = np.cumsum(np.asarray(lists.value_lengths(), np.int64))
            lengths = np.diff(ends, prepend=0)
            packed: list[bytes] = [b""] * b.num_rows
            for n, at in by_length(lengths):
                cells = (ends[at] - n)[:, None] + np.arange(n)
                x = np.clip(np.floor(scale * flat[cells]), -_LARGEST, _LARGEST).astype(np.int64)
                for i, p in zip(at.tolist(), pack(x), strict=True):
                    packed[i] = p
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(lengths, pa.int32()),
                                              pa.array(packed, pa.binary())], [*names, "dim", "x"])

    kinds = dict(given.dtypes)
    return given.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", dim int, x binary")
