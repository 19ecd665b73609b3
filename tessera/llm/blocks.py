"""Array kernels over blocks of whole texts, used inside Arrow batches.

Texts are handled as UTF-8 bytes. The word pattern ``[^\\x20\\x09-\\x0D]+``
only names ASCII separators, so byte positions suffice. A block joins several
texts with a line break (a separator), which bounds the arrays; one text longer
than a block forms a block of its own. Word hashes are 64-bit: two different
words or windows of one text are taken as equal with a chance below 1e-10 even
in a text of a million words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text handled at once.
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def column_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, which bounds what is copied out of Arrow at once."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose texts together stay below ``limit`` bytes."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text followed by a line break, and where each starts (plus the end)."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return data, bounds


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; ``data`` ends with a separator."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _power_table(base: int, n: int) -> np.ndarray:
    table = np.full(n, base, U64)
    table[:1] = 1
    return np.cumprod(table, dtype=U64)


class SpanHasher:
    """Polynomial hashes of byte spans; the power tables are kept between blocks."""

    def __init__(self):
        self.up = self.down = np.zeros(0, U64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), U64)
        first = 0
        while first < len(starts):
            # A piece ends at a span's end, so no span is cut.
            origin = starts[first]
            last = max(first + 1, int(np.searchsorted(ends, origin + 2 * BLOCK_BYTES, "right")))
            piece = data[origin:ends[last - 1]]
            if len(piece) >= len(self.up):
                size = max(len(piece), 2 * BLOCK_BYTES) + 1
                self.up, self.down = _power_table(_BASE, size), _power_table(pow(_BASE, -1, 1 << 64), size)
            sums = np.zeros(len(piece) + 1, U64)
            np.cumsum((piece.astype(U64) + U64(1)) * self.up[:len(piece)], out=sums[1:], dtype=U64)
            s, e = starts[first:last] - origin, ends[first:last] - origin
            out[first:last] = mix((sums[e] - sums[s]) * self.down[s])
            first = last
        return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words."""
    n = max(len(words) - size + 1, 0)
    out = np.zeros(n, U64)
    for k in range(size):
        out = out * U64(0xD1342543DE82EF95) + words[k:k + n]
    return mix(out)
