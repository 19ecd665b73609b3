"""Whitening of embeddings by principal components, refined to double precision.

Vectors become whole numbers x (``floor(64 * c) + 1000000`` for each component c). The fit list is each distinct x
once. Its count n, its sums S and the products of its deviations from a whole-number centre near the mean are gathered
by Spark as whole numbers, so the covariance V is known as a fraction; one table row for each (length, i, j) and task is
summed, nothing else leaves the tasks. The eigenvectors of V (a matrix of the vectors' length, whatever the
number of rows) are then found on the driver:

* a first solution in float32;
* Ogita-Aishima refinement with extended precision: residuals of orthogonality and diagonality, made by matrix
  products, give a correction that converges quadratically;
* eigenvalues closer than the residuals allow form clusters: their common space is refined as a whole, then a solve
  of the small matrix within it (shifted by its mean eigenvalue, so that the small differences keep their digits)
  turns it to eigenvectors, and the refinement goes on.

The covariance and its solution grow with the square and cube of the vectors' length, not with the rows; a length of a
thousand takes minutes on the driver.

The signs are free; here each component's entry of largest magnitude is positive.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped; vectors
of each length are fitted by themselves; an empty vector has no component; repeated rows stay, one result each, and
count once in the fit; components beyond the vector's length do not exist; a component without variance (constant or
repeated vectors, fewer distinct vectors than components) has ``whitened`` null, ``explained`` zero (null if nothing
varies) and no part in ``identity_error``, which is null if no component varies; a ``deviation`` beyond a long is null; an empty table gives an
empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import slices
from tessera.llm.vectors import by_length, unpack, whole_numbers
from tessera.session import cut_lineage

COMPONENTS = 16
SHIFT = 1_000_000
#: Rounds of refinement; each about doubles the number of right digits.
ROUNDS = 12


def _identity_minus(x: np.ndarray) -> np.ndarray:
    return np.eye(x.shape[1], dtype=x.dtype) - x.T @ x


def refine(a: np.ndarray, x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and orthonormal eigenvectors of the symmetric ``a`` from approximate ones, in extended precision."""
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    eps, size = np.finfo(np.longdouble).eps, max(np.abs(a).sum(1).max(initial=0), np.finfo(np.longdouble).tiny)
    before = np.inf
    for _ in range(rounds):
        r = _identity_minus(x)
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        # Eigenvalues closer than this cannot be told apart by the present solution.
        reach = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())) + 4 * len(a) * eps * size
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > reach
        e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = x + x @ e
        for members in _clusters(values, reach):
            x[:, members] = _split(a, x[:, members])
        step = np.abs(e[far]).max(initial=0) + np.abs(r).max(initial=0)
        if step < 64 * len(a) * eps or step < 1e-14 and step >= before:
            break
        before = step
    # Orthonormal to the last digit, in falling order.
    x = x + x @ (_identity_minus(x) / 2)
    values = ((a @ x) * x).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _clusters(values: np.ndarray, reach: float) -> Iterator[np.ndarray]:
    """Groups of two or more eigenvalues of which each is within ``reach`` of the next."""
    order = np.argsort(values, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(values[order]) > reach) + 1):
        if len(group) > 1:
            yield group


def _split(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Eigenvectors within the space that ``basis`` spans: a solve of the small shifted matrix."""
    for _ in range(2):
        basis = basis + basis @ (_identity_minus(basis) / 2)
    middle = ((a @ basis) * basis).sum(0).mean()
    t = basis.T @ (a @ basis - middle * basis)
    t = (t + t.T) / 2
    scale = np.abs(t).max()
    if not scale:
        return basis
    _, turn = np.linalg.eigh((t / scale).astype(np.float64))
    return basis @ turn.astype(np.longdouble)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of ``a`` (extended precision), from a float32 solution."""
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    _, first = np.linalg.eigh((a / scale).astype(np.float32))
    values, x = refine(a, first)
    lead = x[np.abs(x).argmax(0), np.arange(len(a))]
    return values, x * np.where(lead < 0, -1, 1)


@dataclass(frozen=True)
class Model:
    """The fit of the vectors of one length: ``columns`` project ``x - center - rest`` to whitened components."""

    n: int
    sums: list[int]
    center: np.ndarray      # whole numbers next to the mean
    rest: np.ndarray        # mean - center
    columns: np.ndarray     # eigenvectors over the roots of their eigenvalues; NaN without variance
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.center).astype(np.float64) - self.rest) @ self.columns

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2, exact; null beyond a long."""
        shift = [s - self.n * int(c) for s, c in zip(self.sums, self.center, strict=True)]
        near = x - self.center
        most = self.n * max(int(near.max()), -int(near.min())) + max(map(abs, shift))
        if most * most * x.shape[1] < 1 << 63:
            d = self.n * near - np.array(shift)
            return (d * d).sum(1).tolist()
        d = self.n * near.astype(object) - np.array(shift, object)
        return [s if s < 1 << 63 else None for s in (d * d).sum(1).tolist()]


def _sums(vectors: DataFrame, what: str, products, kind: str) -> dict[int, dict[tuple[int, int], int]]:
    """By length, ``(i, j) -> value``: sums over all vectors, one row for each place and task before the exchange.

    ``products(dim, x)`` gives a matrix of sums over the rows of ``x`` (all of length ``dim``): one row
    of them, or a symmetric matrix, of which the places i <= j are kept. ``what`` names the column.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in slices(batches, 5000):
            packed = b.column("x").to_pylist()
            for dim, at in by_length(np.asarray(b.column("dim"))):
                now = products(dim, unpack([packed[i] for i in at.tolist()]))
                held[dim] = held[dim] + now if dim in held else now
        for dim, m in held.items():
            i, j = np.triu_indices(*m.shape[:1], m=m.shape[1]) if len(m) > 1 else np.indices(m.shape).reshape(2, -1)
            values = m[i, j]
            value = pa.array(values, pa.float64()) if m.dtype == np.float64 else pa.array(
                [int(v) for v in values], pa.decimal128(38, 0))
            for k in range(0, len(values), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i[k:k + (1 << 16)]), dim), pa.int32()), pa.array(i[k:k + (1 << 16)], pa.int32()),
                                                  pa.array(j[k:k + (1 << 16)], pa.int32()), value.slice(k, 1 << 16)], ["dim", "i", "j", what])

    sums = vectors.select("dim", "x").mapInArrow(run, f"dim int, i int, j int, {what} {kind}").groupBy("dim", "i", "j").agg(F.sum(what))
    out: dict[int, dict[tuple[int, int], int]] = {}
    for dim, i, j, value in sums.collect():
        out.setdefault(dim, {})[i, j] = value
    return out


def _whole(products: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in products.tolist()], object)


def fit(distinct: DataFrame, shift: int, components: int) -> dict[int, Model]:
    """A model for each length of the distinct vectors (without ``shift``, which the models add)."""
    def totals(dim: int, x: np.ndarray) -> np.ndarray:
        # Halves of 32 bits are summed as longs, without overflow.
        low, high = x & 0xFFFFFFFF, x >> 32
        return np.append([int(a) + (int(b) << 32) for a, b in zip(low.sum(0), high.sum(0), strict=True)], [len(x)]).astype(object)[None]

    found = _sums(distinct, "total", totals, "decimal(38,0)")
    n = {dim: int(m[0, dim]) for dim, m in found.items()}
    total = {dim: [int(m[0, i]) for i in range(dim)] for dim, m in found.items()}
    center = {dim: [(2 * s + n[dim]) // (2 * n[dim]) for s in total[dim]] for dim in found}

    def products(dim: int, x: np.ndarray) -> np.ndarray:
        d = x - np.array(center[dim], np.int64)
        top = int(np.abs(d).max(initial=0))
        if top * top * len(x) < 1 << 53:  # exact in doubles, which multiply fast
            d = d.astype(np.float64)
            return _whole(d.T @ d)
        return d.astype(object).T @ d.astype(object)

    models = {}
    for dim, m in _sums(distinct, "product", products, "decimal(38,0)").items():
        count = n[dim]
        b = [s - count * c for s, c in zip(total[dim], center[dim], strict=True)]
        v = np.zeros((dim, dim), np.longdouble)
        for (i, j), value in m.items():
            whole, part = divmod(count * int(value) - b[i] * b[j], count * count)
            v[i, j] = v[j, i] = np.longdouble(whole) + np.longdouble(part / (count * count))
        values, x = eigen(v)
        k = min(components, dim)
        trace = np.trace(v)
        varies = values[:k] > dim * np.finfo(np.float64).eps * max(trace, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            columns = np.where(varies, x[:, :k] / np.sqrt(np.where(varies, values[:k], 1)), np.nan)
            explained = np.where(varies, values[:k], 0) / trace if trace > 0 else np.full(k, np.nan)
        middle = np.array(center[dim], np.int64)
        models[dim] = Model(count, [s + count * shift for s in total[dim]], middle + shift,
                            np.array([r / count for r in b], np.float64), columns.astype(np.float64), explained.astype(np.float64))
    return models


def _identity_errors(distinct: DataFrame, models: dict[int, Model], shift: int) -> dict[int, float | None]:
    """Largest entry of the whitened covariance minus the identity, over the fit list, centred before multiplying."""
    def totals(dim: int, x: np.ndarray) -> np.ndarray:
        return models[dim].whitened(x + shift).sum(0)[None]

    means = {dim: np.array([m[0, i] for i in range(len(m))]) / models[dim].n
             for dim, m in _sums(distinct, "white_total", totals, "double").items()}

    def products(dim: int, x: np.ndarray) -> np.ndarray:
        w = models[dim].whitened(x + shift) - means[dim]
        return w.T @ w

    out: dict[int, float | None] = {}
    for dim, m in _sums(distinct, "white_product", products, "double").items():
        errors = [abs(v / models[dim].n - (i == j)) for (i, j), v in m.items() if v == v]
        out[dim] = max(errors, default=None)
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shift: int = SHIFT,
           components: int = COMPONENTS) -> DataFrame:
    """One row for each row and component: id, ``component, n, deviation, whitened, explained, identity_error``."""
    vectors = whole_numbers(rows, vector_col, scale, {"id": F.col(id_col)}).where("dim > 0")
    # Copies are combined before the exchange. Every pass of the fit reads what is written here.
    distinct = cut_lineage(vectors.select("dim", "x").distinct())
    models = fit(distinct, shift, components)
    errors = _identity_errors(distinct, models, shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 5000):
            packed = b.column("x").to_pylist()
            for dim, at in by_length(np.asarray(b.column("dim"))):
                model, x = models[dim], unpack([packed[i] for i in at.tolist()]) + shift
                k = model.columns.shape[1]
                white = model.whitened(x)
                each = lambda values, kind: pa.array(np.tile(values, len(at)), kind, from_pandas=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(np.repeat(at, k))), each(np.arange(1, k + 1), pa.int32()),
                     each(np.full(k, model.n), pa.int64()),
                     pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                     pa.array(white.reshape(-1), from_pandas=True), each(model.explained, pa.float64()),
                     pa.array([errors[dim]] * (k * len(at)), pa.float64())],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = dict(vectors.dtypes)["id"]
    return vectors.mapInArrow(run, f"id {kind}, component int, n long, deviation long, whitened double, explained double, "
                                   "identity_error double").withColumnRenamed("id", id_col)
