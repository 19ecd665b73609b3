"""Exact top-k search and whitening: against brute force, and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import pivot_search, queries, vectors, whitening
from tests.llm.helpers import SF, write_tables

NAN, INF = float("nan"), float("inf")
SCHEMA = "label string, vec_id long, embedding array<double>, row long, x string, n int"


def _frame(spark, vectors_by_id):
    """Rows with other columns that carry names the operators use themselves."""
    return spark.createDataFrame([("a", i, v, 7, "x", 3) for i, v in vectors_by_id], SCHEMA)


def _brute(rows, k):
    kept = [(i, tuple(int(np.floor(256 * c)) for c in v)) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a, (q, x) in enumerate(kept):
        if q is None or q % 50:
            continue
        found = sorted((-min(sum(s * t for s, t in zip(x, y)), (1 << 63) - 1), i is None, i or 0) for b, (i, y) in enumerate(kept)
                       if b != a and len(y) == len(x))[:k]
        out += [(q, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(found, 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 6))
    rows = [(i, (centers[i % 12] + 0.02 * rng.normal(size=6)).tolist()) for i in range(600)]
    rows += [(1000 + i, [0.25, 0.5, 0.25, 0.0, 0.0, 0.0]) for i in range(120)]  # equal scores
    rows += [(50, rows[50][1]), (50, rows[50][1]), (None, rows[100][1]), (100, rows[7][1])]  # repeated rows and ids
    rows += [(2000, None), (2050, [NAN] * 6), (2100, [1.0, None, 0, 0, 0, 0]), (2150, [INF, 0, 0, 0, 0, 0])]
    rows += [(2200, [0.0] * 6), (2250, [1.0, 2.0]), (2251, [-3.0, 0.1]), (2300, []), (2301, []), (2350, [4.0])]
    rows += [(2400, [1e12, -1e12]), (2401, [1e12, 1e3])]  # sums beyond a double's whole numbers
    return [(i, v if v is None else [None if c is None else float(c) for c in v]) for i, v in rows]


@pytest.mark.parametrize("block_rows, pivots, at_once", [(20_000, 32, 50_000), (40, 5, 7), (1, 1, 1)])
def test_search_equals_brute_force(spark, clustered, block_rows, pivots, at_once):
    rows = clustered if block_rows > 1 else clustered[:60] + clustered[-14:]
    got = pivot_search.top_k(_frame(spark, rows), F.col("vec_id") % 50 == 0, pivots=pivots, block_rows=block_rows,
                             queries_at_once=at_once)
    assert sorted(map(tuple, got.collect()), key=str) == _brute(rows, 5)


def test_long_vectors_lie_in_small_blocks(spark, clustered, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK_COMPONENTS", 180)  # blocks of 30 rows, 120 queries at once
    got = pivot_search.top_k(_frame(spark, clustered[:300]), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == _brute(clustered[:300], 5)


def test_search_of_all_rows_and_other_k(spark, clustered):
    rows = [(50 * i, v) for i, (_, v) in enumerate(clustered[:150])]
    got = pivot_search.top_k(_frame(spark, rows), F.lit(True), k=3, block_rows=30)
    assert sorted(map(tuple, got.collect()), key=str) == _brute(rows, 3)


def test_bounds_skip_most_of_clustered_rows():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (rng.normal(size=(20, 16))[rng.integers(0, 20, 5000)] + 0.01 * rng.normal(size=(5000, 16)))).astype(np.int64)
    p = pivot_search.choose_pivots(x[:500], 32)
    assert np.allclose((p * p).sum(1), 1)
    norm, angle = pivot_search.angles(x, p)
    s = x[:50].astype(float) @ x.T
    bound = np.outer(norm[:50], norm) * (np.cos(np.abs(angle[:50, None] - angle[None]).max(2)) + 1e-5)
    assert (bound >= s).all()
    assert (bound >= np.sort(s, 1)[:, -5, None]).mean() < 0.1


def test_packed_vectors_are_read_back():
    m = np.array([[1, -128], [127, 0], [-129, 5], [1 << 20, 2], [-(1 << 40), 1 << 60]])
    packed = vectors.pack(m)
    assert [p[0] for p in packed] == [1, 1, 2, 4, 8]
    assert (vectors.unpack(packed) == m).all()


def _expected_white(rows):
    kept = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    d = fit - s / n
    e, w = np.linalg.eigh(d.T @ d / n)
    return kept, x, n, s, e[::-1], w[:, ::-1]


def test_whitening_equals_a_plain_solution(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=20) * np.linspace(3, 0.5, 20)).tolist()) for i in range(400)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (500, None), (501, [NAN] * 20), (502, [None] + [0.0] * 19), (503, [INF] + [0.0] * 19)]
    kept, x, n, s, e, w = _expected_white(rows)
    got = whitening.whiten(_frame(spark, rows)).toPandas().sort_values(["component", "vec_id"], na_position="last")
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == 16 * len(kept) and set(got.n) == {n} and got.identity_error.max() < 1e-12
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0))
    white = (x - s / n) @ w / np.sqrt(e)
    deviation = [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))) for _, v in kept]
    for k in range(16):
        mine = got[got.component == k + 1]
        want = white[order, k]
        assert np.allclose(mine.whitened * np.sign(mine.whitened @ want), want, atol=1e-9)
        assert mine.deviation.tolist() == [deviation[i] for i in order]
        assert np.allclose(mine.explained, e[k] / e.sum(), rtol=1e-10)


def test_whitening_of_lengths_constants_and_few_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 5.0, 3.0]), (3, [2.0, 2.0, 3.0]), (4, [0.5]), (5, [0.5]), (6, []), (7, [1e15, 0.0])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(_frame(spark, rows)).collect()}
    assert sorted(got) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (3, 3), (4, 1), (5, 1), (7, 1), (7, 2)]
    assert got[1, 3].whitened is None and got[1, 3].explained == 0 and got[1, 1].identity_error < 1e-12
    assert got[4, 1].whitened is None and got[4, 1].explained is None and got[4, 1].identity_error is None
    assert got[4, 1].deviation == 0 and got[4, 1].n == 1
    assert whitening.whiten(_frame(spark, rows).limit(0)).count() == 0


def _residual(a, values, x):
    a = a.astype(np.longdouble)
    return float(np.abs(a @ x - x * values).max() / np.abs(values).max()), float(np.abs(x.T @ x - np.eye(len(a))).max())


def test_refinement_reaches_double_precision():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    for values in (np.linspace(1, 2, 40), np.r_[np.linspace(5, 9, 20), 3 + 1e-9 * np.arange(20)], np.r_[np.ones(39), 2.0],
                   np.r_[np.geomspace(1e-6, 1e3, 30), 700 + 1e-7 * np.arange(10)]):
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        e, x = whitening.eigen(a.astype(np.longdouble))
        off, apart = _residual(a, e, x)
        assert off < 1e-16 and apart < 1e-17 and (np.diff(e) <= 1e-15).all()
        assert np.allclose(e.astype(float), np.sort(values)[::-1], rtol=1e-13, atol=1e-13 * values.max())


def test_float32_alone_is_not_enough():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    a = (q * np.linspace(58, 68, 64)) @ q.T
    _, first = np.linalg.eigh(a.astype(np.float32))
    rough = np.abs(first.T.astype(float) @ a @ first - np.diag(np.diag(first.T.astype(float) @ a @ first))).max()
    e, x = whitening.eigen(((a + a.T) / 2).astype(np.longdouble))
    assert rough > 1e-7 and _residual((a + a.T) / 2, e, x)[0] < 1e-16


@pytest.mark.parametrize("name", ["op11_topk_search", "op12_whitening"])
def test_queries_on_an_empty_table(spark, tmp_path, name):
    assert queries.QUERIES[name](spark, write_tables(spark, tmp_path, {})).count() == 0


def test_registered_search_and_whitening_cover_the_table(spark):
    assert queries.op11_topk_search(spark, SF).count() == 5 * 10
    got = queries.op12_whitening(spark, SF)
    assert got.count() == 16 * 500 and got.agg(F.max("identity_error")).first()[0] < 1e-10
