"""Exact top-k search by inner product, with a pivot table.

Every vector's angles to a few pivots are computed once. The angle between directions is a metric, so
``|angle(q, p) - angle(x, p)|`` bounds the angle between a query q and a candidate x from below for each pivot p;
the greatest of these bounds gives ``|q| |x| cos(bound)``, which no inner product of the two exceeds.

Candidates lie in blocks of bounded size: those nearest to one pivot, dealt by hash where they are many. A query

1. searches its own block, which gives a first k-th best score;
2. skips every block whose ranges of angles and greatest norm cannot reach that score;
3. searches the others: candidates are evaluated in the order of their bounds, in growing rounds, and the search
   of a block stops once no bound left reaches the k-th best score. Ties are evaluated too, so the result is exact.

Where the directions of all vectors are spread evenly (many dimensions, no clusters), the bounds rule out little and
nearly all candidates are evaluated: the work is then that of queries times rows, in blocks.

Pivots are chosen farthest first from a sample of ``SAMPLE`` rows (the least hashes); they decide how much is skipped,
never the result. Scores are exact: sums that a double cannot hold are added as Python integers (and cut to a long).

Defined results: rows whose vector is null or holds null, NaN or infinite components take no part; a query's
candidates are all other rows with vectors of its length, a row being told apart from its copies, which are candidates
like any other; equal scores are ranked by id, null ids last; repeated query rows give their results once each; a row with a null id is
a candidate, and a query if the caller's condition says so; fewer than k candidates give fewer rows; an empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.vectors import by_length, unpack, whole_numbers
from tessera.session import cut_lineage

SAMPLE = 2000
PIVOTS = 32
#: Rows of a block, and the most blocks whose ranges are sent to the tasks (blocks grow beyond).
BLOCK_ROWS = 20_000
MOST_BLOCKS = 16_384
#: Queries that meet a block in one task, and components of a block's vectors at most (long vectors lie in smaller blocks).
QUERIES_AT_ONCE = 50_000
BLOCK_COMPONENTS = 1 << 22
#: Slack for angles (radians) and relative slack for bounds, above their rounding errors in single precision.
_ANGLE_SLACK, _SLACK = 1e-5, 1e-5
_CHUNK = 16
_FIRST_ROUND = 64
_EXACT = 1 << 53


def angles(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the rows of ``x`` and their angles to unit ``pivots`` (a right angle for zero vectors)."""
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    cos = (x / np.maximum(norm, 1e-300)[:, None]) @ pivots.T
    return norm, np.arccos(np.clip(cos, -1, 1)).astype(np.float32)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors of the sample, each farthest from those chosen before, starting from the first."""
    x = sample.astype(np.float64)
    x = x[np.abs(x).sum(1) > 0]
    if not len(x):
        return np.zeros((0, sample.shape[1]))
    x /= np.sqrt((x * x).sum(1))[:, None]
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < count and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


class _Rows:
    """Rows of one block or query set, as arrays; by id, null ids last."""

    def __init__(self, t: pa.Table, width: int):
        t = t.take(pc.sort_indices(t, [("id", "ascending")], null_placement="at_end"))
        self.row, self.id = np.asarray(t.column("row")), t.column("id").combine_chunks()
        self.x = unpack(t.column("x").to_pylist())
        self.exact = self.x.astype(np.float64)
        self.norm = np.asarray(t.column("norm"), np.float64)
        self.angle = np.frombuffer(b"".join(t.column("angle").to_pylist()), np.float32).reshape(len(self.row), width)


def _scores(q: _Rows, at: np.ndarray, c: _Rows, which: np.ndarray | slice) -> np.ndarray:
    """Exact inner products of queries ``at`` with candidates ``which``, as longs."""
    if q.norm[at].max(initial=0) * c.norm.max(initial=0) < _EXACT:
        return (q.exact[at] @ c.exact[which].T).astype(np.int64)
    found = q.x[at].astype(object) @ c.x[which].astype(object).T
    return np.clip(found, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _search(q: _Rows, floor: np.ndarray, c: _Rows, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its best candidates (indices and scores), best first; only scores of at least ``floor``."""
    m = len(c.row)
    across = np.ascontiguousarray(c.angle.T)
    for start in range(0, len(q.row), _CHUNK):
        at = np.arange(start, min(start + _CHUNK, len(q.row)))
        apart, held = np.zeros((len(at), m), np.float32), np.empty((len(at), m), np.float32)
        for p in range(len(across)):
            np.subtract(across[p], q.angle[at, p, None], out=held)
            np.abs(held, out=held)
            np.maximum(apart, held, out=apart)
        product = np.outer(q.norm[at], c.norm)
        bound = product * (np.cos(np.maximum(apart - _ANGLE_SLACK, 0)) + _SLACK)
        own = c.row == q.row[at, None]
        bound[own] = -np.inf
        least = floor[at].astype(np.float64)
        # First round: the candidates of greatest bound, which raise the k-th best score.
        first = min(m, max(_FIRST_ROUND, 4 * k))
        top = np.argpartition(-bound, first - 1, axis=1)[:, :first] if first < m else np.tile(np.arange(m), (len(at), 1))
        everything = None
        for i, one in enumerate(at.tolist()):
            seen = top[i][~own[i, top[i]]]
            scores = _scores(q, np.array([one]), c, seen)[0]
            if len(scores) >= k:
                least[i] = max(least[i], float(np.partition(scores, len(scores) - k)[len(scores) - k]))
            # What is left in reach, if anything: the bounds of all others are below the k-th best score.
            if first < m:
                left = np.flatnonzero(bound[i] >= least[i])
                if len(left) > m // 4:
                    if everything is None:
                        everything = _scores(q, at, c, slice(None))
                    seen, scores = left, everything[i, left]
                else:
                    seen, scores = left, _scores(q, np.array([one]), c, left)[0]
            good = np.flatnonzero(scores >= least[i])
            good = good[np.argsort(seen[good], kind="stable")]  # by id
            good = good[np.argsort(~scores[good], kind="stable")[:k]]  # ~s falls as s rises, without overflow
            yield one, seen[good], scores[good]


def _found(q: _Rows, c: _Rows, hits: Iterator[tuple[int, np.ndarray, np.ndarray]], kind: pa.DataType) -> pa.Table:
    of, which, scores = [], [], []
    for one, seen, s in hits:
        of += [one] * len(seen)
        which += seen.tolist()
        scores += s.tolist()
    at = pa.array(of, pa.int64())
    return pa.table([pa.array(q.row[of] if of else [], pa.int64()), q.id.take(at).cast(kind),
                     c.id.take(pa.array(which, pa.int64())).cast(kind), pa.array(scores, pa.int64())],
                    ["query_row", "query_id", "id", "score"])


def top_k(rows: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
          scale: int = 256, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS,
          queries_at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """``query_id, rank, id, score``: each query's k rows of highest inner product of whole-number vectors.

    ``queries`` is a condition on the columns of ``rows`` that says which rows are queries.
    """
    keep = {"id": F.col(id_col), "query": F.coalesce(queries, F.lit(False)).cast("boolean")}
    # Numbered and written down once, so that a row keeps its number whatever is computed again.
    numbered = cut_lineage(whole_numbers(rows, vector_col, scale, keep).withColumn("row", F.monotonically_increasing_id()))
    kind = numbered.schema["id"].dataType
    typed = kind.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(typed)
    if arrow is None:
        raise TypeError(f"ids are long, int or string, not {typed}")
    seen = numbered.orderBy(F.xxhash64("x"), "row").limit(SAMPLE).select("dim", "x").collect()
    table = {dim: choose_pivots(unpack([bytes(seen[i].x) for i in at]), pivots)
             for dim, at in by_length(np.array([r.dim for r in seen], np.int64))}

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norms, cells, held = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int32), [b""] * b.num_rows
            packed = b.column("x").to_pylist()
            for dim, at in by_length(np.asarray(b.column("dim"))):
                norm, angle = angles(unpack([packed[i] for i in at.tolist()]), table.get(dim, np.zeros((0, dim))))
                norms[at] = norm
                cells[at] = angle.argmin(1) if angle.shape[1] else 0
                for i, a in zip(at.tolist(), angle, strict=True):
                    held[i] = a.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norms), pa.array(held, pa.binary()), pa.array(cells)],
                                             [*b.schema.names, "norm", "angle", "cell"])

    located = numbered.mapInArrow(locate, f"id {typed}, query boolean, dim int, x binary, row long, norm double, angle binary, cell int")
    cells = cut_lineage(located.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count_if("query").alias("asked")))
    total, asked, longest = cells.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "asked")], F.coalesce(F.max("dim"), F.lit(1))).first()
    at_once = max(1, min(queries_at_once, 4 * BLOCK_COMPONENTS // max(1, longest)))
    chunks = max(1, -(-asked // at_once))
    fitting = F.expr(f"greatest(least({block_rows}, {BLOCK_COMPONENTS} div greatest(dim, 1)), {-(-total // MOST_BLOCKS)}, 1)")
    parts = cells.select("dim", "cell", F.ceil(F.col("n") / fitting).cast("int").alias("parts"))
    # One row for each pivot of the sample and each length without one.
    located = cut_lineage(located.join(F.broadcast(parts), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts"))
    block = ["dim", "cell", "part"]
    columns = f"query_row long, query_id {typed}, id {typed}, score long"

    def at_home(t: pa.Table) -> pa.Table:
        width = len(table.get(t.column("dim")[0].as_py(), ()))
        c = _Rows(t, width)
        asks = t.filter(t.column("query"))
        q = _Rows(asks, width) if asks.num_rows else None
        hits = _search(q, np.full(len(q.row), -np.inf), c, k) if q else iter(())
        return _found(q or c, c, hits, arrow)

    home = cut_lineage(located.groupBy(*block).applyInArrow(at_home, columns))
    floors = home.groupBy(F.col("query_row").alias("row")).agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    asking = located.where("query").join(floors, "row", "left")
    ranges = _ranges(located, block, {d: len(p) for d, p in table.items()})

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for every other block that its k-th best score does not rule out."""
        for b in batches:
            given = b.to_pydict()
            out = []
            for i in range(b.num_rows):
                dim = given["dim"][i]
                keys, low, high, norm = ranges[dim]
                a = np.frombuffer(given["angle"][i], np.float32)
                apart = np.maximum(low - a, a - high).max(1, initial=0) if len(a) else np.zeros(len(keys))
                bound = given["norm"][i] * norm * (np.maximum(np.cos(np.maximum(apart - _ANGLE_SLACK, 0)), 0) + _SLACK)
                floor = given["floor"][i]
                reach = bound >= (-np.inf if floor is None else floor)
                out += [(i, *keys[j]) for j in np.flatnonzero(reach).tolist()
                        if keys[j] != (given["cell"][i], given["part"][i])]
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(at) for c in ("id", "dim", "x", "row", "norm", "angle", "floor")),
                 pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int32())],
                ["id", "dim", "x", "row", "norm", "angle", "floor", "cell", "part"])

    away = asking.mapInArrow(spread, f"id {typed}, dim int, x binary, row long, norm double, angle binary, floor long, cell int, part int") \
        .withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"))
    candidates = located.drop("query").withColumn("chunk", F.explode(F.expr(f"sequence(0, {chunks - 1})")))

    def meet(asks: pa.Table, t: pa.Table) -> pa.Table:
        width = len(table.get((asks if asks.num_rows else t).column("dim")[0].as_py(), ()))
        if not asks.num_rows or not t.num_rows:
            c = _Rows(t if t.num_rows else asks, width)
            return _found(c, c, iter(()), arrow)
        asks = asks.take(pc.sort_indices(asks, [("id", "ascending")], null_placement="at_end"))
        floor = np.asarray(pc.fill_null(asks.column("floor").cast(pa.float64()), -np.inf))
        q, c = _Rows(asks, width), _Rows(t, width)
        return _found(q, c, _search(q, floor, c, k), arrow)

    by = [*block, "chunk"]
    met = away.groupBy(*by).cogroup(candidates.groupBy(*by)).applyInArrow(meet, columns)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return (home.unionByName(met).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def _ranges(located: DataFrame, block: list[str], widths: dict[int, int]) -> dict:
    """By length of vectors: the blocks (cell, part), least and greatest angle to each pivot, greatest norm.

    One row for each block, and there are at most ``MOST_BLOCKS`` of them beside one for each cell.
    """
    def run(t: pa.Table) -> pa.Table:
        a = np.frombuffer(b"".join(t.column("angle").to_pylist()), np.float32).reshape(t.num_rows, -1)
        return pa.table([*(t.column(c).slice(0, 1) for c in block), pa.array([a.min(0).tobytes()], pa.binary()),
                         pa.array([a.max(0).tobytes()], pa.binary()), pa.array([max(t.column("norm").to_pylist())])],
                        [*block, "low", "high", "norm"])

    found = located.select(*block, "angle", "norm").groupBy(*block).applyInArrow(
        run, "dim int, cell int, part int, low binary, high binary, norm double").collect()
    out = {}
    for dim, at in by_length(np.array([r.dim for r in found], np.int64)):
        own = [found[i] for i in at.tolist()]
        read = lambda values, n=widths.get(dim, 0): np.array([np.frombuffer(v, np.float32) for v in values]).reshape(len(values), n)
        out[dim] = ([(r.cell, r.part) for r in own], read([r.low for r in own]), read([r.high for r in own]),
                    np.array([r.norm for r in own]))
    return out
