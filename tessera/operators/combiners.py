"""CombinePerKey with a user's combiner: accumulators that are merged batch by batch.

A combiner says how values become accumulators, how the accumulators of a key are merged, and what is read from them in
the end. Each step gets whole Arrow batches with the keys' runs of rows, one Python call for a batch and not for a key.

The work is that of any combiner: every task merges what it reads into one accumulator a key, these are dealt by key,
sorted, and merged again while they stream by. A hot key reaches its last task as one accumulator for each task; a task
holds ``held_keys`` keys at most and passes on what it has beyond, so memory is bounded.

Keys stay in Arrow throughout: longs beyond 2^53 and null keys (which form a key of their own) are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

#: Keys that a task holds accumulators of before it passes them on.
HELD_KEYS = 200_000
#: Rows that are gathered, at least, before they are merged.
MERGED_ROWS = 1 << 16

#: Accumulator columns, in the order of the combiner's declaration.
Columns = list[pa.Array]


@dataclass(frozen=True)
class Combiner:
    """``accumulator``: DDL of the accumulator's columns; ``result``: type of the result.

    * ``create(values) -> columns``: one accumulator for each value of a batch;
    * ``merge(columns, starts) -> columns``: the accumulators of a key lie together, key i from row ``starts[i]`` on;
      one accumulator for each key (merging one must give it back);
    * ``finish(columns) -> array``: one result for each accumulator.

    ``merge`` is associative and commutative; ``create`` and ``finish`` keep the number of rows.
    """

    accumulator: str
    result: str
    create: Callable[[pa.Array], Columns]
    merge: Callable[[Columns, np.ndarray], Columns]
    finish: Callable[[Columns], pa.Array]


def _runs(key: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Order that puts equal keys together, and where each begins (nulls are a key)."""
    codes = key.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    return pa.array(order), np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)


def _merged(t: pa.Table, combiner: Combiner) -> pa.Table:
    """One row per key of ``t`` (key, then accumulator columns)."""
    if not t.num_rows:
        return t
    order, starts = _runs(t.column(0).combine_chunks())
    t = t.take(order)
    found = combiner.merge([c.combine_chunks() for c in t.columns[1:]], starts)
    return pa.table([t.column(0).take(pa.array(starts)), *(c.cast(f.type) for c, f in zip(found, list(t.schema)[1:], strict=True))], schema=t.schema)


def combine_with(df: DataFrame, key: str, value: str, combiner: Combiner, out: str = "total",
                 held_keys: int = HELD_KEYS) -> DataFrame:
    """``key, out``: one row per key, its values combined by ``combiner``. An empty input gives no rows."""
    kind = df.schema[key].dataType
    k = F.col(key)
    if kind.typeName() in ("double", "float"):  # as in grouping: one NaN, one zero
        k = F.when(F.isnan(k), F.lit(float("nan")).cast(kind)).otherwise(k + F.lit(0).cast(kind))
    names = StructType.fromDDL(combiner.accumulator).fieldNames()
    columns = ["key", *(f"acc_{i}" for i in range(len(names)))]
    held_ddl = ", ".join([f"key {kind.simpleString()}", *(f"acc_{i} {f.dataType.simpleString()}" for i, f in
                                                          enumerate(StructType.fromDDL(combiner.accumulator).fields))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = merged = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(pa.table([b.column(0), *combiner.create(b.column(1))], columns))
            rows += b.num_rows
            if rows >= max(MERGED_ROWS, 2 * merged):
                held = [_merged(pa.concat_tables(held), combiner)]
                rows = merged = held[0].num_rows
                if merged > held_keys:
                    yield from held[0].to_batches()
                    held, rows, merged = [], 0, 0
        if held:
            yield from _merged(pa.concat_tables(held), combiner).to_batches()

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by key: the last key of a batch may go on in the next and is kept back.
        last: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            now = pa.Table.from_batches([b])
            now = _merged(now if last is None else pa.concat_tables([last, now]), combiner)
            last = now.slice(now.num_rows - 1)
            yield from result(now.slice(0, now.num_rows - 1))
        if last is not None:
            yield from result(last)

    def result(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if t.num_rows:
            yield pa.RecordBatch.from_arrays([t.column(0).combine_chunks(), combiner.finish([c.combine_chunks() for c in t.columns[1:]])], ["key", "out"])

    partials = df.select(k.alias("key"), F.col(value).alias("value")).mapInArrow(partial, held_ddl)
    found = partials.repartition("key").sortWithinPartitions("key").mapInArrow(final, f"key {kind.simpleString()}, out {combiner.result}")
    return found.select(F.col("key").alias(key), F.col("out").alias(out))


def _numbers(column: pa.Array, as_objects: bool = False) -> np.ndarray:
    """Numbers without nulls as a numpy array; other values (or all, if asked) as Python objects."""
    plain = pa.types.is_integer(column.type) or pa.types.is_floating(column.type) or pa.types.is_boolean(column.type)
    if plain and not as_objects:
        return column.to_numpy(zero_copy_only=False)
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def _reduce(fn: np.ufunc, column: pa.Array, starts: np.ndarray) -> pa.Array:
    """``fn`` over each run of rows; nulls are left out, a run of nulls alone is null."""
    run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(column)]))
    there = column.is_valid().to_numpy(zero_copy_only=False)
    values, run = _numbers(column.drop_null(), as_objects=fn.types == ["OO->O"]), run[there]
    out = np.full(len(starts), None, object)
    if len(values):
        first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        got = fn.reduceat(values, first)
        if len(first) == len(starts):
            return pa.array(got, column.type)
        out[run[first]] = got.tolist()
    return pa.array(out, column.type)


def reducing(fn: np.ufunc | Callable, result: str) -> Combiner:
    """Values combined by two: a numpy ufunc (``np.add``, ``np.maximum``), or any function of two values.

    Nulls are left out; a key of nulls alone gives null.
    """
    def merge(columns: Columns, starts: np.ndarray) -> Columns:
        # Made in the task: a function wrapped by numpy cannot be sent.
        ufunc = fn if isinstance(fn, np.ufunc) else np.frompyfunc(fn, 2, 1)
        return [_reduce(ufunc, columns[0], starts)]

    return Combiner(f"value {result}", result, lambda values: [values], merge, lambda columns: columns[0])


def mean() -> Combiner:
    """The mean of the values that are not null, from a sum and a count."""
    return Combiner("total double, n long", "double",
                    lambda values: [values.cast(pa.float64(), safe=False), values.is_valid().cast(pa.int64())],
                    lambda columns, starts: [_reduce(np.add, columns[0], starts), _reduce(np.add, columns[1], starts)],
                    lambda columns: pc.divide(columns[0], columns[1].cast(pa.float64())))


def largest(k: int, kind: str) -> Combiner:
    """The ``k`` largest values of each key, in falling order, nulls left out."""
    def create(values: pa.Array) -> Columns:
        there = values.is_valid().to_numpy(zero_copy_only=False)
        ends = np.r_[0, np.cumsum(there)].astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), values.drop_null())]

    def merge(columns: Columns, starts: np.ndarray) -> Columns:
        lists = columns[0]
        row = pc.list_parent_indices(lists).to_numpy()
        flat = lists.flatten()
        run = np.searchsorted(starts, row, "right") - 1
        order = pc.sort_indices(pa.table([pa.array(run), flat], ["run", "v"]), [("run", "ascending"), ("v", "descending")]).to_numpy()
        run = run[order]
        first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.zeros(0, np.int64)
        place = np.arange(len(run)) - np.repeat(first, np.diff(np.r_[first, len(run)]))
        kept = place < k
        ends = np.r_[0, np.cumsum(np.bincount(run[kept], minlength=len(starts)))].astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), flat.take(pa.array(order[kept])))]

    return Combiner(f"values array<{kind}>", f"array<{kind}>", create, merge, lambda columns: columns[0])


def of_series(fn: Callable[[pd.Series], object], result: str) -> Combiner:
    """A function of all values of a key as a pandas Series, called for each key: for what the others cannot say."""
    def merge(columns: Columns, starts: np.ndarray) -> Columns:
        values = pd.Series(_numbers(columns[0]) if not columns[0].null_count else pd.array(columns[0].to_pylist()))
        ends = np.r_[starts[1:], len(values)]
        return [pa.array([fn(values.iloc[a:b]) for a, b in zip(starts, ends, strict=True)], columns[0].type, from_pandas=True)]

    return Combiner(f"value {result}", result, lambda values: [values], merge, lambda columns: columns[0])
