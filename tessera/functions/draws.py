"""Deterministic pseudo-random draws as column expressions.

A draw is a 32-bit integer hash of a BIGINT seed column and a constant salt:
the seed is folded to 32 bits, offset by the salt, then mixed with two
xor-shift-multiply rounds (a well-known 32-bit integer mixer). Everything is
BIGINT arithmetic that cannot overflow (values stay below 2^59), so any SQL
engine computes the same bits, and a re-executed task (lost executor,
speculative copy) reproduces exactly the same rows. It is a handful of
integer operations per draw, inside whole-stage codegen.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK = 0xFFFFFFFF
_GOLDEN = 0x9E3779B9
_MIX = 0x45D9F3B


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def salt_of(name: str, slot: int = 0) -> int:
    """Stable 16-bit salt for a named draw."""
    return zlib.crc32(f"{name}:{slot}".encode()) & 0xFFFF


def draw(seed, salt: str, slot: int = 0) -> Column:
    """Unsigned 32-bit draw ``(salt, slot)`` for an integer ``seed``."""
    k = _c(seed).cast("bigint")
    x = (k.bitwiseXOR(F.shiftright(k, 32)) + F.lit(salt_of(salt, slot) * _GOLDEN)).bitwiseAND(F.lit(_MASK))
    for _ in range(2):
        x = (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(_MIX)).bitwiseAND(F.lit(_MASK))
    return F.shiftright(x, 16).bitwiseXOR(x)


def draw_sql(seed: str, salt: str, slot: int = 0) -> str:
    """Spark SQL text of ``draw`` for a column name (one parse in the JVM
    instead of one Python-to-JVM call per operator)."""
    k = f"CAST({seed} AS BIGINT)"
    x = f"((({k} ^ shiftright({k}, 32)) + {salt_of(salt, slot) * _GOLDEN}L) & {_MASK}L)"
    for _ in range(2):
        x = f"(((shiftright({x}, 16) ^ {x}) * {_MIX}L) & {_MASK}L)"
    return f"(shiftright({x}, 16) ^ {x})"


def weighted_pick_sql(u: str, choices: Sequence[tuple[str, int]]) -> str:
    """Spark SQL text of ``weighted_pick``."""
    parts, acc = [], 0
    for label, w in choices[:-1]:
        acc += w
        parts.append(f"WHEN {u} < {acc} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{choices[-1][0]}' END"


def weighted_index_sql(u: str, weights: Sequence[int]) -> str:
    """Spark SQL text of ``weighted_index``."""
    parts, acc = [], 0
    for i, w in enumerate(weights[:-1]):
        acc += w
        parts.append(f"WHEN {u} < {acc} THEN {i}")
    return f"CASE {' '.join(parts)} ELSE {len(weights) - 1} END"


# DuckDB text of the same draws, for the oracles.
def sql_draw(seed: str, salt: str, slot: int = 0) -> str:
    k = f"CAST({seed} AS BIGINT)"
    x = f"((xor({k}, {k} >> 32) + {salt_of(salt, slot) * _GOLDEN}) & {_MASK})"
    for _ in range(2):
        x = f"((xor({x} >> 16, {x}) * {_MIX}) & {_MASK})"
    return f"xor({x} >> 16, {x})"
