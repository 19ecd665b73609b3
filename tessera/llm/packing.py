"""Best-fit packing into bins of several permitted sequence lengths.

Documents are measured in tokens (UTF-8 bytes unless a length column is given)
and cut into pieces no longer than the largest permitted length, so whole
documents are packed. Pieces are dealt evenly over packs of about
``pack_pieces`` pieces, and each pack is packed by itself, longest piece first:

* a piece goes to the open bin whose free room fits it best;
* if none has room, a bin is opened. All permitted lengths that hold the piece
  are weighed: for each, the room left is filled greedily with the pieces still
  to come, and the length with the least cost per token filled is opened. The
  cost of a sequence grows faster than its length (attention);
* at the end each bin is downsized to the smallest permitted length that holds
  its contents.

A pack is the unit of memory and of recovery; more documents give more packs,
so no task grows with the input. Repeated rows (same id and length) are
counted, not gathered, and dealt out in runs of bounded length.

Defined results: a document without tokens (null or empty) takes one empty
piece in no bin (``bin`` and the columns about it are null); repeated rows are
packed once each (``copy`` tells them apart); ties are broken by id, piece and
copy; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Permitted sequence lengths in tokens.
LENGTHS = (2048, 4096, 8192, 16384)
#: Length at which the quadratic share of a sequence's cost equals the linear one.
QUADRATIC_AT = 16384
PACK_PIECES = 4000

BIN_SCHEMA = "bin long, bin_length long, bin_used long, offset long"


def cost(length: int, quadratic_at: int = QUADRATIC_AT) -> float:
    return length * (1 + length / quadratic_at)


class _Remaining:
    """Lengths still to be packed, with their counts."""

    def __init__(self, lengths: Sequence[int]):
        self.count: dict[int, int] = {}
        for n in lengths:
            self.count[n] = self.count.get(n, 0) + 1
        self.sizes = sorted(self.count)

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            del self.count[n]
            self.sizes.pop(bisect.bisect_left(self.sizes, n))

    def fill(self, room: int) -> int:
        """Tokens that greedy filling would put into ``room``."""
        filled, used = 0, {}
        at = bisect.bisect_right(self.sizes, room) - 1
        while at >= 0 and room >= self.sizes[0]:
            n = self.sizes[at]
            k = min(room // n, self.count[n])
            filled += k * n
            room -= k * n
            at = min(at - 1, bisect.bisect_right(self.sizes, room) - 1)
        return filled


def best_fit(lengths: Sequence[int], permitted: Sequence[int] = LENGTHS,
             quadratic_at: int = QUADRATIC_AT) -> tuple[list[int], list[int], list[int], list[int]]:
    """Pack ``lengths`` (longest first): bin and offset of each, used and final length of each bin."""
    permitted = sorted(permitted)
    remaining = _Remaining(lengths)
    rooms: list[int] = []           # free rooms that occur, ascending
    bins_with: dict[int, list[int]] = {}
    bin_of, offset, used, size = [], [], [], []

    def put(room: int, b: int) -> None:
        if room:
            if room not in bins_with:
                bisect.insort(rooms, room)
                bins_with[room] = []
            bins_with[room].append(b)

    for n in lengths:
        remaining.take(n)
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = bins_with[room].pop()
            if not bins_with[room]:
                del bins_with[room]
                rooms.pop(at)
        else:
            room = min((c for c in permitted if c >= n),
                       key=lambda c: (cost(c, quadratic_at) / (n + remaining.fill(c - n)), c))
            b = len(used)
            used.append(0)
            size.append(room)
        bin_of.append(b)
        offset.append(used[b])
        used[b] += n
        put(room - n, b)
    final = [next(c for c in permitted if c >= u) for u in used]
    return bin_of, offset, used, final


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
         permitted: Sequence[int] = LENGTHS, quadratic_at: int = QUADRATIC_AT,
         pack_pieces: int = PACK_PIECES) -> DataFrame:
    """One row per piece: id, ``copy``, ``piece``, ``start``, ``length``, ``pack`` and its place in a bin."""
    longest = max(permitted)
    n = length if length is not None else F.octet_length(F.col(text_col))
    sized = (docs.select(F.col(id_col).alias("id"), F.coalesce(n, F.lit(0)).cast("long").alias("n"))
             .groupBy("id", "n").agg(F.count("*").alias("times")))
    run = 10_000
    copies = (sized.withColumn("first", F.explode(F.expr(f"sequence(0L, (times - 1) div {run})")))
              .withColumn("copy", F.explode(F.expr(f"sequence(first * {run}, least(times, (first + 1) * {run}) - 1)"))))
    pieces = (copies.withColumn("piece", F.explode(F.expr(f"sequence(0L, greatest((n - 1) div {longest}, 0L))")))
              .select("id", "copy", "piece", (F.col("piece") * longest).alias("start"),
                      F.expr(f"least(n - piece * {longest}, {longest})").alias("length")))
    total = sized.agg(F.sum(F.expr(f"times * greatest((n + {longest - 1}) div {longest}, 1)"))).first()[0] or 0
    packs = max(1, -(-total // pack_pieces))
    dealt = pieces.where("length > 0").withColumn("pack", F.pmod(F.xxhash64("id", "copy", "piece"), F.lit(packs)))

    def one(t: pa.Table) -> pa.Table:
        # In Arrow throughout, so that ids of any size and type come back as they are, beside nulls too.
        t = t.take(pc.sort_indices(t, [("length", "descending"), ("id", "ascending"), ("piece", "ascending"), ("copy", "ascending")]))
        bins, offset, used, final = best_fit(t.column("length").to_pylist(), permitted, quadratic_at)
        for name, values in (("bin", bins), ("bin_length", [final[b] for b in bins]), ("bin_used", [used[b] for b in bins]),
                             ("offset", offset)):
            t = t.append_column(name, pa.array(values, pa.int64()))
        return t

    kind = dict(pieces.dtypes)["id"]
    columns = f"id {kind}, copy long, piece long, start long, length long, pack long, {BIN_SCHEMA}"
    packed = dealt.groupBy("pack").applyInArrow(one, columns)
    empty = pieces.where("length = 0").selectExpr(
        "id", "copy", "piece", "start", "length", "CAST(NULL AS long) pack", "CAST(NULL AS long) bin",
        "CAST(NULL AS long) bin_length", "CAST(NULL AS long) bin_used", "CAST(NULL AS long) offset")
    return packed.unionByName(empty).withColumnRenamed("id", id_col)
