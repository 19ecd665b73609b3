"""Near-duplicates by SimHash fingerprints, found through deletion-variant signatures.

A text's 64-bit fingerprint is the majority of the XXH64 values of its word
shingles. Fingerprints that differ in at most ``max_bits`` bits are linked;
linked documents form groups.

Search: the fingerprint is cut into so few segments that, of two fingerprints
to be linked, one segment differs by at most one bit. Every segment is indexed
under its one-wildcard variants (one bit blanked), so that an equality join on
(segment, blanked bit, rest) meets every pair to be linked; the bit distance
is then verified. A signature shared by many fingerprints would pair them all;
those fingerprints meet at every value within half the distance of both
instead: exact as well, and all that meet at a value are linked to each other,
so linking each to the least of them connects the same groups without pairs.

Defined results: null and empty texts have no words and fingerprint zero, which
is linked like any other; texts with fewer words than a shingle have one
shingle; repeated rows stay, one result each, in one group; a null id never
becomes a group's id unless all its ids are null; an empty table gives an empty
result. Extra columns are not read by the search.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import column_bytes, slices
from tessera.llm.components import components
from tessera.session import cut_lineage

#: A signature with more fingerprints than this is searched by values halfway between.
CROWD = 64
_SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: bytes, size: int, seed: int) -> int:
    """Majority of the hashes of all shingles of ``size`` words, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII separators
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    starts, ends = starts[:len(starts) - size + 1].tolist(), ends[size - 1:].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), _SHINGLES_AT_ONCE):
        hashes = np.array([digest(flat[s:e], seed) for s, e in
                           zip(starts[i:i + _SHINGLES_AT_ONCE], ends[i:i + _SHINGLES_AT_ONCE], strict=True)], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = 3, seed: int = 42) -> DataFrame:
    """``id, h, fp``: one row per document, a hash of its text and the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [fingerprint(t, size, seed) for t in column_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("h"), pa.array(found, pa.int64())], ["id", "h", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, h long, fp long")


def segment_masks(max_bits: int) -> list[int]:
    """Masks of the fewest segments of which one differs by at most one bit."""
    n = max_bits // 2 + 1
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(cuts)]


def _signatures(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """One row for each blanked bit, a column for each fingerprint: segment, blanked bit and what remains in one number.

    Numbers may only collide for segments of over 57 bits; what meets is verified anyway.
    """
    out = []
    for s, m in enumerate(segment_masks(max_bits)):
        low = (m & -m).bit_length() - 1
        for bit in range(64):
            if m >> bit & 1:
                out.append(((fps & np.uint64(m & ~(1 << bit))) >> np.uint64(low)) ^ np.uint64((s * 64 + bit) % 128 << 57))
    return np.array(out)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(keys)])


def _pairs(keys: np.ndarray, fps: np.ndarray, max_bits: int, crowd: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (a < b) among the members of each sorted key, and the members of crowded keys."""
    starts, sizes = _runs(keys)
    size = np.repeat(sizes, sizes)
    packed = size > crowd
    a, b = [fps[:0]], [fps[:0]]
    ends = np.repeat(starts + sizes, sizes)
    at = np.flatnonzero(~packed & (size > 1))
    for step in range(1, crowd):
        at = at[at + step < ends[at]]
        if not len(at):
            break
        x, y = fps[at], fps[at + step]
        apart = np.bitwise_count((x ^ y).view(np.uint64))
        near = (apart > 0) & (apart <= max_bits)
        a.append(np.minimum(x[near], y[near]))
        b.append(np.maximum(x[near], y[near]))
    return np.concatenate(a), np.concatenate(b), np.unique(fps[packed])


def _links_table(a: np.ndarray, b: np.ndarray, members: np.ndarray) -> pa.RecordBatch:
    """Links, and crowded members as rows without an end ``b``."""
    ends = pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(len(members), pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, members]), pa.int64()), ends], ["a", "b"])


def links(fps: DataFrame, max_bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """``a, b``: links between distinct values ``fp`` that differ in 1 to ``max_bits`` bits, a < b.

    All of them, but for crowded signatures, whose links connect the same groups.

    One exchange deals (signature, fingerprint) by signature, and each task streams its sorted part. A signature that is
    already crowded within one batch before the exchange sends on just enough members to be known as crowded there
    too; so no task gets more of it than that from each batch.
    """
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 20_000):
            fp = np.asarray(b.column("fp"), np.int64)
            keys = _signatures(fp.view(np.uint64), max_bits).view(np.int64)
            of = np.tile(fp, len(keys))
            keys = keys.reshape(-1)
            order = np.argsort(keys, kind="stable")
            keys, of = keys[order], of[order]
            starts, sizes = _runs(keys)
            place = np.arange(len(keys)) - np.repeat(starts, sizes)
            packed = np.repeat(sizes > crowd, sizes)
            members = np.unique(of[packed])
            going = ~packed | (place <= crowd)
            keys, of = np.concatenate([keys[going], members]), np.concatenate([of[going], members])
            known = np.zeros(len(keys), bool)
            known[len(keys) - len(members):] = True
            for k in range(0, len(keys), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(keys[k:k + (1 << 17)]), pa.array(of[k:k + (1 << 17)]),
                                                  pa.array(known[k:k + (1 << 17)])], ["key", "fp", "crowded"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, of = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of the last key, which may go on
        for b in batches:
            known = b.column("crowded").to_numpy(zero_copy_only=False)
            new, fp = np.asarray(b.column("key")), np.asarray(b.column("fp"))
            keys, of = np.concatenate([keys, new[~known]]), np.concatenate([of, fp[~known]])
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            members = fp[known]
            if len(keys) - last > crowd:
                members = np.concatenate([members, of[last:]])
            yield _links_table(of[:0], of[:0], members)
            yield _links_table(*_pairs(keys[:last], of[:last], max_bits, crowd))
            keys, of = keys[last:last + crowd + 1], of[last:last + crowd + 1]
        yield _links_table(*_pairs(keys, of, max_bits, crowd))

    # An explicit number of partitions: each row becomes one row per bit.
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    dealt = fps.select("fp").mapInArrow(index, "key long, fp long, crowded boolean").repartition("key").sortWithinPartitions("key")
    met = cut_lineage(dealt.mapInArrow(meet, "a long, b long").distinct())
    found = met.where("b IS NOT NULL")
    rest = met.where("b IS NULL").select(F.col("a").alias("fp"))
    if not rest.isEmpty():
        found = found.unionByName(_halfway(rest, max_bits)).distinct()
    return found


def _halfway(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links through the values that differ from a fingerprint in at most half of ``max_bits`` bits."""
    level = fps.select("fp", F.lit(-1).alias("bit"), F.col("fp").alias("key"))
    near = level
    for _ in range((max_bits + 1) // 2):
        level = (level.where("bit < 63").select("fp", "key", F.explode(F.expr("sequence(bit + 1, 63)")).alias("bit"))
                 .select("fp", "bit", F.expr("key ^ shiftleft(1L, bit)").alias("key")))
        near = near.unionByName(level)
    near = near.select("key", "fp")
    if max_bits % 2:  # two that meet may be one bit too far apart
        return _meet(near, max_bits)
    least = near.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    return near.join(least, "key").where("fp <> a").select("a", F.col("fp").alias("b"))


def _meet(index: DataFrame, max_bits: int) -> DataFrame:
    """Equality join of an index with itself, verified by bit distance."""
    left, right = index.select("key", F.col("fp").alias("a")), index.select("key", F.col("fp").alias("b"))
    return _verified(left.join(right, "key").where("a < b"), max_bits)


def _verified(pairs: DataFrame, max_bits: int) -> DataFrame:
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")


def _groups(docs: DataFrame, id_col: str, text_col: str, size: int = 3, seed: int = 42, max_bits: int = 2,
            crowd: int = CROWD) -> DataFrame:
    """``id, h, fp, root, component_id`` per document; ``root`` is the least fingerprint of its group."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col, size, seed))
    values = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = cut_lineage(components(links(values.select("fp"), max_bits, crowd)).select(F.col("node").alias("fp"), "root"))
    grouped = values.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(grouped.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """One row per document: id, ``fp`` and ``component_id``, the smallest id of its group.

    ``search``: ``size`` (words of a shingle), ``seed``, ``max_bits``, ``crowd``.
    """
    return _groups(docs, id_col, text_col, **search).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each group: that with the smallest id.

    A null id counts as the largest. Of rows that share that id, the one whose text has the least hash stays;
    of repeated rows (same id and text) that whose other columns have the least hash.
    """
    first = F.min(F.struct(F.col("id").isNull(), "id", "h")).alias("x")
    chosen = _groups(docs, id_col, text_col, **search).groupBy("root").agg(first).select(
        F.col("x.id").alias("kept_id"), F.col("x.h").alias("kept_h"))
    others = [f"`{c}`" for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.xxhash64(*others).alias("order"),
                       F.struct("*").alias("row"))
    kept = rows.join(chosen, (F.col("h") == F.col("kept_h")) & F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    return kept.groupBy("id", "h").agg(F.min_by("row", "order").alias("row")).select("row.*")
