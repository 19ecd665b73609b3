"""Benchmark decontamination by a prefix-filtered set join, with built-in functions only.

A benchmark item is cut into windows of ``window`` consecutive words (an item
with fewer words is one window), a window into its shingles of up to three
words. One pass over the documents keeps the positions of shingles that occur
in the benchmark. Containment of a whole window needs every one of its
shingles, so one is a sufficient prefix: shingles are ordered by their rarity
in the documents and the rarest one of each window is joined. Positional and
length bounds (the window must start and end inside the text) thin the
candidates; a candidate is verified when all its shingles stand at their places
in the text. Texts are never shuffled, only positions, and each distinct text
is verified once however many copies it has. Words are hashed once, shingles from
their words' hashes; shingles are compared by 64-bit and texts by 128-bit hashes.

Defined results: null and empty texts, and null items, have no words and hit
nothing; repeated rows give one result each; repeated benchmark rows count as
one item, null item_ids are not listed; with an empty benchmark nothing is hit;
an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame, functions as F

from tessera.session import cut_lineage

WINDOW = 10
SHINGLE = 3
#: The benchmark's shingles are broadcast up to this number of 16-byte rows, else joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else (plain lower() only where all is ASCII)."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def words(text: Column) -> Column:
    """Runs of digits, a-z and characters beyond ASCII, after lower-casing; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAK), "")


def _windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``item, wid, size, words``: the windows of each item."""
    w = benchmark.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    cut = w.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))).alias("i"))
    return (cut.select("item", F.slice("w", F.col("i"), F.lit(window)).alias("words"))
            .select("item", F.xxhash64("words").alias("wid"), F.size("words").alias("size"), "words"))


def _hashed(w: str) -> Column:
    """The hash of each word in the array column ``w``."""
    return F.transform(w, lambda word: F.xxhash64(word))


def _shingles(w: str, length: int) -> Column:
    """Hashes of all runs of ``length`` words in ``w``, an array column of word hashes, in order."""
    runs = F.transform(w, lambda word, i: F.xxhash64(word, *[F.get(F.col(w), i + k) for k in range(1, length)]))
    return F.slice(runs, F.lit(1), F.greatest(F.size(w) - (length - 1), F.lit(0)))


def hits(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``items`` (sorted as strings), ``text_key``."""
    item_windows = cut_lineage(_windows(benchmark, item_col, item_text_col, window).distinct())
    distinct = item_windows.select("wid", "size", "words").dropDuplicates(["wid"])
    lengths = sorted(r[0] for r in distinct.select(F.least("size", F.lit(SHINGLE))).distinct().collect())  # 1 to 3
    parts = functools.reduce(DataFrame.unionByName, [
        distinct.where(F.least("size", F.lit(SHINGLE)) == n)
        .select("wid", "size", _hashed("words").alias("w"))
        .select("wid", "size", F.posexplode(_shingles("w", n)).alias("off", "h")) for n in lengths or [SHINGLE]])
    parts = cut_lineage(parts)
    known = parts.select("h").distinct()
    small = known.count() <= BROADCAST_ROWS

    # One pass over the texts. Place 0 stands for the document itself, place p for the shingle at word p - 1.
    rows = []
    for n in lengths or [SHINGLE]:
        text = docs.select(F.col(doc_col).alias("id"), F.col(text_col).alias("t")).select(
            "id", F.xxhash64("t").alias("k1"), F.xxhash64(F.lit(0), "t").alias("k2"), words(F.col("t")).alias("w")).withColumn("w", _hashed("w"))
        head = F.array(F.lit(0).cast("long")) if not rows else F.array().cast("array<long>")
        found = text.select("id", "k1", "k2", F.size("w").alias("n"),
                            F.posexplode(F.concat(head, _shingles("w", n))).alias("place", "h"))
        if rows:
            found = found.withColumn("place", F.col("place") + 1)
        rows.append(found)
    rows = functools.reduce(DataFrame.unionByName, rows)
    wanted = known.unionByName(known.sparkSession.range(1).select(F.lit(0).cast("long").alias("h"))).distinct()
    rows = cut_lineage(rows.join(F.broadcast(wanted) if small else wanted, "h", "left_semi"))

    documents = rows.where("place = 0").select("id", "k1", "k2", F.col("n").cast("long").alias("n_words"))
    places = rows.where("place > 0").select("k1", "k2", "n", "place", "h").distinct()
    places = cut_lineage(places)
    rarity = places.groupBy("h").agg(F.count("*").alias("seen"))
    # A window with a shingle that no document has is dropped here: it cannot occur.
    prefix = (parts.join(rarity, "h", "left")
              .groupBy("wid", "size").agg(F.min(F.struct("seen", "h", "off")).alias("rare"))
              .where("rare.seen IS NOT NULL").select("wid", "size", "rare.h", "rare.off"))
    candidates = (places.join(prefix, "h").withColumn("start", F.col("place") - F.col("off"))
                  .where("start >= 1 AND start + size - 1 <= n").select("k1", "k2", "start", "wid", "size"))
    needed = (candidates.join(parts.select("wid", "off", "h"), "wid")
              .select("k1", "k2", "start", "wid", "size", (F.col("start") + F.col("off")).alias("place"), "h"))
    verified = cut_lineage(
        needed.join(places.select("k1", "k2", "place", "h"), ["k1", "k2", "place", "h"])
        .groupBy("k1", "k2", "start", "wid", "size").agg(F.count("*").alias("met"))
        .where(f"met = size - least(size, {SHINGLE}) + 1").drop("met"))
    covered = (verified.select("k1", "k2", F.explode(F.expr("sequence(start, start + size - 1)")).alias("word")).distinct()
               .groupBy("k1", "k2").agg(F.count("*").alias("n_hit")))
    listed = (verified.select("k1", "k2", "wid").distinct()
              .join(item_windows.where("item IS NOT NULL").select("wid", F.col("item").cast("string").alias("item")), "wid")
              .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items")))
    # Written down, so that the join below stands alone and a text with many copies can be split over tasks.
    per_text = cut_lineage(covered.join(listed, ["k1", "k2"], "left"))
    return (documents.join(per_text, ["k1", "k2"], "left")
            .select(F.col("id").alias(doc_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.struct("k1", "k2").alias("text_key")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no word inside a benchmark window."""
    found = hits(docs, benchmark, text_col=text_col, **how).where("n_hit > 0").select(
        F.col("text_key.k1").alias("k1"), F.col("text_key.k2").alias("k2")).distinct()
    rows = docs.select(F.xxhash64(F.col(text_col)).alias("k1"), F.xxhash64(F.lit(0), F.col(text_col)).alias("k2"),
                       F.struct("*").alias("row"))
    return rows.join(found, ["k1", "k2"], "left_anti").select("row.*")
