"""Spelling variants: words one edit apart, found in bitsets by letter and position.

Words are the maximal runs of letters of whole texts, counted over all documents. (A rule that garbles a few of them,
see ``words``, belongs to the query's contract.) Two words are near if they differ by exactly one inserted, deleted or
replaced code point.

The vocabulary is cut into shards of words of one length. A shard holds, for each position and letter, a bitset over
its words: bit w of ``(p, a)`` says that word w has letter a at position p. All words of a shard are compared with a query word
at once, 64 a machine word, by two sets that move along the query's letters: words that agree so far without an error, and
words that agree so far with one. With ``row(p, a)`` the bitset and q the query,

* same length, one replaced:  ``one = one & row(i, q[i]) | zero & ~row(i, q[i])``
* one letter more in the word: ``one = one & row(i + 1, q[i]) | zero``, the word shifted by one position
* one letter less in the word: ``one = one & row(i - 1, q[i]) | zero before the letter``

and ``zero = zero & row(i, q[i])``. Every word meets all shards of its length, of one more and one less. A shard's
words are sorted by falling count, then by word, so the lowest bit set is the best near word, and the number of bits
set is the number of near words: a task returns one row for each word and shard, never the pairs.

Shards have a bounded number of letters, and the words that meet a shard are dealt over as many copies of it as their
number asks for, so no task grows with the vocabulary.

A word's form is its near word of largest count (ties: smallest in code-point order), if that count is at least
``factor`` times its own. Counts thus grow along forms, and a word's root is reached in a logarithmic number of them.

Defined results: a null or empty text has no words; a null id is spelled as the empty text in the garbling rule; repeated
rows count each; case other than A-Z is kept; without words the result is empty. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import column_bytes, slices
from tessera.session import cut_lineage

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Words of a shard, and its letters, at most (a shard has one word at least).
SHARD_WORDS, SHARD_LETTERS = 1 << 15, 1 << 20
#: Words that meet one copy of a shard.
QUERY_WORDS = 200_000
#: Distinct words a task holds before it passes their counts on.
HELD_WORDS = 200_000
_BATCH_BYTES = 1 << 18


def garbled(run: str, doc_id: str, every: int) -> str:
    """The lower-cased run, without one code point for one in ``every`` (document, run) by checksum."""
    h = crc32(f"{doc_id}:{run}".encode())
    return run if not every or h % every else run[:h % len(run)] + run[h % len(run) + 1:]


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 0, least_length: int = 6) -> DataFrame:
    """``word, n``: the words of at least ``least_length`` code points and their numbers over all texts.

    ``every``: the checksum of ``id:run`` decides which runs lose a letter (0: none).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in slices(batches):
            for doc_id, text in zip(b.column("id").to_pylist(), column_bytes(b.column("text")), strict=True):
                runs = Counter(_RUN.findall(text.decode("utf-8", "replace").translate(_LOWER)))
                for w, n in runs.items():
                    # A run at the least length may only get shorter.
                    if len(w) >= least_length and len(w := garbled(w, doc_id or "", every)) >= least_length:
                        held[w] += n
                if len(held) >= HELD_WORDS:
                    yield given()
                    held.clear()
        yield given()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """The bitsets of the words of one shard, all of ``length`` code points."""

    def __init__(self, words: list[str], length: int):
        self.words, self.length = words, length
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)
        self.letters = np.unique(codes)
        self.cells = -(-len(words) // 64)
        # The last letter stands for all that no word has: its bitsets are empty.
        self.bits = np.zeros((length, len(self.letters) + 1, self.cells), np.uint64)
        of = np.searchsorted(self.letters, codes)
        w = np.arange(len(words))
        bit = np.uint64(1) << (w % 64).astype(np.uint64)
        for p in range(length):
            np.bitwise_or.at(self.bits[p], (of[:, p], w // 64), bit)
        self.all = np.zeros(self.cells, np.uint64)
        np.bitwise_or.at(self.all, w // 64, bit)

    def rows(self, p: int, letters: np.ndarray) -> np.ndarray:
        return self.bits[p, letters]

    def near(self, queries: list[str]) -> np.ndarray:
        """For each query (all of one length) the bitset of words exactly one edit away."""
        n = len(queries[0])
        codes = np.frombuffer("".join(queries).encode("utf-32-le"), "<u4").reshape(len(queries), n)
        at = np.searchsorted(self.letters, codes)
        at = np.where(self.letters[np.minimum(at, len(self.letters) - 1)] == codes, at, len(self.letters))
        zero = np.tile(self.all, (len(queries), 1))
        more = self.length - n
        one = zero.copy() if more == 1 else np.zeros_like(zero)
        for i in range(n):
            here = self.rows(i, at[:, i]) if i < self.length else 0
            if more == 0:
                one = one & here | zero & ~here
                zero = zero & here
            elif more == 1:
                zero = zero & here
                one = one & self.rows(i + 1, at[:, i]) | zero
            else:
                one = (one & self.rows(i - 1, at[:, i]) if i else one) | zero
                zero = zero & here if i < self.length else zero
        return one & self.all


def _firsts(bits: np.ndarray) -> np.ndarray:
    """Index of the lowest bit set of each row (each has one)."""
    cell = (bits != 0).argmax(1)
    value = bits[np.arange(len(bits)), cell]
    low = value & (~value + np.uint64(1))
    return cell * 64 + np.bitwise_count(low - np.uint64(1)).astype(np.int64)


def near_words(vocabulary: DataFrame, shard_words: int = SHARD_WORDS, shard_letters: int = SHARD_LETTERS,
               query_words: int = QUERY_WORDS) -> DataFrame:
    """``word, n_near, best``: for words with near words their number and the best (struct ``n, word``).

    ``vocabulary`` holds each ``word`` once, with its count ``n``.
    """
    sized = vocabulary.select("word", "n", F.length("word").alias("len"))
    lengths = sized.groupBy("len").agg(F.count("*").alias("of"))
    around = (lengths.select(F.explode(F.expr("array(len - 1, len, len + 1)")).alias("len"), "of")
              .groupBy("len").agg(F.sum("of").alias("asks")))
    shards = lengths.join(around, "len").select(
        "len", F.expr(f"CAST(ceil(of / greatest(1, least({shard_words}, {shard_letters} div len))) AS INT)").alias("parts"),
        F.expr(f"CAST(ceil(asks / {query_words}) AS INT)").alias("copies"))
    shards = cut_lineage(shards)
    own = (sized.join(shards, "len").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
           .withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)"))).select("len", "part", "copy", "word", "n"))
    asked = (sized.select("word", F.explode(F.expr("array(len - 1, len, len + 1)")).alias("len")).join(shards, "len")
             .withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
             .withColumn("copy", F.pmod(F.xxhash64("word"), F.col("copies")).cast("int")).select(*[F.col(c).alias(c) for c in ("len", "part", "copy")], F.col("word").alias("query")))

    def meet(queries: pa.Table, shard: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if shard.num_rows and queries.num_rows:
            counts = shard.column("n").to_pylist()
            known = shard.column("word").to_pylist()
            order = sorted(range(len(known)), key=lambda i: (-counts[i], known[i]))
            index = Index([known[i] for i in order], len(known[0]))
            by_size: dict[int, list[str]] = {}
            for w in queries.column("query").to_pylist():
                by_size.setdefault(len(w), []).append(w)
            step = max(1, _BATCH_BYTES // (8 * index.cells))
            for same in by_size.values():
                for k in range(0, len(same), step):
                    found = index.near(same[k:k + step])
                    numbers = np.bitwise_count(found).sum(1, dtype=np.int64)
                    hit = np.flatnonzero(numbers)
                    if len(hit):
                        best = [order[i] for i in _firsts(found[hit]).tolist()]
                        out[0].extend(same[k + i] for i in hit.tolist())
                        out[1].extend(numbers[hit].tolist())
                        out[2].extend(counts[i] for i in best)
                        out[3].extend(known[i] for i in best)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                        ["word", "n_near", "best_n", "best"])

    by = ["len", "part", "copy"]
    met = asked.groupBy(*by).cogroup(own.groupBy(*by)).applyInArrow(meet, "word string, n_near long, best_n long, best string")
    # The largest count, then the smallest word: least of (-n, word).
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                   F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")) \
        .select("word", "n_near", F.struct((-F.col("best.less")).alias("n"), "best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following forms ends. ``forms`` holds each ``word`` with its ``form`` (null: none).

    The paths are halved in each round, and the words that have arrived leave it.
    """
    arrived = None
    going = cut_lineage(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    steps = going
    while not going.isEmpty():
        # A root without a step of its own has arrived.
        met = cut_lineage(going.join(steps.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left"))
        done = met.where("further IS NULL").select("word", "root")
        arrived = done if arrived is None else arrived.unionByName(done)
        going = met.where("further IS NOT NULL").select("word", F.col("further").alias("root"))
        steps = cut_lineage(steps.join(steps.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left")
                            .select("word", F.coalesce("further", "root").alias("root")))
    # Words without a form are their own roots.
    still = forms.where("form IS NULL").select("word", F.col("word").alias("root"))
    return still if arrived is None else still.unionByName(arrived)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 0, least_length: int = 6,
             least_count: int = 5, factor: int = 5) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    vocabulary = cut_lineage(words(docs, id_col, text_col, every, least_length).where(F.col("n") >= least_count))
    found = vocabulary.join(near_words(vocabulary), "word", "left")
    likely = F.col("best.n") >= factor * F.col("n")
    formed = cut_lineage(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                      F.when(likely, F.col("best.word")).alias("form"), F.when(likely, F.col("best.n")).alias("form_n")))
    return formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")
