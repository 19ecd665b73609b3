"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

N-grams of five characters are counted as they stand in the text, for every language and for all trusted text.
Documents lie in groups of about ``GROUP_BYTES``, dealt by id: a group meets the trusted ids of its documents and gives
its distinct n-grams with their trusted counts. N-grams are dealt into shards by their third and fourth character, which
all of an n-gram's orders above two, and what these are counted from, have in common. A shard gives its share of the
counts of bigrams and of the counts of counts; these are summed, and the bigrams' probabilities come back to the shards
that have them. Then each shard has the probabilities of its n-grams, which return to the groups, where each document's
log-probabilities are summed. All of this is one query, in which texts and n-grams are exchanged once and read twice;
both lie packed and compressed in rows of a group (texts) or of a group, language and shard (n-grams, in order, so their
probabilities return without them). The n-grams' number grows with the input; no table of them is held whole. A group
holds all rows of its ids; null ids are dealt by text. Every language has its own model and quantiles,
weighted against those of all trusted text by its number of trusted documents; there is no limit on languages and no
size at which one switches.

A document is kept if its perplexity lies within its language's quantiles of trusted text. The upper one comes from text that the
model has not seen (the lower one from what it has seen, which new text of its kind does not undercut): trusted documents are dealt into ``FOLDS`` parts by a hash of id and text, and each is scored once more by models that were
trained without its part. That is also the perplexity by which it is itself judged (``perplexity`` is that under the whole model, for
every document). N-grams have a count for each fold, and so one row for the models of all text and of the folds.

Defined results: null and empty texts have no perplexity (null) and are not
kept; a null language is one of its own; repeated rows are scored alike, one
result each; ``model`` is ``*`` where a language has no trusted document; U+0000 counts as U+FFFD,
and U+0001 in the name of a language too;
without trusted documents nothing is known and every text that is
not empty is kept, with a null perplexity; an empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.blocks import blocks, column_bytes, slices
from tessera.session import cut_lineage

#: Quantiles of the trusted documents' perplexity within which a document is kept.
LOW, HIGH = 0.002, 0.99
ALL = "*"
#: Parts of the trusted documents, each scored by models without it: the model of all, then one without each part.
FOLDS = 2
MODELS = 1 + FOLDS
#: What a language's name does not hold: it marks the models of languages beside that of all text.
MARK = "\x01"

#: Characters of an n-gram, bytes of text whose documents are scored together, and the chance of an unknown character.
CHARACTERS, GROUP_BYTES, UNSEEN = 5, 32 << 20, 2.0 ** -16
#: A language's model counts half where it has so many trusted documents, the model of all trusted text the other half.
HALF_TRUSTED = 20
#: Shards of the n-grams: this many, and one more for each four groups beyond.
SHARDS = 32
#: Orders that a shard computes by itself, and the counts of counts that discounts need.
ORDERS, COUNTS = (3, 4, 5), (1, 2, 3, 4)

# The codec of packed rows; a codec cannot be sent to tasks itself.
_codec = functools.partial(pa.Codec, "zstd", compression_level=6)
_PACKED = pa.schema([("part", pa.int64()), ("texts", pa.binary())])
_GATHERED = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])
_STATS = pa.schema([("shard", pa.int64()), ("model", pa.string()), ("g", pa.string()), ("c", pa.list_(pa.int64()))])
_KNOWN = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("lang", pa.string()), ("logs", pa.binary())])


def by_language(b: pa.RecordBatch) -> Iterator[tuple[str, list[int], list[bytes]]]:
    """Positions and texts of a batch (columns lang and text), language by language."""
    texts, at = column_bytes(b.column("text")), {}
    for i, lang in enumerate(b.column("lang").to_pylist()):
        at.setdefault(lang, []).append(i)
    for lang, rows in at.items():
        yield lang, rows, [texts[i] for i in rows]


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a part in one compressed row for each batch; repeated rows are counted (``times``)."""
    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([b]).group_by(b.schema.names, use_threads=False).aggregate([([], "count_all")])
        rows = rows.rename_columns([*b.schema.names, "times"]).sort_by("part")
        parts, first = np.unique(rows.column("part").to_numpy(), return_index=True)
        out = []
        for i, j in zip(first, [*first[1:], rows.num_rows], strict=True):
            sink = pa.BufferOutputStream()
            own = rows.slice(i, j - i).drop_columns("part")
            with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression=_codec())) as w:
                w.write_table(own.combine_chunks())
            out.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(out, pa.binary())], schema=_PACKED)


def mixed(characters: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each n-gram, as for words in blocks.py; ``characters`` has the first of all n-grams, the second, and so on."""
    out = np.zeros(len(characters[0]), np.uint64)
    for c in characters:
        out ^= c
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def character_grams(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of ``texts``, as hashes and as rows of characters; which of them ends at each character; the characters of each text."""
    decoded = [t.decode("utf-8", "replace").replace("\0", "\ufffd") for t in texts]
    pad = "\n" * (CHARACTERS - 1)
    data = np.frombuffer("".join(pad + t for t in decoded).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) for t in decoded], np.int64)
    inside = np.repeat(np.tile([False, True], len(texts)), np.stack([np.full(len(texts), len(pad)), lengths], 1).ravel())[len(pad):]
    n = max(len(data) - len(pad), 0)
    at = np.flatnonzero(inside)
    codes = pa.array(mixed([data[k:k + n] for k in range(CHARACTERS)])[at]).dictionary_encode()
    which, hashes = codes.indices.to_numpy(), codes.dictionary.to_numpy()
    found = np.empty(len(hashes), np.int64)
    found[which] = at
    return hashes, data[found[:, None] + np.arange(CHARACTERS)], which, lengths


def _fold(doc_id, text: bytes) -> int:
    """The part of the trusted documents that a document belongs to."""
    return xxhash.xxh64_intdigest(text, xxhash.xxh32_intdigest(str(doc_id))) % FOLDS


def _trusted_of(side: pa.Table) -> set:
    """Ids of trusted documents among the rows that a group of documents meets."""
    return set(side.column("id").drop_null().to_pylist())


class Block(NamedTuple):
    """Some documents of one language and fold (-1: nobody trusts them)."""

    fold: int
    ids: tuple
    times: np.ndarray
    lengths: np.ndarray
    which: np.ndarray  # of the block's n-grams, at each character
    place: np.ndarray  # of the block's n-grams among the language's


class Grams(NamedTuple):
    """Distinct n-grams of one language in a group of documents, shard by shard and in order: characters, trusted counts by fold."""

    windows: np.ndarray
    counts: np.ndarray
    bounds: np.ndarray  # of the shards
    blocks: list[Block]


def _grams(texts: pa.Table, trusted: set, n_shards: int) -> Iterator[tuple[str, Grams]]:
    """The n-grams of one group of documents, language by language. They depend on the group's rows only, in any order."""
    rows = {}
    for part in texts.column("texts").to_pylist():
        for b in slices(pa.ipc.open_stream(part).read_all().to_batches(), 2000):
            ids, times = b.column("id").to_pylist(), b.column("times").to_pylist()
            for lang, at, found in by_language(b):
                for k, t in zip(at, found, strict=True):
                    fold = _fold(ids[k], t) if t and ids[k] in trusted else -1
                    rows.setdefault(lang, {}).setdefault(fold, []).append((ids[k], times[k], t))
    for lang in list(rows):
        held = []
        for fold, own in sorted(rows.pop(lang).items()):
            ids, times, found = zip(*own, strict=True)
            for i, j in blocks(found, 2 << 20):
                held.append((fold, ids[i:j], np.array(times[i:j], np.int64), *character_grams(found[i:j])))
            del own, found
        _, first, place = np.unique(np.concatenate([h[3] for h in held]), return_index=True, return_inverse=True)
        windows = np.concatenate([h[4] for h in held])[first]
        high, low = _packed_characters(windows.T)
        shard = (mixed([windows[:, 2], windows[:, 3]]) % np.uint64(n_shards)).astype(np.int64)
        order = np.lexsort((low, high, shard))
        place = np.argsort(order)[place]
        counts, out, start = np.zeros((FOLDS, len(order)), np.int64), [], 0
        for fold, ids, times, hashes, _, which, lengths in held:
            block = Block(fold, ids, times, lengths, which, place[start:start + len(hashes)])
            start += len(hashes)
            if fold >= 0:
                counts[fold][block.place] += np.bincount(which, np.repeat(times, lengths), len(hashes)).astype(np.int64)
            out.append(block)
        yield lang, Grams(windows[order], counts, np.searchsorted(shard[order], np.arange(n_shards + 1)), out)


def _packed_characters(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams as two numbers, of three and two characters (21 bits each)."""
    a, b, c, d, e = windows.astype(np.int64)
    return a << 42 | b << 21 | c, d << 21 | e


def _gathered(texts: pa.Table, side: pa.Table, n_shards: int) -> pa.Table:
    """The n-grams of one group of documents, by language and shard, and how often each fold of trusted text has them."""
    out = []
    for lang, grams in _grams(texts, _trusted_of(side), n_shards):
        part = texts.column("part")[0].as_py()
        for shard in np.flatnonzero(np.diff(grams.bounds)).tolist():
            i, j = grams.bounds[shard:shard + 2]
            out.append((shard, part, lang, j - i, _codec().compress(grams.windows[i:j].T.tobytes(), asbytes=True),
                        _codec().compress(grams.counts[:, i:j].tobytes(), asbytes=True)))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _GATHERED.types, strict=True)] if out else
                                [pa.array([], t) for t in _GATHERED.types], schema=_GATHERED)


class Merged(NamedTuple):
    """Distinct n-grams, by hash: characters (one row for each place) and trusted counts by fold."""

    hashes: np.ndarray
    windows: np.ndarray
    counts: np.ndarray


def _merge(some: list[Merged]) -> Merged:
    hashes, first, which = np.unique(np.concatenate([m.hashes for m in some]), return_index=True, return_inverse=True)
    counts = np.concatenate([m.counts for m in some], 1)
    return Merged(hashes, np.concatenate([m.windows for m in some], 1)[:, first],
                  np.stack([np.bincount(which, c, len(hashes)).astype(np.int64) for c in counts]))


def _unpacked(grams: pa.Table) -> Iterator[tuple[int, str, Merged]]:
    """Part, language and n-grams of each row of a shard."""
    for b in slices(grams.to_batches(), 100):
        for part, lang, n, windows, counts in zip(*(b.column(c).to_pylist() for c in ("part", "lang", "n", "grams", "counts")), strict=True):
            w = np.frombuffer(_codec().decompress(windows, 4 * CHARACTERS * n, asbytes=True), np.uint32).reshape(CHARACTERS, n)
            c = np.frombuffer(_codec().decompress(counts, 8 * FOLDS * n, asbytes=True), np.int64).reshape(FOLDS, n)
            yield part, lang, Merged(mixed(list(w)), w, c)


def _of_shard(grams: pa.Table) -> dict[str, Merged]:
    """The n-grams of a shard for each language's model, and for that of all (ALL); a few groups are merged at a time."""
    held, sizes = {}, {}
    for _, lang, m in _unpacked(grams):
        held.setdefault(lang, []).append(m)
        sizes[lang] = sizes.get(lang, 0) + len(m.hashes)
        if sizes[lang] > (1 << 20) + 2 * len(held[lang][0].hashes):
            held[lang] = [_merge(held[lang])]
            sizes[lang] = len(held[lang][0].hashes)
    merged = {MARK + lang: _merge(some) for lang, some in held.items()}
    return merged | {ALL: _merge(list(merged.values()))}


class Level(NamedTuple):
    """One order: of each distinct n-gram its count under each model, its context, and the n-gram one shorter that it ends in."""

    counts: np.ndarray
    context: np.ndarray
    ends: np.ndarray


def _levels(m: Merged) -> tuple[list[Level], np.ndarray]:
    """Orders three to five of a shard's n-grams, and the bigrams (as numbers) in which they end.

    Below the longest order, counts are continuation counts: how many n-grams one longer end in it.
    """
    a, b, c, d, e = m.windows.astype(np.int64)
    three, three_of = np.unique(c << 42 | d << 21 | e, return_inverse=True)
    four, first, four_of = np.unique(b * len(three) + three_of, return_index=True, return_inverse=True)
    three_of = three_of[first]
    two, two_of = np.unique(three & (1 << 42) - 1, return_inverse=True)
    _, before3 = np.unique(three >> 21, return_inverse=True)
    _, before4 = np.unique(b[first] * len(three) + before3[three_of], return_inverse=True)
    _, before5 = np.unique(a * len(four) + before4[four_of], return_inverse=True)
    whole = m.counts.sum(0)
    c5 = np.stack([whole, *(whole - m.counts)])
    c4 = _continued(c5, four_of, len(four))
    c3 = _continued(c4, three_of, len(three))
    return [Level(c3, before3, two_of), Level(c4, before4, three_of), Level(c5, before5, four_of)], two


def _continued(counts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(ends[c > 0], minlength=n) for c in counts])


def _strings(two: np.ndarray) -> list[str]:
    return np.ascontiguousarray(np.stack([two >> 21, two & (1 << 21) - 1], 1).astype(np.uint32)).view("<U2").ravel().tolist()


def _shard_counts(grams: pa.Table) -> pa.Table:
    """A shard's share of what spans shards: for each model name, bigrams with their counts by model, and (bigram '') the counts of counts of its orders."""
    shard, out = grams.column("shard")[0].as_py(), []
    for name, m in _of_shard(grams).items():
        levels, two = _levels(m)
        out.append((shard, name, "", [int((level.counts[k] == c).sum()) for k in range(MODELS) for level in levels for c in COUNTS]))
        counts = _continued(levels[0].counts, levels[0].ends, len(two)).T.tolist()
        out += [(shard, name, g, c) for g, c in zip(_strings(two), counts, strict=True)]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _STATS.types, strict=True)], schema=_STATS)


def _shard_logs(grams: pa.Table, side: pa.Table) -> pa.Table:
    """Log-probabilities (base 2) of the n-grams of each row of a shard, in order: under the model of all text, then under those without a fold that has them.

    ``side`` has, by model name and model, the bigrams' probabilities, and (bigram '') by model and order discounts with the weight of the language's own model.
    """
    lower, rates = {}, {}
    for name, g, k, v in zip(*(side.column(c).to_pylist() for c in ("model", "g", "k", "v")), strict=True):
        (lower if g else rates).setdefault(name, {})[g, k] = v
    merged, p = _of_shard(grams), {}
    for name, m in merged.items():
        levels, two = _levels(m)
        bigrams = _strings(two)
        p[name] = np.stack([_interpolated(levels, k, np.array([lower[name][g, k][0] for g in bigrams]),
                                          [rates[name]["", k * len(ORDERS) + i][:3] for i in range(len(ORDERS))]) for k in range(MODELS)])
    logs = {}
    for name, m in merged.items():
        if name != ALL:
            own = rates[name]["", 0][-1]
            logs[name] = np.log2(own * p[name] + (1 - own) * p[ALL][:, np.searchsorted(merged[ALL].hashes, m.hashes)])
    shard, out = grams.column("shard")[0].as_py(), []
    for part, lang, m in _unpacked(grams):
        found = logs[MARK + lang][:, np.searchsorted(merged[MARK + lang].hashes, m.hashes)]
        values = np.concatenate([found[0], *(found[1 + f][m.counts[f] > 0] for f in range(FOLDS))])
        out.append((part, shard, lang, _codec().compress(values.tobytes(), asbytes=True)))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _KNOWN.types, strict=True)] if out else
                                [pa.array([], t) for t in _KNOWN.types], schema=_KNOWN)


def _interpolated(levels: list[Level], model: int, p: np.ndarray, rates: list[list[float]]) -> np.ndarray:
    """Probabilities of the n-grams of the longest order; ``p``: of the bigrams, ``rates``: discounts of counts 1, 2 and more, of each order."""
    for level, discounts in zip(levels, rates, strict=True):
        c = level.counts[model]
        d = np.array([0.0, *discounts])[np.minimum(c, 3)]
        total, spared = np.bincount(level.context, c)[level.context], np.bincount(level.context, d)[level.context]
        lower = p[level.ends]
        p = np.where(total > 0, (c - d + spared * lower) / np.maximum(total, 1), lower)
    return p


def _discounts(n: list[Column]) -> list[Column]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how many n-grams have the counts 1, 2, 3 and 4."""
    y = F.try_divide(n[0], n[0] + 2 * n[1])
    usable = (n[0] > 0) & (n[1] > 0) & (n[2] > 0)

    def d(k: int) -> Column:
        # Where counts of counts are missing (little text, or all n-grams frequent), fixed discounts.
        fitted = k - (k + 1) * y * F.try_divide(n[k], n[k - 1])
        return F.when(usable & (fitted > 0.05) & (fitted < k), fitted).otherwise(0.5 * k)

    return [d(k) for k in (1, 2, 3)]


def _bigram_probabilities(two: DataFrame) -> DataFrame:
    """Adds ``p`` to ``model, k, g, c``: distinct bigrams, those that are only asked for with a count of zero."""
    two = two.withColumns({"before": F.substring("g", 1, 1), "last": F.substring("g", 2, 1)})
    having = lambda c: [F.count_if(F.col(c) == k).alias(f"n{k}") for k in COUNTS]
    contexts = two.groupBy("model", "k", "before").agg(F.sum("c").alias("total"), F.count_if(F.col("c") >= 3).alias("more"), *having("c"))
    one = two.groupBy("model", "k", "last").agg(F.count_if(F.col("c") > 0).alias("c1"))

    def rates(rows: DataFrame, *more: Column) -> DataFrame:
        counted = rows.groupBy("model", "k").agg(*more)
        return counted.select("model", "k", *[c for c in counted.columns if c in ("total1", "more1", "seen1", "seen2")],
                              F.array(*_discounts([F.col(f"n{k}") for k in COUNTS])).alias("rates"))

    upper = rates(contexts, *[F.sum(f"n{k}").alias(f"n{k}") for k in COUNTS])
    lowest = rates(one, *having("c1"), F.sum("c1").alias("total1"), F.count_if(F.col("c1") >= 3).alias("more1"),
                   F.count_if(F.col("c1") == 1).alias("seen1"), F.count_if(F.col("c1") == 2).alias("seen2"))

    def estimate(c: Column, total: Column, seen: list[Column], d: Column, lower: Column) -> Column:
        spared = sum((seen[i] * d[i] for i in range(1, 3)), seen[0] * d[0])
        off = F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
        return F.when(total > 0, F.try_divide(c - off + spared * lower, total)).otherwise(lower)

    one = one.join(lowest, ["model", "k"]).select("model", "k", "last", estimate(
        F.col("c1"), F.col("total1"), [F.col("seen1"), F.col("seen2"), F.col("more1")], F.col("rates"), F.lit(UNSEEN)).alias("lower"))
    contexts = contexts.join(upper, ["model", "k"])
    return two.join(contexts, ["model", "k", "before"]).join(one, ["model", "k", "last"]).withColumn("p", estimate(
        F.col("c"), F.col("total"), [F.col("n1"), F.col("n2"), F.col("more")], F.col("rates"), F.col("lower")))


def _known(gathered: DataFrame, own: DataFrame) -> DataFrame:
    """``part, shard, lang, logs``: log-probabilities of the gathered n-grams; ``own`` has the weight of each language's own model."""
    shards = gathered.groupBy("shard")
    # Not nullable, and counts and shards as one value: so that all that follows reads one exchange.
    counts = (shards.applyInArrow(_shard_counts, "shard long not null, model string not null, g string not null, c array<long> not null")
              .groupBy("model", "g").agg(F.collect_list(F.struct("shard", "c")).alias("at")))
    total = F.aggregate("at", F.array_repeat(F.lit(0).cast("long"), F.size(F.col("at")[0]["c"])),
                        lambda s, x: F.zip_with(s, x["c"], lambda a, b: a + b))
    counts = counts.select("model", "g", F.transform("at", lambda x: x["shard"]).alias("shards"), total.alias("c"))
    n = MODELS * len(ORDERS)
    rates = counts.where(F.size("c") == n * len(COUNTS)).select("model", "g", "shards", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.slice("c", i * len(COUNTS) + 1, len(COUNTS)))).alias("k", "n"))
    rates = rates.join(F.broadcast(own.select(F.concat(F.lit(MARK), "lang").alias("model"), "own")), "model", "left").select(
        "model", "g", "shards", "k", F.array(*_discounts([F.col("n")[i] for i in range(len(COUNTS))]), F.coalesce("own", F.lit(0.0))).alias("v"))
    two = _bigram_probabilities(counts.where(F.size("c") == MODELS).select("model", "g", "shards", F.posexplode("c").alias("k", "c")))
    side = rates.unionByName(two.select("model", "g", "shards", "k", F.array("p").alias("v"))).select(
        F.explode("shards").alias("shard"), "model", "g", "k", "v")
    return shards.cogroup(side.groupBy("shard")).applyInArrow(_shard_logs, "part long, shard long, lang string, logs binary")


def _entropies(block: Block, logs: np.ndarray) -> np.ndarray:
    """Bits a character of each text of a block, from the log-probabilities of its language's n-grams."""
    sums = np.zeros(len(block.which) + 1)
    np.cumsum(logs[block.place][block.which], out=sums[1:])
    ends = np.cumsum(block.lengths)
    with np.errstate(invalid="ignore"):
        return (sums[ends - block.lengths] - sums[ends]) / block.lengths


_SCORED = ["id", "lang", "times", "n_symbols", "perplexity", "bits", "trusted"]


def _scored(texts: pa.Table, side: pa.Table, n_shards: int, kind: pa.DataType) -> pa.Table:
    """Each document of a group under the models, from the log-probabilities of the group's n-grams in ``side``."""
    logs, out = {}, []
    probabilities = side.filter(pc.is_valid(side.column("logs")))
    for lang, shard, values in zip(*(probabilities.column(c).to_pylist() for c in ("lang", "shard", "logs")), strict=True):
        logs[lang, shard] = values
    for lang, grams in _grams(texts, _trusted_of(side), n_shards):
        known = np.full((MODELS, len(grams.windows)), np.nan)
        for shard in np.flatnonzero(np.diff(grams.bounds)).tolist():
            asked = slice(*grams.bounds[shard:shard + 2])
            places = [np.arange(asked.start, asked.stop), *(asked.start + np.flatnonzero(c[asked] > 0) for c in grams.counts)]
            values = np.frombuffer(_codec().decompress(logs.pop((lang, shard)), 8 * sum(map(len, places)), asbytes=True))
            for k, own in enumerate(np.split(values, np.cumsum([len(x) for x in places])[:-1])):
                known[k, places[k]] = own
        for block in grams.blocks:
            entropy, trusted = _entropies(block, known[0]), block.fold >= 0
            bits = _entropies(block, known[1 + block.fold]) if trusted else entropy
            out.append(pa.table([pa.array(block.ids, kind), pa.array([lang] * len(bits), pa.string()), pa.array(block.times), pa.array(block.lengths),
                                 pa.array(2.0 ** entropy, from_pandas=True), pa.array(bits, from_pandas=True), pa.array([trusted] * len(bits))], _SCORED))
    return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (
        kind, pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())], _SCORED)


def score_documents(rows: DataFrame, ids: DataFrame, own: DataFrame, size: int) -> DataFrame:
    """``rows`` (id, lang, text) with characters, perplexity, bits a character under models that have not seen them, and whether they are trusted.

    ``ids``: the trusted ones, distinct; ``own``: the weight of each language's own model; ``size``: bytes of all texts.
    """
    n = max(1, -(-size // GROUP_BYTES))
    n_shards = SHARDS + n // 4
    # Groups by id, so that trusted ids, a narrow table, meet their documents without moving any text for it. Repeated
    # rows are counted, so that copies of one text, however many, are few in their group.
    deal = lambda key: F.pmod(key, F.lit(n))
    laid = (rows.select(deal(F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id"))).alias("part"), "id", "lang", "text")
            .mapInArrow(packed, "part long, texts binary").repartition(n, "part"))
    meeting = ids.select(deal(F.xxhash64("id")).alias("part"), "id")
    gathered = laid.groupBy("part").cogroup(meeting.groupBy("part")).applyInArrow(
        lambda texts, side: _gathered(texts, side, n_shards), "shard long, part long, lang string, n long, grams binary, counts binary").repartition(n_shards, "shard")
    kind = rows.schema["id"].dataType
    met = (_known(gathered, own).withColumn("id", F.lit(None).cast(kind))
           .unionByName(meeting.select("part", "id"), allowMissingColumns=True))
    arrow = to_arrow_type(kind)
    return (laid.groupBy("part").cogroup(met.groupBy("part")).applyInArrow(
        lambda texts, side: _scored(texts, side, n_shards, arrow),
        f"id {kind.simpleString()}, lang string, times long, n_symbols long, perplexity double, bits double, trusted boolean")
        .select("id", "lang", "n_symbols", "perplexity", "bits", "trusted", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")).drop("copy"))


def score_characters(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row per document: id, ``model`` (its language or ``*``), ``n_symbols`` (characters), ``perplexity``, ``kept``.

    ``trusted`` holds the ids of trusted documents.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.translate(F.coalesce(F.col(lang_col).cast("string"), F.lit("")), MARK, "\ufffd").alias("lang"),
                       F.col(text_col).alias("text"))
    ids = trusted.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    own = cut_lineage(rows.where("text <> ''").select("id", "lang").join(ids, "id", "left_semi").groupBy("lang").agg(
        (F.count("*") / (F.count("*") + HALF_TRUSTED)).alias("own")))  # one row a language
    if own.isEmpty():
        return rows.select(F.col("id").alias(id_col), F.lit(ALL).alias("model"),
                           F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_symbols"),
                           F.lit(None).cast("double").alias("perplexity"), (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("kept"))
    scored = cut_lineage(score_documents(rows, ids, own, size))
    # Of trusted documents: the whole model's value, and that of the model without them.
    measured = scored.where(F.col("trusted") & F.col("bits").isNotNull()).select("lang", F.log2("perplexity").alias("seen"), F.col("bits").alias("unseen"))
    quantiles = F.array(F.percentile_approx("seen", low, F.lit(10_000)), F.percentile_approx("unseen", high, F.lit(10_000)))
    weights = own.join(measured.groupBy("lang").agg(quantiles.alias("q")), "lang")
    of_all = measured.agg(quantiles.alias("a"))  # one row
    limits = cut_lineage(weights.crossJoin(F.broadcast(of_all)).select(
        "lang", *[(F.col("own") * F.col("q")[i] + (1 - F.col("own")) * F.col("a")[i]).alias(name) for i, name in enumerate(("least", "most"))]))
    bits = F.col("bits")
    return (scored.join(limits, "lang", "left").crossJoin(F.broadcast(of_all))
            .select(F.col("id").alias(id_col), F.when(F.col("least").isNull(), ALL).otherwise(F.col("lang")).alias("model"), "n_symbols", "perplexity",
                    F.coalesce(bits.between(F.coalesce("least", F.col("a")[0]), F.coalesce("most", F.col("a")[1])), F.lit(False)).alias("kept")))
