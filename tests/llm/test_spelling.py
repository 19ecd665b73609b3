"""Spelling variants: against brute force, and edge cases."""

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, spelling
from tests.llm.helpers import SF, write_tables


def _near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _counts(docs, every, least=6):
    out = Counter()
    for i, text in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = crc32(f"{'' if i is None else i}:{r}".encode())
            r = r if not every or h % every else r[:h % len(r)] + r[h % len(r) + 1:]
            if len(r) >= least:
                out[r] += 1
    return out


def _expected(docs, every, least_count=5):
    v = {w: n for w, n in _counts(docs, every).items() if n >= least_count}
    near = {w: [x for x in v if abs(len(x) - len(w)) < 2 and _near(w, x)] for w in v}
    form = {}
    for w in v:
        if near[w]:
            best = min(near[w], key=lambda x: (-v[x], x))
            if v[best] >= 5 * v[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), v[w], len(near[w]), v.get(form.get(w))) for w in v), key=str)


def _got(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = _expected(docs, 199)
    assert len(want) > 500 and sum(w[1] is not None for w in want) > 10
    assert _got(queries.op13_spelling_variants(spark, SF)) == want


CHAIN = " ".join(["Abcdefg"] * 400 + ["abcdefgh"] * 75 + ["xabcdefgh"] * 14 + ["xabcdefghü"] * 13 + ["abcdxfg"] * 5 + ["zbcdefg"] * 400
                 + ["Écoleéà"] * 30 + ["écoleéà"] * 6 + ["short"] * 50 + ["a" * 300] * 5 + ["a" * 299] * 30)
EDGES = [(1, CHAIN), (2, None), (3, ""), (None, "abcdefg " * 3), (4, "123 你好"), (4, "123 你好"), (5, "abcdefgi " * 5),
         (5, "abcdefgi " * 5), (-6, "x" * 200_000)]


def _edges(spark):
    return spark.createDataFrame([("w", i, t, 9, 1) for i, t in EDGES], "word string, doc_id long, text string, n long, len int")


@pytest.mark.parametrize("every", [0, 1, 3])
def test_edge_cases(spark, every):
    got = _got(spelling.variants(_edges(spark), every=every))
    assert got == _expected(EDGES, every)
    if not every:
        chain = {w: (form, root) for w, form, root, *_ in got}
        assert chain["abcdefgh"] == ("abcdefg", "abcdefg") and chain["xabcdefgh"] == ("abcdefgh", "abcdefg")
        assert chain["abcdxfg"][0] == "abcdefg"


def test_small_shards_and_copies_give_the_same(spark):
    vocabulary = spelling.words(_edges(spark).unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select(F.lit("").alias("word"), "doc_id", "text", F.lit(0).cast("long").alias("n"), F.lit(0).alias("len"))
    )).where("n >= 5").persist()

    def found(**cut):
        return sorted((r.word, r.n_near, r.best.n, r.best.word) for r in spelling.near_words(vocabulary, **cut).collect())

    assert len(found()) > 50
    assert found() == found(shard_words=70, query_words=300) == found(shard_letters=640)


def test_bitsets_equal_the_definition():
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abé"), n)) for n in rng.integers(5, 8, 400)})
    for m in (5, 6, 7):
        shard = [w for w in words if len(w) == m]
        index = spelling.Index(shard, m)
        for n in (m - 1, m, m + 1):
            asked = [w for w in words if len(w) == n]
            if not asked:
                continue
            bits = index.near(asked)
            for q, row in zip(asked, bits):
                got = {shard[i] for i in range(len(shard)) if int(row[i // 64]) >> (i % 64) & 1}
                assert got == {w for w in shard if _near(q, w)}


def test_a_long_path_of_forms(spark):
    words = [f"w{i}" for i in range(40)]
    forms = spark.createDataFrame([(w, words[i + 1] if i < 39 else None) for i, w in enumerate(words)] + [("alone", None)],
                                  "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {**dict.fromkeys(words, "w39"), "alone": "alone"}


def test_no_words(spark, tmp_path):
    assert queries.op13_spelling_variants(spark, write_tables(spark, tmp_path, {})).count() == 0
    assert spelling.variants(_edges(spark).where("doc_id = 2")).count() == 0
