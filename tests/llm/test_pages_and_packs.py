"""URL filters, WARC archives, packing and the pipeline."""

import hashlib
import io
import random
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.llm import packing, queries, url_filter, warc_zip
from tests.llm.helpers import SF, write_tables


# --- URL filters -------------------------------------------------------------

def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return low, rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]


def _rule(host, path, rules):
    fits = [(len(r), r, v) for v, r in rules
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "x.com", None, "", "http://", "ftp://net/es/1", "http://a.net/fr", "http://a.net/fr/",
        "http://notcom/", "http://com", "http://com/", "http://com?x=/", "a://b://c.com/", "http://É.com/É#/", "http://h.org/\nx", "http://casino-win.xyz/bonus",
        "http://wiki.school.org/library/history", "http://" + "a" * 500 + ".org/" + "b" * 3000, "http://www.example.com/en/", "http://u:p@c.net:80/es/"]


def test_hosts_paths_and_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "<p>casino win wiki</p>") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge(pages.withColumn("names", F.lit(1)), queries.URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = _host_path(u)
        rule, verdict = _rule(host, path, queries.URL_RULES)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == (verdict or ("allow" if got[i]["log_odds"] >= 0 else "block"))
    assert got[16]["verdict"] == "block" and got[17]["verdict"] == "allow"


def test_segmentation_against_exhaustive_search():
    import math
    from itertools import product
    known = {w: math.log(n / 100) for w, n in {"free": 9, "bets": 7, "be": 20, "ts": 5, "fr": 3, "ee": 2, "e": 11}.items()}
    unknown = -math.log(100)
    for name in ("freebets", "betsfree", "xfree", "eee", "q", "frbe"):
        best = None
        for cuts in product([0, 1], repeat=len(name) - 1):
            words, start = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    words.append(name[start:i])
                    start = i
            words.append(name[start:])
            p = sum(known.get(w, unknown - len(w) * math.log(10)) for w in words)
            best = max(best or (-1e9, None), (p, words), key=lambda x: x[0])
        got = url_filter.segment(name, known, unknown)
        assert sum(known.get(w, unknown - len(w) * math.log(10)) for w in got) == pytest.approx(best[0])
    assert url_filter.segment("", known, unknown) == []


def test_visible_text_equals_the_definition(spark):
    import re
    plain = re.compile(r"<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&\w+;", re.S | re.I)
    pages = [r["html"] or "" for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
    pages += ["", "plain", "a<b>c</b>&amp;d", "<!-- x > y -->z", "<script>a<b</script>c", "<SCRIPT src=x>1</SCRIPT >2</script>3", "a < b > c",
              "<style>p{}</style><p", "x <!-- no end > y", "<script> no end </scrip> t", "<scripted>q</scripted>", "a<", "<>", "é<b>ü</b>"]
    for html in pages:
        assert url_filter.visible(html).split() == plain.sub(" ", html).split(), html


@pytest.mark.parametrize("piece", ["<!--", "<script>", "<style ", "<", "<a", "&", "&a", "<!-- > ", "<script></style>", "<!--></script"])
def test_long_broken_pages_take_linear_time(piece):
    began = time.monotonic()
    url_filter.visible(piece * (2_000_000 // len(piece)))
    assert time.monotonic() - began < 10


def _plain_bayes(pages, labelled):
    """The model by its definition, in memory: word counts, segmentation, token counts, log odds."""
    import math
    import re
    from collections import Counter
    counts = Counter(w for _, _, html in pages for w in re.findall(r"[^\W\d_]+", url_filter.visible(html or "").lower()))
    total = float(sum(counts.values()) or 1)
    for w in (w for ws in url_filter.SEEDS.values() for w in ws if len(w) > 1):
        counts[w] += max(1, int(total * url_filter.SEED_SHARE))
    known = {w: math.log(n / total) for w, n in counts.items()}

    def tokens(url):
        out = []
        for mark, part in zip("hp", _host_path(url), strict=True):
            for run in re.findall(r"[0-9]+|[^\W\d_]+", part.lower()):
                if run[0] in "0123456789":
                    out.append([f"{mark}#{len(run)}"])
                else:
                    out.append([mark + w for w in url_filter.segment(run, known, -math.log(total))])
        return out

    bad = set(url_filter.SEEDS["block"])
    allow, block = Counter(), Counter()
    for v, ws in url_filter.SEEDS.items():
        for w in ws:
            for m in "hp":
                (allow if v == "allow" else block)[m + w] += url_filter.SEED_WEIGHT
    n_allow = n_block = 0.0
    for url, label, weight in [(u, None, 1) for _, u, _ in pages] + [(u, v, url_filter.LABEL_WEIGHT) for u, v in labelled]:
        names = tokens(url)
        is_bad = label == "block" if label else any(
            n[0][0] == "h" and all(t[1:] in bad for t in n) and max(len(t) for t in n) > 3 for n in names)
        n_allow, n_block = n_allow + weight * (not is_bad), n_block + weight * is_bad
        for t in (t for n in names for t in n):
            (block if is_bad else allow)[t] += weight
    vocabulary = allow.keys() | block.keys()
    a, b, v = sum(allow.values()), sum(block.values()), len(vocabulary)
    k = url_filter.SMOOTHING
    weight = {t: math.log((allow[t] + k) / (a + k * v)) - math.log((block[t] + k) / (b + k * v)) for t in vocabulary}
    prior = math.log((n_allow + 1) / (n_block + 1))
    return [prior + sum(weight[t] for n in tokens(u) for t in n) for _, u, _ in pages]


@pytest.mark.parametrize("taught", [False, True])
def test_naive_bayes_against_a_plain_version(spark, taught):
    urls = ["http://casinowin.com/freebonus", "http://cityschool.org/history/2024", "http://wiki.org/wiki/wiki", "http://bestnews.net/bets/99",
            "http://новости.рф/город/дом", "http://münchen.de/straße", "http://grüneküche.de/rezepte", "http://x.org", None, "nothing",
            "http://casinowin.com/freebonus", "http://kitchenrecipes.net/city/casino"]
    html = "<p>casino win free bonus city school history best news bets kitchen recipes grüne küche новости город</p>" + "<script>x</script>city "
    pages = [(i, u, html if i % 3 else None) for i, u in enumerate(urls)]
    labelled = [("http://kitchenrecipes.net/a", "block"), ("http://bestnews.net/b", "allow"), ("http://kitchenrecipes.net/a", "block")] if taught else []
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("label", F.lit(3))
    given = spark.createDataFrame(labelled, "url string, label string") if taught else None
    got = {r["page_id"]: r for r in url_filter.judge(df, queries.URL_RULES, labelled=given).collect()}
    for i, want in enumerate(_plain_bayes(pages, labelled)):
        assert got[i]["log_odds"] == pytest.approx(want, abs=1e-6), urls[i]
    if taught:  # a label teaches what the lists of words cannot
        assert got[11]["log_odds"] < 0


def test_names_of_any_script_are_words(spark):
    names = spark.createDataFrame([("http://Новости.РФ/Город1/straße",)], "url string").select(
        url_filter._names(*url_filter.split_url(F.col("url"))).alias("n")).first()["n"]
    assert names == ["hновости", "hрф", "pгород", "p#1", "pstraße"]


def test_url_model_blocks_known_bad_hosts_only(spark):
    got = queries.op2_url_filter(spark, "/root/testdata/sf0.01").where("rule IS NULL").collect()
    bad = [r for r in got if any(x in r["host"] for x in ("casino", "adult-x", "cheap-pills", "spam-farm", "free-bets"))]
    assert all(r["verdict"] == "block" for r in bad)
    clean = [r for r in got if r not in bad]
    assert sum(r["verdict"] == "allow" for r in clean) >= 0.95 * len(clean)


# --- WARC --------------------------------------------------------------------

def test_round_trip_of_odd_pages(spark, monkeypatch):
    big = "x" * 200
    rows = [(5, "http://a/é?q=1%20\r\nWARC-Type: revisit", big), (3, "http://b", big), (3, "http://b2", big), (9, None, None), (10, "u", ""),
            (11, "u", "small"), (12, "u", "small"), (None, "u", big), (None, "u", "only nulls " * 20), (13, "u", "é\r\n\r\nWARC/1.1\r\n" * 30), (14, "u", big + "y")]
    monkeypatch.setattr(warc_zip, "ARCHIVE_BYTES", 600)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(2)
    records = warc_zip.round_trip(pages)
    got = sorted((tuple(r) for r in warc_zip.digests(records).collect()), key=str)
    first = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = first.get(h) if first.get(h) != i else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert got == sorted(want, key=str)
    stored = {r["page_id"]: bytes(r["payload"]).decode() for r in records.where("record_type = 'response' AND page_id > 9").collect()}
    assert stored == {i: h for i, _, h in rows if (i or 0) > 9}


def test_archives_are_ordinary_zip_files(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    made = warc_zip.write_archives(pages, str(tmp_path)).collect()
    assert sum(r["records"] for r in made) == pages.count()
    with zipfile.ZipFile(made[0]["path"]) as z:
        assert z.testzip() is None and {i.filename for i in z.infolist()} == {warc_zip.DATA, warc_zip.INDEX}
        import gzip
        warc, http, payload = warc_zip.parse_record(gzip.decompress(z.read(warc_zip.DATA)).split(b"\r\n\r\nWARC/1.1")[0] + b"\r\n\r\n")
        assert warc["warc-type"] == "response" and int(http["content-length"]) == len(payload)


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05 inside"])
def test_directories_with_zip64_comments_and_other_members(zip64, comment, monkeypatch):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("skipped.txt", b"deflated " * 50, compress_type=zipfile.ZIP_DEFLATED)
        z.writestr("archive/data.warc.gz", b"0123456789" * 20)
        z.writestr("ünïcode", b"last member")
        z.comment = comment
    data, reads = out.getvalue(), []

    def read_at(n, at):
        reads.append(n)
        return data[at:at + n]

    found = warc_zip.stored_members(read_at, len(data))
    assert {k: data[a:a + n] for k, (a, n) in found.items()} == {"archive/data.warc.gz": b"0123456789" * 20, "ünïcode": b"last member"}
    with pytest.raises(ValueError):
        warc_zip.stored_members(lambda n, at: b"x" * n, 100)


# --- packing -----------------------------------------------------------------

def _check_packing(rows, longest):
    bins = {}
    for r in rows:
        if r["bin"] is not None:
            bins.setdefault((r["pack"], r["bin"]), []).append(r)
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        length, used = members[0]["bin_length"], members[0]["bin_used"]
        assert at == used <= length and length == min(c for c in packing.LENGTHS if c >= used)
    return bins


def test_packing_places_every_token_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "null id"), (-3, "y" * 40000), (-3, "y" * 40000), (-4, "z" * 16384)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd).withColumn("bin", F.lit(0)).withColumn("n", F.lit(0))
    rows = packing.pack(both, pack_pieces=300).collect()
    bins = _check_packing(rows, max(packing.LENGTHS))
    want = {}
    for i, t in [(r["doc_id"], r["text"]) for r in both.collect()]:
        want.setdefault(i, []).append(len((t or "").encode()))
    got = {}
    for r in sorted(rows, key=lambda r: (r["copy"], r["piece"])):
        parts = got.setdefault(r["doc_id"], {}).setdefault(r["copy"], [])
        assert r["start"] == sum(parts)
        parts.append(r["length"])
    assert {i: sorted(map(sum, c.values())) for i, c in got.items()} == {i: sorted(v) for i, v in want.items()}
    assert all((r["bin"] is None) == (r["length"] == 0) for r in rows)
    used, room = (sum(m[0][k] for m in bins.values()) for k in ("bin_used", "bin_length"))
    assert used >= 0.97 * room
    assert len({r["pack"] for r in rows}) > 2


def test_joint_sizes_cost_less_than_any_single_size():
    rng = random.Random(5)
    lengths = sorted((min(16384, int(rng.lognormvariate(7.2, 1.1)) + 1) for _ in range(4000)), reverse=True)
    total = lambda sizes: sum(packing.cost(n) for n in packing.best_fit(lengths, sizes)[3])
    assert total(packing.LENGTHS) < total((16384,))
    bins, offset, used, final = packing.best_fit(lengths)
    assert sum(used) == sum(lengths) and all(u <= f for u, f in zip(used, final, strict=True))
    assert packing.best_fit([]) == ([], [], [], [])


def test_many_copies_of_one_row_are_dealt_out(spark):
    df = spark.range(25_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    rows = packing.pack(df)
    assert rows.count() == 25_000 and rows.select("copy").distinct().count() == 25_000
    assert rows.groupBy("pack").count().agg(F.max("count")).first()[0] < 5000


def test_large_and_text_ids_beside_nulls(spark):
    big = 1 << 53
    ids = [big + 1, None, big + 3, -big - 1, big + 1]
    df = spark.createDataFrame([(i, "t" * (n + 1)) for n, i in enumerate(ids)], "doc_id long, text string")
    got = packing.pack(df).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in got) == sorted((str(i), n + 1) for n, i in enumerate(ids))
    words = df.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text")
    assert sorted(str(r["doc_id"]) for r in packing.pack(words).collect()) == sorted(map(str, ids))


def _plain_best_fit(lengths, permitted, quadratic_at):
    """The method stated as simply as it can be: every bin and every permitted length is looked at for each piece."""
    bins, out = [], []
    for i, n in enumerate(lengths):
        fitting = [(b["room"] - b["used"], -b["put"], k) for k, b in enumerate(bins) if b["room"] - b["used"] >= n]
        if not fitting:
            def per_token(c):
                filled, room = n, c - n
                for m in sorted(lengths[i + 1:], reverse=True):
                    if m <= room:
                        filled, room = filled + m, room - m
                return c * (1 + c / quadratic_at) / filled
            bins.append({"room": min((c for c in permitted if c >= n), key=lambda c: (per_token(c), c)), "used": 0, "put": -1})
            k = len(bins) - 1
        else:
            k = min(fitting)[2]  # the tightest; of equal ones that which was filled last
        out.append((k, bins[k]["used"]))
        bins[k]["used"] += n
        bins[k]["put"] = i
    return out, [b["used"] for b in bins], [min(c for c in permitted if c >= b["used"]) for b in bins]


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_against_a_plain_version(seed):
    rng = random.Random(seed)
    permitted = sorted(rng.sample([4, 8, 12, 16, 24, 32], 3))
    lengths = sorted((rng.randint(1, permitted[-1]) for _ in range(rng.randint(1, 120))), reverse=True)
    places, used, final = _plain_best_fit(lengths, permitted, 16)
    got = packing.best_fit(lengths, permitted, 16)
    assert (list(zip(got[0], got[1])), got[2], got[3]) == (places, used, final)


# --- pipeline ----------------------------------------------------------------

def test_pipeline_stages_against_their_operators(spark, tmp_path):
    import corpus_pipeline as p

    from tessera.llm import decontaminate, quality_rules
    from tests.llm.test_native import _brute
    from tests.llm.test_texts import _counts, _fingerprint, _groups
    root = "/root/testdata/sf0.01"
    assert [n for n, _ in p.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
    docs = spark.read.parquet(f"{root}/documents.parquet")
    steps = [docs]
    for i, (_, stage) in enumerate(p.STAGES[:-1]):
        stage(spark, steps[-1], root).write.parquet(str(tmp_path / str(i)))
        steps.append(spark.read.parquet(str(tmp_path / str(i))))
        assert steps[-1].columns == docs.columns
    rows = [{r["doc_id"]: r for r in s.collect()} for s in steps]
    model = quality_rules.train(docs, spark.read.parquet(f"{root}/labels.parquet"))
    kept = {r["doc_id"] for r in quality_rules.quality_rules(docs, model).where("kept").collect()}
    assert set(rows[1]) == kept and all(not _counts(rows[0][i]["text"])[5] for i in kept)
    ids = sorted(rows[1])
    assert set(rows[2]) == {c for _, c in _groups(ids, [_fingerprint(rows[1][i]["text"]) for i in ids])}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    clean = {x[0] for x in _brute([(i, r["text"]) for i, r in rows[2].items()], items) if not x[2]}
    assert set(rows[3]) == clean and decontaminate.WINDOW == 10
    assert set(rows[4]) == set(rows[3])
    changed = {i for i in rows[4] if rows[4][i]["text"] != rows[3][i]["text"]}
    assert changed == {i for i, r in rows[3].items() if "oken = \"" in r["text"] or "OKEN = \"" in r["text"]}
    assert all("[SECRET]" in rows[4][i]["text"] and rows[4][i]["n_chars"] == len(rows[4][i]["text"]) for i in changed)
    packed = p.STAGES[-1][1](spark, steps[4], root).collect()
    _check_packing(packed, max(packing.LENGTHS))
    assert sum(r["length"] for r in packed) == sum(len(r["text"].encode()) for r in rows[4].values())
    assert sorted(map(tuple, p.run(spark, root).collect()), key=str) == sorted(map(tuple, packed), key=str)


def test_pipeline_with_extra_columns_nulls_and_nothing(spark, tmp_path):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("id", F.lit("x")).withColumn("row", F.lit(1)).withColumn("kept", F.lit(None).cast("int"))
    nulls = docs.limit(3).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    for i, given in enumerate((docs.unionByName(nulls).unionByName(docs.limit(5)), docs.limit(0))):
        for k, (_, stage) in enumerate(p.STAGES):
            path = str(tmp_path / f"{i}-{k}")
            stage(spark, given, SF).write.parquet(path)
            out = spark.read.parquet(path)
            if k < 4:
                assert out.columns == docs.columns
                given = out
        assert (out.count() > 0) == (i == 0)
    assert p.run(spark, write_tables(spark, tmp_path, {})).count() == 0
