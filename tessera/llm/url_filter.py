"""URL filters: host rules, and naive Bayes over segmented host and path tokens.

A rule ``host/path`` fits its host and all subdomains where the URL's path
starts with the rule's path; the longest rule wins. Other URLs are judged by a
multinomial naive Bayes model. Its tokens: host and path are cut at anything
but letters (of any script) and digits; names are split into words by a unigram Viterbi (the
most probable segmentation under word counts of all pages; unknown stretches
pay by length); digits count as one token by length. Host and path tokens are
told apart. The model is fitted on all pages, labelled by short lists of known
words (a page whose host has a name made of words to be blocked counts as
block, any other as allow), and on these lists themselves. URLs that a caller has labelled are counted as well, with a weight.
The rules are policy and teach the model nothing.

Counts, segmentation and scores are joined, none is collected: names are
reduced to distinct ones, each distinct name's substrings meet the word counts
in an equality join, and pages meet their score by the signature of their
names. So a frequent host is segmented and scored once.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no rule, and is judged by the model's prior; repeated rows are judged alike,
one result each; where no page is labelled block only the lists teach that class; an
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.blocks import column_bytes
from tessera.session import cut_lineage

#: Longest word that the segmentation considers, in code points.
LONGEST_WORD = 20
#: Weight of a seed name, in pages, and Laplace smoothing.
SEED_WEIGHT = 1.0
#: Share of all words that a seed has at least in the segmentation.
SEED_SHARE = 1e-4
SMOOTHING = 0.1
#: Names that are known to serve the purposes to be blocked, or not.
SEEDS = {
    "block": ("adult ads bet bets betting bonus casino cheap dating escort farm free gambling jackpot loan lottery "
              "nude pharmacy pills poker porn sex slots spam track tracker tracking viagra win x xxx").split(),
    "allow": ("academy archive article book college docs education encyclopedia forum gov guide health help history "
              "journal learn library magazine museum music news paper press research school science support "
              "teach university weather wiki").split(),
}

#: Pages that one labelled URL counts as.
LABEL_WEIGHT = 10.0

_OPENING = re.compile(r"<(?:(script|style)\b|!--)?", re.I)
_CLOSING = {"script": re.compile("</script>", re.I), "style": re.compile("</style>", re.I)}
_ENTITY = re.compile(r"&\w+;")
_WORD = re.compile(r"[^\W\d_]+")


def visible(html: str) -> str:
    """The text outside tags, comments, scripts and styles. One pass: an end that is missing is looked for once."""
    out, at, absent = [], 0, set()
    while (start := html.find("<", at)) >= 0:
        out.append(html[at:start])
        m = _OPENING.match(html, start)
        kind = (m[1] or m[0][1:]).lower()  # script, style, !-- or nothing
        end = -1
        if kind and kind not in absent:
            if kind == "!--":
                end = html.find("-->", m.end())
                end += 3 if end >= 0 else 0
            elif closing := _CLOSING[kind].search(html, m.end()):
                end = closing.end()
            if end < 0:
                absent.add(kind)
        if end < 0:  # an ordinary tag, or what begins as more and never ends
            end = html.find(">", start) + 1
            if not end:
                at = start
                break
        out.append(" ")
        at = end
    return _ENTITY.sub(" ", "".join([*out, html[at:]]))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL."""
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls. ``rules``: (verdict, ``host/path``), a short list."""
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        h, p = r.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, r).otherwise(F.lit(None).cast("string") if rule is None else rule)
        verdict = F.when(fits, v).otherwise(F.lit(None).cast("string") if verdict is None else verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``word, n`` over the visible words of all pages, counted per batch before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: Counter = Counter()
            for html in column_bytes(b.column(0)):
                counts.update(_WORD.findall(visible(html.decode("utf-8", "replace")).lower()))
            yield pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    rows = pages.select(html_col).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def segment(name: str, known: dict[str, float], unknown: float) -> list[str]:
    """The most probable split of ``name``; a stretch of k unknown characters costs ``unknown - k ln 10``."""
    best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            p = best[start] + known.get(name[start:end], unknown - (end - start) * math.log(10))
            if p > best[end]:
                best[end], back[end] = p, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def segment_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` for distinct ``name``: substrings meet the counts in a join, then one Viterbi per name."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    pieces = (names.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("at"))
              .select("name", "at", F.explode(F.expr(f"sequence(1, least({LONGEST_WORD}, length(name) - at + 1))")).alias("k"))
              .select("name", F.expr("substr(name, at, k)").alias("word")).distinct())
    seeds = names.sparkSession.createDataFrame([(w, max(1, int(total * SEED_SHARE))) for v in SEEDS.values() for w in v if len(w) > 1], "word string, n long")
    counts = counts.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))
    found = pieces.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("found"))
    unknown = -math.log(total)

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([segment(n, {x["word"]: math.log(x["n"] / total) for x in (f if f is not None else [])}, unknown)
                          for n, f in zip(name, found, strict=True)])

    return names.join(found, "name", "left").select("name", split("name", "found").alias("words"))


def _names(host: Column, path: Column) -> Column:
    """Marked names of a URL, in order: ``h`` or ``p``, then a run of letters, or ``#`` and how many digits."""
    def marked(mark: str, x: Column) -> Column:
        runs = F.regexp_extract_all(F.lower(x), F.lit(r"[0-9]+|[\p{L}\p{M}]+"), F.lit(0))
        length = lambda n: F.concat(F.lit("#"), F.length(n).cast("string"))
        return F.transform(runs, lambda n: F.concat(F.lit(mark), F.when(n.rlike("^[0-9]"), length(n)).otherwise(n)))

    return F.concat(marked("h", host), marked("p", path))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", labelled: DataFrame | None = None) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, and the model's ``log_odds`` of allow.

    ``labelled``: URLs of known verdict (columns ``url`` and ``label``, allow or block) that the model learns from too.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select("id", host.alias("host"), path.alias("path"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    urls = cut_lineage(urls.select("id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                                   _names(F.col("host"), F.col("path")).alias("names")))
    # Distinct signatures (lists of names) and their pages.
    known = "names array<string>, allow double, block double"
    if labelled is None:
        taught = spark.createDataFrame([], known)
    else:
        h, p = split_url(F.col("url"))
        taught = labelled.select("label", h.alias("host"), p.alias("path")).select(
            _names(F.col("host"), F.col("path")).alias("names"), *[
                F.when(F.col("label") == v, LABEL_WEIGHT).otherwise(0.0).alias(v) for v in ("allow", "block")]).groupBy("names").agg(
                F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    taught = cut_lineage(taught)
    signatures = cut_lineage(urls.select("names", F.lit(1).alias("n")).unionByName(taught.select("names", F.lit(0).alias("n")))
                             .groupBy("names").agg(F.sum("n").alias("pages")))
    by_name = signatures.select("names", "pages", F.explode("names").alias("name"))
    names = by_name.select(F.expr("substr(name, 2)").alias("name")).where(~F.col("name").startswith("#")).distinct()
    split = cut_lineage(segment_names(names, cut_lineage(word_counts(pages, html_col))))
    marked = by_name.select("name").distinct().withColumn("bare", F.expr("substr(name, 2)"))
    tokens = cut_lineage(
        marked.join(split.withColumnRenamed("name", "bare"), "bare", "left")
        .select("name", F.explode(F.transform(F.coalesce("words", F.array("bare")), lambda w: F.concat(F.substring("name", 1, 1), w))).alias("token")))

    # A page is labelled block where a name of its host consists of known words to be blocked, else allow.
    bad = (tokens.where(F.col("name").startswith("h")).groupBy("name")
           .agg(F.min(F.expr("substr(token, 2)").isin(SEEDS["block"])).alias("all"), F.max(F.length("token")).alias("longest"))
           .where("all AND longest > 3").select("name"))
    judged = cut_lineage(signatures.join(by_name.join(bad, "name").select("names").distinct().withColumn("bad", F.lit(True)), "names", "left")
                           .select("names", F.when(F.col("bad"), 0).otherwise(F.col("pages")).alias("allow"),
                                   F.when(F.col("bad"), F.col("pages")).otherwise(0).alias("block")))
    seeds = spark.createDataFrame(
        [(m + w, SEED_WEIGHT * (v == "allow"), SEED_WEIGHT * (v == "block")) for v, ws in SEEDS.items() for w in ws for m in "hp"],
        "token string, allow double, block double")
    per_name = (judged.unionByName(taught).select("allow", "block", F.explode("names").alias("name")).groupBy("name")
                .agg(F.sum("allow").cast("double").alias("allow"), F.sum("block").cast("double").alias("block")))
    counted = (tokens.join(per_name, "name").select("token", "allow", "block").unionByName(seeds)
               .groupBy("token").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
    counted = cut_lineage(counted)
    a, b, v = counted.agg(F.sum("allow"), F.sum("block"), F.count("*")).first()
    weights = counted.select("token", (F.log((F.col("allow") + SMOOTHING) / (a + SMOOTHING * v))
                                       - F.log((F.col("block") + SMOOTHING) / (b + SMOOTHING * v))).alias("weight"))
    pages_allowed, pages_blocked = judged.unionByName(taught).agg(F.sum("allow"), F.sum("block")).first()
    prior = math.log(((pages_allowed or 0) + 1) / ((pages_blocked or 0) + 1))
    name_score = tokens.join(weights, "token").groupBy("name").agg(F.sum("weight").alias("weight"))
    score = (by_name.select("names", "name").join(name_score, "name")
             .groupBy("names").agg(F.sum(F.col("weight").cast("decimal(38,12)")).cast("double").alias("score")))
    return (urls.join(score, "names", "left")
            .withColumn("log_odds", F.coalesce("score", F.lit(0.0)) + F.lit(prior))
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("log_odds") >= 0, "allow").otherwise("block")).alias("verdict"), "log_odds"))
