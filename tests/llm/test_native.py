"""Chat formatting and benchmark decontamination: against SQL and brute force, and edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, decontaminate, queries
from tests.llm.helpers import SF, write_tables
from tools.compare import rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, rows) == rows_of(columns, cur.fetchall())


TURNS = [
    (1, 0, "user", "a"), (1, 1, "user", "b<|more|>c"), (1, 2, "assistant", None), (1, 3, "assistant", "x\\<|end|>\\"),
    (1, 4, None, "</s>[INST] ok [/INST]"), (2, None, "assistant", "no number"), (2, 0, "user", ""), (2, 0, "user", ""),
    (None, 5, "assistant", "\U0001F600 <<|turn|>"), (3, 0, "as<|says|>sistant", "role\nwith control"), (4, 300, "assistant", "late"),
    (4, 2, "assistant", "early"), (5, 0, "assistant", "<|turn|>" * 3 + "\\\\<|says|>"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def _expected(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in out.items()}


def test_turns_and_loss_are_read_back(spark):
    df = spark.createDataFrame(TURNS, SCHEMA).withColumn("part", F.lit("clash")).withColumn("formatted", F.lit(1))
    parts = chat.format_chat(df)
    whole = {}
    for r in parts.orderBy("conv_id", "part").select(
            "conv_id", "formatted", chat.read_turns(F.col("formatted"), carried=F.col("carried")).alias("turns"),
            chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect():
        turns, loss, n = whole.get(r["conv_id"], ([], "", 0))
        whole[r["conv_id"]] = (turns + [tuple(x) for x in r["turns"]], loss + r["loss"], n + len(r["formatted"]))
        assert not re.search(r"</?s>|\[/?INST\]", r["formatted"])
    want = _expected(TURNS)
    assert whole.keys() == want.keys()
    digests = {r["conv_id"]: r for r in chat.conversation_digests(parts).collect()}
    for c, turns in want.items():
        assert whole[c][0] == turns
        loss = "".join(t for r, t in turns if r == "assistant")
        assert whole[c][1] == loss
        assert digests[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert digests[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (digests[c]["n_turns"], digests[c]["loss_chars"], digests[c]["formatted_chars"]) == (len(turns), len(loss), whole[c][2])


def test_adjacent_turns_of_a_role_form_one_block(spark):
    df = spark.createDataFrame([(1, i, "user" if i < 3 else "assistant", str(i)) for i in range(5)], SCHEMA)
    text = chat.format_chat(df).first()["formatted"]
    assert text == "<|turn|>user<|says|>0<|more|>1<|more|>2<|end|><|turn|>assistant<|says|>3<|more|>4<|end|>"


def test_long_conversation_is_formatted_in_bounded_parts(spark):
    df = spark.range(2000).selectExpr("1L AS conv_id", "id AS turn", "'assistant' AS role", "concat('t', id) AS text")
    parts = chat.format_chat(df)
    assert parts.count() == 8 and parts.agg(F.max(F.size("loss_spans"))).first()[0] == chat.PART_TURNS
    assert chat.conversation_digests(parts).first()["n_turns"] == 2000


def _plainly(turns):
    """The formatted conversation, written at once."""
    def escape(x):
        x = x.replace("\\", "\\\\")
        return re.sub(r"<(?=\|(?:turn|says|more|end)\|>|/?s>)|\[(?=/?INST\])", lambda m: m[0] + "\\", x)
    out, last = "", None
    for role, text in turns:
        out += ("<|more|>" if role == last else ("<|end|>" if last is not None else "") + f"<|turn|>{escape(role)}<|says|>") + escape(text)
        last = role
    return out + "<|end|>"


def test_blocks_do_not_depend_on_the_borders_of_parts(spark):
    odd = ["a<|end|>", "</s>", "\\", ""]
    rows = [(1, i, "user" if i < 600 else "assistant", odd[i % 4] + str(i)) for i in range(1200)]       # over part borders
    rows += [(2, i * 1000 - 5000, "assistant" if i % 4 else "user", str(i)) for i in range(20)]          # sparse and negative numbers
    rows += [(3, None, "assistant", f"{i:04}") for i in range(700)] + [(3, 0, "assistant", "first")]     # no numbers
    rows += [(4, 7, "r" + str(i % 2), f"{i:04}") for i in range(1000)]                                  # one number
    rows += [(5, -(1 << 62), "u", "x"), (5, (1 << 62), "u", "y"), (5, 255, "u", "z"), (5, 256, "v", "<|more|>")]
    parts = chat.format_chat(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = {}
    for r in parts.orderBy("conv_id", "part").select("*", chat.read_turns(F.col("formatted"), carried=F.col("carried")).alias("turns")).collect():
        text, turns = got.get(r["conv_id"], ("", []))
        got[r["conv_id"]] = (text + r["formatted"], turns + [tuple(x) for x in r["turns"]])
        assert len(r["turns"]) <= chat.PART_TURNS
    for c, turns in _expected(rows).items():
        assert got[c][1] == turns and got[c][0] == _plainly(turns)


def test_chat_of_nothing(spark):
    assert chat.conversation_digests(chat.format_chat(spark.createDataFrame([], SCHEMA))).count() == 0


def test_templates_that_could_mislead_are_refused():
    with pytest.raises(ValueError):
        chat.Template(turn="ab", says="bc")
    with pytest.raises(ValueError):
        chat.Template(end="\\x")


# --- decontamination ---------------------------------------------------------

def _words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = _words(text)
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((doc, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=str)


def test_decontamination_against_brute_force(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
    items = [(1, " ".join(base)), (2, " ".join(base[2:])), (2, " ".join(base[2:])), (3, "Short ITEM"), (4, "one"), (5, None), (6, " ... "),
             (None, "no id here"), (7, "the the the the the the the the the the the"), (8, "École Été 42x"), (9, "a b c")]
    docs = [(1, "x " + " ".join(base).upper() + "! y"), (2, " ".join(base[1:12])), (3, " ".join(base[:9])), (4, "short-item, short; item"),
            (5, None), (6, ""), (7, "the " * 25), (8, "école Été 42X École Été 42x"), (9, "no ID here one"), (1, "a b c a b c"), (1, "a b c a b c"),
            (None, "a b c"), (10, " ".join(base[:10]) + " filler " * 30000 + " ".join(base))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit(0)).withColumn("k1", F.lit(0))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(0))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontaminate.hits(d, b).collect()]
    assert sorted(got, key=str) == _brute(docs, items)
    kept = decontaminate.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted((r["doc_id"] for r in kept.collect())) == sorted(x[0] for x in _brute(docs, items) if not x[2])


def test_decontamination_of_and_against_nothing(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.hits(d, b.limit(0)).collect()] == [(2, 0, [])]
    assert decontaminate.hits(d.limit(0), b).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    d, b = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    columns = ["doc_id", "n_words", "n_hit", "items"]
    want = sorted(map(tuple, decontaminate.hits(d, b).select(columns).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontaminate.hits(d, b).select(columns).collect())) == want
    assert any(r[2] for r in want)


def test_queries_on_empty_tables(spark, tmp_path):
    folder = write_tables(spark, tmp_path, {}, like=SF)
    assert {n: q(spark, folder).count() for n, q in queries.QUERIES.items()} == {
        n: 1 if n.startswith("op1_") else 0 for n in queries.QUERIES}
