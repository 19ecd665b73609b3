"""Goldens for the cleansing expressions (safe casts, dates, blanks, status)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions.cleansing import (blank_to_null, classify, parse_date_multi,
                                         ratio_pct, round_half_up, safe_int,
                                         safe_numeric, standardise_status)
from tessera.functions.text import word_count


def _col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {typ}")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_parse_date_multi(spark):
    vals = ["2023-01-15", "01/15/2023", "15-Jan-2023", "1/5/2023", "2023-02-30", "bad", None, "15-JAN-2023"]
    got = _col(spark, vals, parse_date_multi)
    d = dt.date
    assert got == [d(2023, 1, 15), d(2023, 1, 15), d(2023, 1, 15), d(2023, 1, 5), None, None, None,
                   d(2023, 1, 15)]


def test_parse_date_two_formats_drops_third(spark):
    got = _col(spark, ["15-Jan-2023", "2023-01-15"], lambda c: parse_date_multi(c, ("y-M-d", "M/d/y")))
    assert got == [None, dt.date(2023, 1, 15)]


def test_safe_numeric(spark):
    got = _col(spark, ["12.3456789015", "n/a", "", "$5", "1,000", "NaN", " 1.5 ", "1e3"], safe_numeric)
    assert got[0] == Decimal("12.345678902")
    assert got[1:6] == [None] * 5
    assert got[6] == Decimal("1.5") and got[7] == Decimal("1000")


def test_safe_int(spark):
    got = _col(spark, [" 12 ", "12.0", "1e2", "abc", "", "0x1F", "-3"], safe_int)
    assert got == [12, None, None, None, None, None, -3]


def test_status(spark):
    got = _col(spark, ["Completed", "Pending", "Cancelled", "Done", "done", None, "x"], standardise_status)
    assert got == ["Completed", "Pending", "Cancelled", "Completed", "Unknown", "Unknown", "Unknown"]


def test_blank_to_null_unicode(spark):
    got = _col(spark, ["   ", "\t a@b.c \t", " x ", "", None], blank_to_null)
    assert got == [None, "a@b.c", "x", None, None]


def test_word_count(spark):
    got = _col(spark, ["  a  b ", "", "a b", "one", None], word_count)
    assert got == [2, 0, 2, 1, None]


def test_ratio_pct(spark):
    df = spark.createDataFrame([(0, 0), (100, 25), (3, 1)], "t bigint, p bigint")
    got = [r[0] for r in df.select(ratio_pct("p", "t")).collect()]
    assert got[0] == 0.0 and got[1] == 75.0 and abs(got[2] - 67.0) < 1e-9


def test_round_half_up(spark):
    got = _col(spark, [1.005, 2.675, -1.005, 0.125], lambda c: round_half_up(c, 2), "double")
    # x * 100 is evaluated in DOUBLE (1.005 * 100 < 100.5, 2.675 * 100 == 267.5);
    # ties go away from zero.
    assert got == [1.0, 2.68, -1.0, 0.13]


def test_classify_first_match_and_null(spark):
    rules = (("analysis", "Q"), ("storage", "S"))
    got = _col(spark, ["Analysis storage", "Long Storage", "other", None],
               lambda c: classify(c, rules, "Other: "))
    assert got == ["Q", "S", "Other: other", None]


def test_lookback_bounds_and_default_now(spark):
    import datetime as dt
    from tessera.functions.timefn import lookback
    df = spark.createDataFrame([(dt.datetime(2024, 1, 23, 23, 57, 12),), (dt.datetime(2024, 1, 23, 23, 57, 11),),
                                (dt.datetime(2024, 1, 30, 23, 57, 12),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(lookback("ts", "2024-01-30 23:57:12", "7 DAYS")).collect()]
    assert got == [True, False, True]                  # both ends inclusive
    assert df.where(lookback("ts", None, "36500 DAYS")).count() == 3


def test_word_count_matches_python_split(spark):
    seps = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", " ", "\x85", "\xa0",
            " ", " ", " ", " ", " ", " ", " ", "　"]
    texts = [f"a{s}b{s}{s}c" for s in seps] + ["​zero-width​", "x\x00y", ""]
    got = _col(spark, texts, word_count)
    assert got == [len(t.split()) for t in texts]


def test_oracle_word_pattern_matches_python_split(duck):
    from tessera.plans.text import _WORDS
    seps = ["\t", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", "　", " "]
    for s in seps:
        t = f"a{s}b{s}{s}c"
        got = duck.execute(f"SELECT {_WORDS} FROM (SELECT ? AS line)", [t]).fetchone()[0]
        assert got == len(t.split()), repr(s)


def test_trim_set_matches_unicode_whitespace(spark, duck):
    from tessera.sources.staging import sql_blank_to_null
    ws = "\t\n\x0b\x0c\r \x85\xa0       　"
    texts = [f"{ws}x y{ws}", ws, "\x1cx\x1c"]
    # Unicode White_Space (the SQL TRIM set); unlike str.strip() it keeps U+001C.
    want = [t.strip(ws) or None for t in texts]
    assert _col(spark, texts, blank_to_null) == want
    got = [duck.execute(f"SELECT {sql_blank_to_null('s')} FROM (SELECT ? AS s)", [t]).fetchone()[0]
           for t in texts]
    assert got == want
