"""Envelope decoding and the dead-letter split."""

import base64

from tessera.functions.envelope import decode_envelope, split_valid
from tessera.sources.landing import ENVELOPE_SCHEMA


def b64(b: bytes) -> str:
    return base64.b64encode(b).decode()


def test_envelope_cases(spark):
    rows = [
        (1, None, b64(b'{"a": 1}'), None),                 # data
        (2, None, None, (b64(b'{"b": 2}'),)),              # message.data
        (3, None, None, None),                             # neither
        (4, None, "###", None),                            # not base64
        (5, None, b64(b"\xff\xfe"), None),                 # not UTF-8
        (6, None, b64(b'{"k'), None),                      # not JSON
    ]
    df = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    out = {r["event_id"]: r for r in decode_envelope(df).collect()}
    assert out[1]["payload"] == '{"a": 1}' and out[1]["reject_reason"] is None
    assert out[2]["payload"] == '{"b": 2}' and out[2]["reject_reason"] is None
    assert [out[i]["reject_reason"] for i in (3, 4, 5, 6)] == [
        "no data", "bad base64", "bad utf8", "bad json"]
    good, bad = split_valid(decode_envelope(df))
    assert good.count() == 2 and bad.count() == 4


def test_items_count_missing_list_is_zero_in_both_ansi_modes(spark):
    from tessera.functions.envelope import items_count
    df = spark.createDataFrame([([1, 2],), (None,), ([],)], "items array<int>")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            assert [r[0] for r in df.select(items_count("items")).collect()] == [2, 0, 0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
