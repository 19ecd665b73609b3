"""Message-envelope and JSON-document expressions (X17-X19, T3).

Decoding never raises: every step has a ``try_`` form, and a row that fails
keeps a ``reject_reason`` instead of failing the job. The same expressions
run in batch and in Structured Streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reasons written to the reject table.
NO_DATA = "no data"
BAD_BASE64 = "bad base64"
BAD_UTF8 = "bad utf8"
BAD_JSON = "bad json"


def envelope_payload(df: DataFrame) -> Column:
    """Base64 text from either envelope shape: ``data`` or ``message.data``."""
    return F.coalesce(F.col("data"), F.col("message.data"))


def decode_envelope(df: DataFrame) -> DataFrame:
    """Adds ``payload`` (decoded JSON text), ``entry`` (parsed VARIANT) and
    ``reject_reason`` (NULL when the envelope decoded to valid JSON)."""
    # Each step reads the step before through a lambda variable, and the last
    # one is exploded: so the optimiser cannot copy a step into every use of
    # it, and an envelope is decoded and parsed once.
    decoded = F.transform(F.array(envelope_payload(df)), lambda b: F.struct(
        b.alias("b64"), F.try_to_binary(b, F.lit("base64")).cast("string").alias("text")))
    checked = F.transform(decoded, lambda x: F.struct(
        x["b64"].alias("b64"), x["text"].alias("text"), F.is_valid_utf8(x["text"]).alias("utf8")))
    parsed = F.transform(checked, lambda x: F.struct(
        x["b64"].alias("b64"), x["utf8"].alias("utf8"), F.when(x["utf8"], x["text"]).alias("payload"),
        F.try_parse_json(F.when(x["utf8"], x["text"])).alias("entry")))
    done = F.col("__decoded")
    reason = (F.when(done["b64"].isNull(), F.lit(NO_DATA))
               .when(done["utf8"].isNull(), F.lit(BAD_BASE64))
               .when(~done["utf8"], F.lit(BAD_UTF8))
               .when(done["entry"].isNull(), F.lit(BAD_JSON)))
    return (df.select("*", F.explode(parsed).alias("__decoded"))
            .withColumns({"payload": done["payload"], "entry": done["entry"], "reject_reason": reason})
            .drop("__decoded"))


def split_valid(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Dead-letter split by one rule, for batch and stream alike."""
    good = df.where(F.col(reason).isNull()).drop(reason)
    bad = df.where(F.col(reason).isNotNull())
    return good, bad


def items_count(col: str = "items") -> Column:
    """``len(doc.get('items', []))``: a missing list counts 0. (``size`` of a
    NULL is -1 rather than NULL when ANSI mode is off, so test for NULL.)"""
    c = F.col(col)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c)).cast("bigint")


def pretty_json(col) -> Column:
    """Indented JSON text of a struct/variant column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_json(c, {"pretty": "true"})
