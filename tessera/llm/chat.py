r"""Chat formatting with built-in functions only.

The turns of a conversation are collected as structs, sorted, folded into
blocks (adjacent turns of one role form one block) and concatenated:

    <|turn|>ROLE<|says|>TEXT<|more|>TEXT ...<|end|>

Control strings inside roles and texts are escaped: every backslash is doubled,
and a backslash is put after the first character of each control string, so no
control string remains. ``unescape`` undoes both in one pass from the left.

A conversation is written in parts, whose ``formatted`` texts in order are the
formatted conversation, as if it had been written at once: a block that goes on
in the next part is not ended, and the next part goes on with ``<|more|>``
(``carried`` is the role that it goes on with). Parts are cut at turn numbers (0 to 255, 256 to 511, ...) and, where
many rows share such numbers or have none, at every ``PART_TURNS`` rows. So no array grows with
a conversation's length, and a long conversation is collected, escaped and folded by several tasks;
only the finished blocks meet, one bounded row for each part, to learn the roles at their borders. Loss spans (start and length
in code points, within the part) cover each trained role's text, escaped, and
no marker.

Defined results: a null text or role is empty; rows without a turn number come
first; ties in turn are ordered by role, then text;
repeated rows are turns like others; null conv_ids are one conversation; an
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

PART_TURNS = 256


@dataclass(frozen=True)
class Template:
    """Markers, and further strings that are escaped though the template does not use them."""

    turn: str = "<|turn|>"
    says: str = "<|says|>"
    more: str = "<|more|>"
    end: str = "<|end|>"
    guarded: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        controls = self.controls()
        if any("\\" in c or len(c) < 2 for c in controls):
            raise ValueError("control strings need two characters and no backslash")
        if any(a[k:] == b[:len(a) - k] for a in controls for b in controls for k in range(1, len(a))):
            raise ValueError("no control string may end as another one begins")

    def controls(self) -> tuple[str, ...]:
        return (self.turn, self.says, self.more, self.end, *self.guarded)


def _quoted(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", s)


def escape(text: Column, template: Template = Template()) -> Column:
    """Reversible: doubles backslashes, then breaks each control string after its first character."""
    heads: dict[str, list[str]] = {}
    for c in template.controls():
        heads.setdefault(c[0], []).append(_quoted(c[1:]))
    pattern = "|".join(f"(?<={_quoted(h)})(?={'|'.join(rest)})" for h, rest in heads.items())
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), pattern, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def format_chat(turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per part: ``conv_id``, ``part`` (from 0), ``carried``, ``formatted``, ``loss_spans``."""
    t = template
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Turn numbers are cut to ranges, and ranges with many rows (ties, no numbers) by row.
    placed = rows.withColumn("range", F.shiftright("turn", PART_TURNS.bit_length() - 1)).withColumn("place", F.row_number().over(
        Window.partitionBy("conv", "range").orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    parts = (placed.select("conv", "range", F.expr(f"(place - 1) div {PART_TURNS}").alias("piece"), F.struct("turn", "role", "text").alias("x"))
             .groupBy("conv", "range", "piece").agg(F.sort_array(F.collect_list("x")).alias("turns")))
    block = F.struct(F.lit("").alias("role"), F.array().cast("array<string>").alias("texts"))

    def add(blocks: Column, x: Column) -> Column:
        last = F.get(blocks, F.size(blocks) - 1)
        text = F.array(escape(x["text"], t))
        same = F.coalesce(last["role"] == x["role"], F.lit(False))
        grown = F.struct(last["role"].alias("role"), F.concat(last["texts"], text).alias("texts"))
        fresh = F.struct(x["role"].alias("role"), text.alias("texts"))
        return F.when(same, F.concat(F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0))), F.array(grown))) \
            .otherwise(F.concat(blocks, F.array(fresh)))

    folded = parts.select("conv", "range", "piece", F.aggregate("turns", F.filter(F.array(block), lambda _: F.lit(False)), add).alias("blocks"))
    # The roles at the borders: one row for each part meets its neighbours.
    order = Window.partitionBy("conv").orderBy(F.col("range").asc_nulls_first(), "piece")
    first, last = F.col("blocks")[0]["role"], F.element_at("blocks", -1)["role"]
    met = folded.select("conv", (F.row_number().over(order) - 1).cast("long").alias("part"), "blocks",
                        F.when(F.lag(last).over(order) == first, first).alias("carried"),
                        F.coalesce(F.lead(first).over(order) == last, F.lit(False)).alias("goes_on"))
    numbered = F.transform("blocks", lambda b, k: F.struct(
        b["role"].alias("role"), b["texts"].alias("texts"),
        # A block that was begun in the part before goes on; one that goes on in the next part is not ended.
        F.when((k == 0) & F.col("carried").isNotNull(), F.lit(t.more))
        .otherwise(F.concat(F.lit(t.turn), escape(b["role"], t), F.lit(t.says))).alias("head"),
        F.when((k == F.size("blocks") - 1) & F.col("goes_on"), F.lit("")).otherwise(F.lit(t.end)).alias("tail")))
    whole = lambda b: F.concat(b["head"], F.array_join(b["texts"], t.more), b["tail"])
    span = "struct<start:long,length:long>"
    none = F.array().cast(f"array<{span}>")

    def locate(acc: Column, b: Column) -> Column:
        inner = F.aggregate(
            b["texts"], F.struct((acc["at"] + F.length(b["head"])).cast("long").alias("at"), none.alias("spans")),
            lambda a, x: F.struct((a["at"] + F.length(x) + len(t.more)).cast("long").alias("at"),
                                  F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), F.length(x).cast("long").alias("length")))).alias("spans")))
        return F.struct((acc["at"] + F.length(whole(b))).cast("long").alias("at"),
                        F.when(b["role"].isin(*t.trained), F.concat(acc["spans"], inner["spans"])).otherwise(acc["spans"]).alias("spans"))

    written = met.select("conv", "part", "carried", numbered.alias("blocks"))
    return written.select(
        F.col("conv").alias(conv_col), "part", "carried", F.array_join(F.transform("blocks", whole), "").alias("formatted"),
        F.aggregate("blocks", F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), locate)["spans"].alias("loss_spans"))


def read_turns(formatted: Column, template: Template = Template(), carried: Column | None = None) -> Column:
    """The turns (role, text) that a formatted part holds; ``carried`` is the role that it goes on with, if any."""
    t = template
    if carried is not None:  # begin the block again that was begun in the part before
        start = F.concat(F.lit(t.turn), escape(carried, t), F.lit(t.says), F.substr(formatted, F.lit(len(t.more) + 1)))
        formatted = F.when(carried.isNull(), formatted).otherwise(start)
    blocks = F.filter(F.split(formatted, _quoted(t.turn)), lambda b: b != "")
    role = lambda b: unescape(F.substring_index(b, t.says, 1))
    body = lambda b: F.regexp_extract(b, f"(?s)^.*?{_quoted(t.says)}(.*?)(?:{_quoted(t.end)})?$", 1)
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(body(b), _quoted(t.more)), lambda x: F.struct(role(b).alias("role"), unescape(x).alias("text")))))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped and concatenated."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def conversation_digests(parts: DataFrame, template: Template = Template(), conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its formatted parts: counts and digests of turns and trained text."""
    read = parts.select(
        F.col(conv_col).alias("conv"), "part", F.length("formatted").alias("chars"),
        read_turns(F.col("formatted"), template, F.col("carried")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    flat = read.select("conv", F.struct(
        "part", F.size("turns").alias("n"), "chars", "loss",
        F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("turns")).alias("x"))
    # A digest needs the whole conversation's text, in order, in one row.
    whole = flat.groupBy("conv").agg(F.sort_array(F.collect_list("x")).alias("x"))
    total = lambda name: F.expr(f"aggregate(x.{name}, 0L, (a, v) -> a + v)")
    loss = F.array_join("x.loss", "")
    return whole.select(
        F.col("conv").alias(conv_col), total("n").alias("n_turns"), F.sha2(F.array_join("x.turns", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))
