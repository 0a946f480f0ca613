"""Chat formatting with typed content parts, in DataFrame functions only.

A conversation is a set of rows (conversation, turn, role, parts). A part is a
struct (kind, text, ref, units): kind ``text`` carries text; ``image``,
``audio`` and ``document`` carry an attachment reference and a size in units
(tiles, seconds, pages). One visitor expression per kind renders a part: text is
escaped, an attachment becomes the placeholder ``<|kind|>`` -- placeholders stand
in the order of the attachments -- and is recorded with its reference and its
expanded token count (units times the kind's tokens per unit).

    <|turn|>role<|text|>rendered parts<|end|>

Every control string starts with ``<|``. In roles and texts a backslash is
doubled and ``<|`` becomes ``<\\|``, so a rendered text never holds ``<|``, and an
odd run of backslashes between ``<`` and ``|`` occurs only where it was put:
``unescape`` is exact. The loss mask is the list of code-point ranges of the
texts of the assistant's turns.

Defined results. Null role, text, ref: empty. Null units: 0. A part of an unknown
or null kind is rendered as text. Rows of a conversation are ordered by turn
(null first), ties by role and rendered text; repeated rows stay. Null
conversation ids form one conversation. No rows: no result. Other columns of
the input are ignored, whatever their names. One conversation is one output
text, so it is one row; running sums and the collected turns share one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """The parts column of plain text."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).cast("long").alias("units")
        )
    )


def format_chat(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    loss_role: str = "assistant",
    tokens_per_unit: Mapping[str, int] = TOKENS_PER_UNIT,
) -> DataFrame:
    """One row per conversation: ``conv``, formatted, n_turns, loss_spans
    (array of start, end in code points), attachments (array of place, kind,
    ref, tokens in order of the placeholders), attachment_tokens."""
    kinds = list(tokens_per_unit)

    def visit(p: Column) -> Column:
        return F.when(p["kind"].isin(kinds), F.concat(F.lit("<|"), p["kind"], F.lit("|>"))).otherwise(
            escape(F.coalesce(p["text"], F.lit("")))
        )

    def record(p: Column) -> Column:
        per = F.lit(0)
        for k, v in tokens_per_unit.items():
            per = F.when(p["kind"] == k, F.lit(v)).otherwise(per)
        return F.struct(
            p["kind"].alias("kind"), F.coalesce(p["ref"], F.lit("")).alias("ref"), (F.coalesce(p["units"], F.lit(0)) * per).cast("long").alias("tokens")
        )

    ps = F.coalesce(F.col(parts), F.array())
    rows = turns.select(
        F.col(conv).alias("_c"),
        F.col(turn).alias("_t"),
        F.coalesce(F.col(role), F.lit("")).alias("_r"),
        F.concat_ws("", F.transform(ps, visit)).alias("_b"),
        F.transform(F.filter(ps, lambda p: F.coalesce(p["kind"].isin(kinds), F.lit(False))), record).alias("_a"),
    )
    head = F.concat(F.lit(TURN), escape(F.col("_r")), F.lit(TEXT))
    rows = rows.withColumn("_h", head).withColumn("_s", F.concat("_h", "_b", F.lit(END)))
    order = Window.partitionBy("_c").orderBy("_t", "_r", "_b", "_a")
    rows = rows.withColumn("_n", F.row_number().over(order)).withColumn(
        "_at", F.sum(F.length("_s").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("_s") + F.length("_h")
    )
    kept = rows.groupBy("_c").agg(
        F.array_sort(F.collect_list(F.struct("_n", "_s", "_at", F.length("_b").alias("_l"), "_r", "_a"))).alias("_turns")
    )
    t = F.col("_turns")
    found = F.flatten(F.transform(t, lambda x: x["_a"]))
    return kept.select(
        F.col("_c").alias(conv),
        F.concat_ws("", F.transform(t, lambda x: x["_s"])).alias("formatted"),
        F.size(t).cast("long").alias("n_turns"),
        F.transform(
            F.filter(t, lambda x: x["_r"] == loss_role),
            lambda x: F.struct(x["_at"].alias("start"), (x["_at"] + x["_l"]).alias("end")),
        ).alias("loss_spans"),
        F.transform(found, lambda a, i: F.struct(i.alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate(found, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation
    (placeholders stay in the text as they are)."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescape(F.substring_index(F.substr(x, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
            unescape(F.substring_index(x, TEXT, -1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws(
        "", F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    )
