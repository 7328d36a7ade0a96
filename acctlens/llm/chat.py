"""Chat formatting with a grammar round trip, in SQL functions alone.

Template: a turn is ``### Tag: text</turn>`` and a line break. A header and the end mark are control
strings wherever they stand, and the parser knows no more than that, plus one rule for text: a
backslash stands for the character after it.

Round trip: every turn is rendered as it is and parsed again. If the parser recovers the one turn with
its role and text, the text stays; if not, it holds something in conflict with the grammar, and is
rendered with escapes: each backslash doubled, one put into each end mark and each ``##``.
Escaped text is parsed once more, and a turn that still differs raises an error instead of being written.
Turns that parse alone also parse in a row, since each ends with the only end mark it holds.

``read_chat`` recovers turns, roles and the text under the loss mask from formatted text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Roles with a title of their own; any other is written as "@" and the hex digits of its UTF-8 bytes.
TITLES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
END = "</turn>"
_HEADER = "### (System|User|Assistant|Tool|@[0-9A-F]*+): "
_ESCAPED = r"\\([\s\S])"


def _tag(role: Column) -> Column:
    tag = F.concat(F.lit("@"), F.hex(F.encode(role, "UTF-8")))
    for name, title in TITLES.items():
        tag = F.when(role == name, F.lit(title)).otherwise(tag)
    return tag


def _role(tag: Column) -> Column:
    role = F.decode(F.unhex(F.substring(tag, 2, 1 << 30)), "UTF-8")
    for name, title in TITLES.items():
        role = F.when(tag == title, F.lit(name)).otherwise(role)
    return role


def escape(text: Column) -> Column:
    """Backslashes doubled, ``</turn>`` as ``<\\/turn>``, ``##`` as ``#\\#``: no control string is left."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("</turn>"), F.lit("<\\/turn>")), F.lit("##"), F.lit("#\\#"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, raw). ``raw`` is still escaped. Null if it does not parse.

    The text between two end marks must be one header and a body without another header.
    """
    turns = F.split(formatted, f"{END}\n", -1)
    body = F.slice(turns, 1, F.size(turns) - 1)
    fits = (F.element_at(turns, -1) == "") & F.forall(
        body, lambda t: t.rlike(f"^{_HEADER}") & (F.regexp_count(t, F.lit(_HEADER)) == 1) & ~F.contains(t, F.lit(END))
    )
    # the grammar has made sure that the header is there
    parsed = F.transform(body, lambda t: F.struct(
        _role(F.regexp_extract(t, f"^{_HEADER}", 1)).alias("role"),
        F.regexp_replace(t, f"^{_HEADER}", "").alias("raw"),
    ))
    return F.when(fits, parsed)


def _render(role: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), _tag(role), F.lit(": "), body, F.lit(f"{END}\n"))


def _recovers(rendered: Column, role: Column, text: Column) -> Column:
    turns = parse(rendered)
    return F.coalesce((F.size(turns) == 1) & (turns[0]["role"] == role) & (unescape(turns[0]["raw"]) == text), F.lit(False))


def format_chat(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_mask) for ``turns(conv_id, turn, role, text)``.

    ``loss_mask`` holds the spans (start, end: code points) of the texts of ``loss_role``, in order. Turns
    go by ``turn``; equal ones by role and text, and repeated rows stay. A null role or text is empty; a
    null ``turn`` comes first; rows with a null ``conv_id`` are one conversation. An empty table gives no
    rows; other columns are ignored. A conversation is one value, so one row holds all of its turns.
    """
    clean = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    plain = clean.withColumn("body", text).withColumn("seg", _render(role, text))
    plain = plain.withColumn("same", _recovers(F.col("seg"), role, text))
    again = plain.withColumn("body", F.when(F.col("same"), text).otherwise(escape(text)))
    again = again.withColumn("seg", F.when(F.col("same"), F.col("seg")).otherwise(_render(role, F.col("body"))))
    sure = F.when(F.col("same") | _recovers(F.col("seg"), role, text), F.col("seg")).otherwise(
        F.raise_error(F.concat(F.lit("a turn does not survive formatting, conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    )
    parts = again.select("conv_id", F.struct(
        "turn", "role", "text", sure.alias("seg"), (role == loss_role).alias("loss"),
        F.length("seg").alias("n"), F.length("body").alias("n_body"),
    ).alias("t"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    formatted = F.array_join(F.transform("ts", lambda t: t["seg"]), "")
    # a body ends before the end mark and its line break
    tail = F.lit(len(END) + 1)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    walked = F.aggregate(
        "ts", start,
        lambda acc, t: F.struct(
            (acc["at"] + t["n"]).cast("bigint").alias("at"),
            F.when(t["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["n"] - tail - t["n_body"]).cast("bigint").alias("start"), (acc["at"] + t["n"] - tail).cast("bigint").alias("end"),
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return whole.select("conv_id", formatted.alias("formatted"), walked.alias("loss_mask"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) recovered from ``formatted(conv_id, formatted, loss_mask)``."""
    turns = F.transform(parse(F.col("formatted")), lambda t: F.struct(t["role"].alias("role"), unescape(t["raw"]).alias("text")))
    masked = F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"), F.length("formatted").cast("bigint").alias("formatted_chars"))
