"""Chat formatting from event logs, with DataFrame functions only.

A log has one row per event: conversation, sequence, kind, message, role, text. The
kinds are ``start`` (opens a message), ``delta`` (appends a streamed piece), ``edit``
(puts a text in place of what the message has so far) and ``regenerate`` (clears the
message, and every message after it that stood there by then).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bind

LOG = ("conv_id", "seq", "kind", "message", "role", "text")
# Order of the kinds within one sequence number; those below DELTA start a text anew.
KINDS = ("regenerate", "start", "edit", "delta")
DELTA = KINDS.index("delta")
OPEN, CLOSE = "<s>", "</s>"
# A control string starts with one of these, so an escaped text holds none. The escape
# character comes first in escaping and last in reading back.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("\n", "\\n"))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def replay(log: DataFrame) -> DataFrame:
    """The final messages of each conversation: conv_id, message, role, text.

    Events of a message are folded in the order of ``seq``; with equal ``seq`` in that
    of KINDS, then of text. An event delivered several times counts once. The last
    role given holds. Null texts are empty, a null conversation or message is one of
    its own, a null ``seq`` comes first, events of an unknown kind are ignored, and so
    is any further column. Rows meet by message, not by conversation.
    """
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1
    events = log.select(*LOG).withColumn("rank", rank).filter(F.col("rank") >= 0)
    by_message = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_set(F.struct("seq", "rank", F.coalesce("text", F.lit("")).alias("text"), "role"))).alias("events"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("cleared"))
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    cut = by_message.withColumn("cut", F.max("cleared").over(earlier))
    alive = cut.withColumn("events", F.filter("events", lambda e: F.col("cut").isNull() | (e["seq"] > F.col("cut"))))
    roles = F.filter("events", lambda e: e["role"].isNotNull())

    def text(events):
        anew = F.array_max(F.transform(events, lambda e, i: F.when(e["rank"] < DELTA, i).otherwise(0)))
        return bind(anew, lambda at: F.array_join(
            F.transform(F.slice(events, at + 1, F.size(events)), lambda e: e["text"]), ""))

    return alive.filter(F.size("events") > 0).select(
        "conv_id", "message", F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
        text(F.col("events")).alias("text"))


def render(messages: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, turns: one row per conversation.

    A turn is ``<s>``, the role, a new line, the text and ``</s>``, role and text
    escaped. ``turns`` has for each turn where it begins (code points from 0), where its
    text begins, how many of its code points are under the loss mask (the text of a
    trained role, else 0), in order. A conversation's text ends up in one row, as that
    is what is asked for.
    """
    turn = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(CLOSE))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    body = F.length(escape(F.col("text")))
    placed = messages.select("conv_id", "message", turn.alias("turn"), F.col("role").isin(*trained).alias("counts"),
                             F.length(turn).cast("long").alias("chars"), body.cast("long").alias("body"))
    placed = placed.withColumn("begin", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    begin_text = F.col("begin") + F.col("chars") - F.col("body") - len(CLOSE)
    ordered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "message", "begin", begin_text.alias("text_begin"),
        F.when(F.col("counts"), F.col("body")).otherwise(0).alias("loss"), "turn"))).alias("t"))
    return ordered.select(
        "conv_id", F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"),
        F.transform("t", lambda x: F.struct(x["begin"].alias("begin"), x["text_begin"].alias("text_begin"),
                                            x["loss"].alias("loss"))).alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss (the unescaped text under the mask, by turn), formatted_chars."""
    pieces = F.split("formatted", CLOSE, -1)
    cut = formatted.withColumn("pieces", F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))))
    role = lambda p: F.substr(F.substring_index(p, "\n", 1), F.lit(len(OPEN) + 1))
    text = lambda p: F.substr(p, F.instr(p, "\n") + 1)
    return cut.select(
        "conv_id", F.transform("pieces", lambda p: F.struct(
            unescape(role(p)).alias("role"), unescape(text(p)).alias("text"))).alias("turns"),
        F.zip_with("pieces", "turns", lambda p, t: unescape(F.substr(
            p, (t["text_begin"] - t["begin"] + 1).cast("int"), t["loss"].cast("int")))).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"))
