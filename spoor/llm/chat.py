"""Chat formatting: each assistant turn is an example of its own.

A conversation is written with one template; the example of an assistant turn is the
text up to and with that turn, and only its reply is trainable, given as a range of
code points.  A conversation whose last turn is no reply gives a closing example without
a target, so that no turn is lost (``closing=False`` leaves these out).

Control strings inside texts and roles get a backslash behind their ``<`` and so cannot
end a turn; ``unescaped`` takes it away again.  A conversation is one record of the
output (its last example is all of it), so its turns are gathered in one row.

Cases: null texts and roles are empty; turns of equal number go by role, then text, and
repeated rows are turns each; rows of null conversation are one conversation; an empty
table gives no example; further columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>\n"

_ESCAPE, _UNESCAPE = r"<(\\*)\|", r"<(\\*)\\\|"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, r"<$1|")


def _role(role: Column) -> Column:
    """A role on one line: the line feed is what ends it."""
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_back(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text",
             closing: bool = True) -> DataFrame:
    """conv_id, example (from 0 within the conversation), turns (in it), formatted,
    loss_start, loss_end (null in a closing example)."""
    own = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    head = F.concat(F.lit(START), escaped(_role(F.col("role"))), F.lit("\n"))
    body = escaped(F.col("text"))
    cells = own.select("conv_id", F.struct(
        "turn", "role", "text", F.concat(head, body, F.lit(END)).alias("piece"),
        F.length(head).alias("head"), F.length(body).alias("body")).alias("cell"))
    gathered = cells.groupBy("conv_id").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    step = lambda acc, c: F.struct(
        (acc["at"] + F.length(c["piece"])).alias("at"),
        F.concat(acc["ends"], F.array(F.struct(
            (acc["at"] + c["head"]).alias("start"),
            (acc["at"] + c["head"] + c["body"]).alias("end"),
            (acc["at"] + F.length(c["piece"])).alias("upto"),
            (c["role"] == "assistant").alias("reply")))).alias("ends"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start: int, end: int, upto: int, reply: boolean>>").alias("ends"))
    whole = gathered.select(
        "conv_id", F.concat_ws("", F.transform("cells", lambda c: c["piece"])).alias("whole"),
        F.aggregate("cells", start, step, lambda acc: acc["ends"]).alias("ends"))
    numbered = F.transform("ends", lambda e, i: F.struct(
        (i + 1).alias("turns"), e["upto"].alias("upto"), e["reply"].alias("reply"),
        F.when(e["reply"], e["start"]).alias("loss_start"),
        F.when(e["reply"], e["end"]).alias("loss_end")))
    wanted = F.filter(numbered, lambda e: e["reply"] | (
        (e["turns"] == F.size("ends")) if closing else F.lit(False)))
    return whole.select("conv_id", "whole", F.posexplode(wanted).alias("example", "e")).select(
        "conv_id", F.col("example").cast("long"), F.col("e.turns").cast("long").alias("turns"),
        F.expr("substring(whole, 1, e.upto)").alias("formatted"),
        F.col("e.loss_start"), F.col("e.loss_end"))


def read_back(found: DataFrame) -> DataFrame:
    """What the examples of each conversation say: conv_id, turns (role and text, from its
    longest example), reply (all text under the loss masks), formatted_chars (all
    examples)."""
    reply = unescaped(F.expr("substring(formatted, loss_start + 1, loss_end - loss_start)"))
    by_conv = found.select("conv_id", "example", "formatted", reply.alias("reply")).groupBy(
        "conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", "reply"))).alias("replies"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"))
    pieces = F.split("whole", r"<\|im_end\|>\n", -1)
    inner = F.transform(F.slice(pieces, 1, F.size(pieces) - 1),
                        lambda p: F.substr(p, F.lit(len(START) + 1)))
    turn = lambda p: F.struct(
        _role_back(unescaped(F.substring_index(p, "\n", 1))).alias("role"),
        unescaped(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text"))
    return by_conv.select(
        "conv_id", F.transform(inner, turn).alias("turns"),
        F.concat_ws("", F.transform("replies", lambda r: r["reply"])).alias("reply"),
        "formatted_chars")
