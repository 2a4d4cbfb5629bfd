r"""Chat formatting by prefix-target expansion (native).

Every assistant turn becomes one example: all turns before it are context and only its own text
is trainable. Turns after the last assistant turn (or all turns of a conversation without one)
form one more example with an empty trainable span, so the output holds every turn.

Template, for each turn:  <|start|>{role}\n{text}<|end|>\n
Inside roles and texts "\" is written as "\b", "<" as "\l" and "#" as "\h" (and a line feed
inside a role as "\n"), so no text can hold a marker. Undoing "\l", "\h", "\n" and last "\b" is exact:
a written text has no backslash but those that start such a pair.

Defined results: null text or role counts as empty; turns are ordered by (turn, role, text) with
null turns first, repeated rows stay; an empty table gives no rows; a null conv_id is a
conversation of its own; other columns are ignored. A conversation is one row from the first
grouping on, as its own examples need all of its turns together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import written

START, END = "<|start|>", "<|end|>\n"


def escape(c: Column) -> Column:
    for plain, code in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in (("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\n"), F.lit("\n")))


def prefix_target_examples(
    turns: DataFrame, trainable_role: str = "assistant", keep_tail: bool = True
) -> DataFrame:
    """One row per trainable turn: conv_id, example (from 0), text, loss_start and loss_chars (the
    trainable span of text in code points, escaped as written). keep_tail adds the last example
    of turns that follow the last trainable one, with loss_chars 0 and trainable false."""
    rows = turns.select(
        F.col("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    # Written-out turns are made before the grouping, so escaping is spread over all rows.
    rows = rows.select(
        "conv_id",
        F.struct(
            "t.turn",
            "t.role",
            "t.text",
            F.concat(F.lit(START), escape_role(F.col("t.role")), F.lit("\n")).alias("head"),
            escape(F.col("t.text")).alias("body"),
        ).alias("t"),
    )
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    conv = conv.withColumn(
        "ends", F.filter(F.sequence(F.lit(1), F.size("ts")), lambda i: F.col("ts")[i - 1]["role"] == trainable_role)
    )
    tail = F.when(
        F.coalesce(F.array_max("ends"), F.lit(0)) < F.size("ts"), F.array(F.size("ts"))
    ).otherwise(F.array().cast("array<int>"))
    conv = conv.withColumn("cuts", F.concat("ends", tail) if keep_tail else F.col("ends"))
    conv = conv.withColumn(
        "segments", F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    )
    each = conv.select("conv_id", "ts", "segments", F.posexplode("cuts").alias("example", "upto"))
    target = F.col("ts")[F.col("upto") - 1]
    each = each.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        (target["role"] == trainable_role).alias("trainable"),
        F.concat(
            F.array_join(F.slice("segments", F.lit(1), F.col("upto") - 1), ""), target["head"]
        ).alias("context"),
        target["body"].alias("body"),
    )
    return each.select(
        "conv_id",
        "example",
        "trainable",
        F.concat("context", "body", F.lit(END)).alias("text"),
        F.length("context").cast("long").alias("loss_start"),
        F.when(F.col("trainable"), F.length("body")).otherwise(0).cast("long").alias("loss_chars"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from formatted examples alone: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars (code points of all its examples). The last example holds all turns."""
    loss = F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_chars"))
    conv = examples.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("example", unescape(loss).alias("loss")))).alias("parts"),
        F.max_by("text", "example").alias("whole"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    pieces = F.slice(F.split("whole", r"<\|start\|>", -1), F.lit(2), F.greatest(F.lit(0), F.size(F.split("whole", r"<\|start\|>", -1)) - 1))

    def plain(p: Column) -> Column:
        cut = F.instr(p, F.lit("\n"))
        body = F.substring(p, cut + 1, F.length(p) - cut - len(END))
        return F.concat(unescape_role(F.substring(p, F.lit(1), cut - 1)), F.lit("\n"), unescape(body), F.lit("\n"))

    conv = conv.withColumn("turns", F.transform(pieces, plain)).withColumn(
        "all_loss", F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    )
    return conv.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("all_loss").cast("long").alias("loss_chars"),
        F.sha2("all_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def format_and_read_back(turns: DataFrame) -> DataFrame:
    """Write the examples of all conversations, then summarise what was written."""
    return read_back(written(prefix_target_examples(turns), "chat-examples"))
