"""Relational chat formatting in Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one
role become one block, their texts its parts; blocks are concatenated:

    <|turn|>role NEWLINE part [<|part|> part]... <|end|> NEWLINE

Texts and roles can hold any string.  In them ``<`` and ``[`` get a ``~`` behind, so
no control string of this template, nor one like ``</s>`` or ``[INST]``, survives in
a text; removing one ``~`` behind each restores it.  The loss mask lists the
(start, end) code points of each assistant text.  ``read_back`` gets turns and
masked text from the formatted string and the mask alone.

Positions are a running sum over a conversation's turns, and reading goes through the
string once, so the work is linear in the turns.  The formatted conversation is one
row, so a conversation has to fit one; no other state is kept per conversation.

Defined cases: a null text is empty, a null role is the role without a name; equal
turn numbers are ordered by role, then text, null numbers come first; rows of a null
conv_id are one conversation; repeated rows are turns each; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values of the template.
TURN, PART, END = "<|turn|>", "<|part|>", "<|end|>\n"
_NEWLINE_IN_ROLE = "<n>"
#: Code points of a block that masked texts are read from.
BLOCK = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])", "$1~")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])~", "$1")


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask."""
    src = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                      F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    opens = F.coalesce(F.lag("role").over(order) != F.col("role"), F.lit(True))
    closes = F.coalesce(F.lead("role").over(order) != F.col("role"), F.lit(True))
    name = F.replace(escape(F.col("role")), F.lit("\n"), F.lit(_NEWLINE_IN_ROLE))
    sized = (src.withColumn("opens", opens).withColumn("closes", closes)
             .withColumn("added", F.when(F.col("opens"), F.length(F.lit(TURN)) + F.length(name) + 1)
                         .otherwise(len(PART)).cast("long"))
             .withColumn("size", F.length(escape(F.col("text"))).cast("long"))
             .withColumn("end", F.sum(F.col("added") + F.col("size") + F.when(F.col("closes"), len(END)).otherwise(0))
                         .over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) -
                         F.when(F.col("closes"), len(END)).otherwise(0)))
    # the same partitioning serves the window and the collection; ends grow, so they give the order of the turns
    turns = sized.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "end", "size", "opens", "closes", "role", "text"))).alias("turns"))

    def piece(t: Column) -> Column:
        """A turn's text with what stands before and behind it."""
        role_name = F.replace(escape(t["role"]), F.lit("\n"), F.lit(_NEWLINE_IN_ROLE))
        return F.concat(F.when(t["opens"], F.concat(F.lit(TURN), role_name, F.lit("\n"))).otherwise(F.lit(PART)),
                        escape(t["text"]), F.when(t["closes"], F.lit(END)).otherwise(F.lit("")))

    spoken = F.filter("turns", lambda t: t["role"] == loss_role)
    return turns.select("conv_id", F.array_join(F.transform("turns", piece), "").alias("formatted"), F.transform(
        spoken, lambda t: F.struct((t["end"] - t["size"]).alias("start"), t["end"].alias("end"))).alias("loss_mask"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def cut_out(text: Column, spans: Column) -> Column:
    """The (start, end) spans of a text.

    A position in a text is found by counting from its front; so the text is cut into blocks of
    code points once, and a span counts in its first block only.
    """
    blocks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))

    def one(b: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / BLOCK), F.floor((s["end"] + BLOCK - 1) / BLOCK)
        own = F.array_join(F.slice(b, (first + 1).cast("int"), (last - first).cast("int")), "")
        return F.substring(own, (s["start"] - first * BLOCK + 1).cast("int"), (s["end"] - s["start"]).cast("int"))

    return let(blocks, lambda b: F.transform(
        spans, lambda s: F.when(s["end"] > s["start"], one(b, s)).otherwise(F.lit(""))))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and the masked texts, from ``formatted`` and ``loss_mask`` only."""
    blocks = F.filter(F.split("formatted", r"<\|turn\|>"), lambda b, i: i > 0)

    def parts(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.length(head) + 2, F.length(block) - F.length(head) - 1 - len(END))
        name = unescape(F.replace(head, F.lit(_NEWLINE_IN_ROLE), F.lit("\n")))
        return F.transform(F.split(body, r"<\|part\|>"),
                           lambda p: F.struct(name.alias("role"), unescape(p).alias("text")))

    return chats.select(
        "conv_id", "formatted", F.flatten(F.transform(blocks, parts)).alias("turns"),
        F.transform(cut_out(F.col("formatted"), F.col("loss_mask")), unescape).alias("loss_texts"))


def report(back: DataFrame) -> DataFrame:
    """Per conversation: counts and digests of what was read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
