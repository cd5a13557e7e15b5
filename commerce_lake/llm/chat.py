"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of
one role are merged into a block by an array aggregation, and the blocks are
concatenated::

    ### assistant:
    first text</turn>
    second text of the same role</turn>
    ### user:
    ...

Inside texts and roles the characters of the control strings are written as
``\\b`` (backslash), ``\\l`` (<) and ``\\h`` (#), in roles also ``\\c`` (:), so
no control string can occur there, and ``read_back`` restores every turn.  The
loss mask is a list of (start, length) spans, in code points, over the
formatted text: the texts of the assistant's turns and nothing between them.

Defined cases: turns sort by turn (nulls first), then role, then text; a null
text or role is empty; an empty text still is a turn; rows of a null conv_id
form one conversation; repeated rows are turns of their own; an empty table has
no conversations; further columns are ignored.  A conversation is one row of
the result, so it is gathered in one place however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_END = "</turn>\n"
BLOCK, HEAD_END = "### ", ":\n"
LOSS_ROLE = "assistant"
#: Escapes by order of writing; they are undone in reverse order (fixed values).
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def escape(s: Column, role: bool = False) -> Column:
    for raw, code in (*ESCAPES, (":", "\\c")) if role else ESCAPES:
        s = F.replace(s, F.lit(raw), F.lit(code))
    return s


def unescape(s: Column, role: bool = False) -> Column:
    for raw, code in reversed((*ESCAPES, (":", "\\c")) if role else ESCAPES):
        s = F.replace(s, F.lit(code), F.lit(raw))
    return s


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, n) and n_blocks of every conversation."""
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sorted_turns = (rows.groupBy("conv_id")
                    .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text")),).alias("turns")))
    start = F.struct(
        F.lit(None).cast("string").alias("role"), F.lit(0).cast("int").alias("at"), F.lit(0).cast("int").alias("blocks"),
        F.array().cast("array<string>").alias("pieces"), F.array().cast("array<struct<start:int,n:int>>").alias("spans"))

    def merge(acc, t):
        head = F.when(acc["role"].eqNullSafe(t["role"]), "").otherwise(
            F.concat(F.lit(BLOCK), escape(t["role"], role=True), F.lit(HEAD_END)))
        body = escape(t["text"])
        piece = F.concat(head, body, F.lit(TURN_END))
        span = F.when(t["role"] == loss_role, F.array(F.struct(
            (acc["at"] + F.length(head)).cast("int").alias("start"), F.length(body).cast("int").alias("n")))).otherwise(
            F.array().cast("array<struct<start:int,n:int>>"))
        return F.struct(t["role"].alias("role"), (acc["at"] + F.length(piece)).cast("int").alias("at"),
                        (acc["blocks"] + F.when(head == "", 0).otherwise(1)).cast("int").alias("blocks"),
                        F.concat(acc["pieces"], F.array(piece)).alias("pieces"),
                        F.concat(acc["spans"], span).alias("spans"))

    merged = F.aggregate("turns", start, merge,
                         lambda acc: F.struct(F.array_join(acc["pieces"], "").alias("formatted"),
                                              acc["spans"].alias("loss_spans"), acc["blocks"].alias("n_blocks")))
    return sorted_turns.select("conv_id", merged.alias("m")).select("conv_id", "m.formatted", "m.loss_spans", "m.n_blocks")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), loss_text and formatted of every formatted conversation."""
    blocks = F.slice(F.split("formatted", BLOCK), F.lit(2), F.greatest(F.size(F.split("formatted", BLOCK)) - 1, F.lit(0)))

    def turns_of(block):
        role = unescape(F.substring_index(block, HEAD_END, 1), role=True)
        body = F.substr(block, F.length(F.substring_index(block, HEAD_END, 1)) + len(HEAD_END) + 1, F.length(block))
        texts = F.split(body, TURN_END)
        texts = F.slice(texts, F.lit(1), F.size(texts) - 1)  # nothing follows the last end
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    masked = F.transform("loss_spans", lambda s: F.substr(F.col("formatted"), s["start"] + 1, s["n"]))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns_of)).alias("turns"),
                            unescape(F.array_join(masked, "")).alias("loss_text"))
