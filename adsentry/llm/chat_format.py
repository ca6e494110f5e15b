r"""Chat formatting with Spark expressions only.

The rows of a conversation are collected as structs and sorted, adjacent
turns of one role are merged into a block, and the text is concatenated:

    ### <role>: <text></turn>\n                 one block
    ### <role>: <text><+><text></turn>\n        a block of two merged turns

Inside texts and roles the control characters are escaped: ``\`` as ``\b``,
``#`` as ``\h``, ``<`` as ``\l``; in roles also ``:`` as ``\c``. A formatted
text therefore holds no ``#`` or ``<`` but the template's own, whatever the
texts say, and reading back is a plain split. Unescaping undoes ``\b`` last.

The loss mask is given as segments: their texts concatenated are the
formatted text, and ``loss`` marks those that hold an assistant's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of

HEAD, COLON, JOIN, END = "### ", ": ", "<+>", "</turn>\n"
LOSS_ROLES = ("assistant",)


def escape(text: Column, role: bool = False) -> Column:
    for raw, code in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), *((((":"), "\\c"),) if role else ())):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in ((":", "\\c"), ("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments``.

    Rows are ordered by turn (nulls first), ties by role and text. A null text
    or role counts as empty. Rows without ``conv_id`` form one conversation
    with a null id. A conversation is one output row, so one conversation must
    fit a row; nothing else is gathered. An empty table gives none.
    """
    rows = columns_of(turns, conv_id="conv_id", turn="turn", role="role", text="text").select(
        "conv_id",
        F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    t = F.col("t")
    # first turn of each run of one role, then the runs as blocks of merged turns
    starts = F.filter(
        F.sequence(F.lit(1), F.size(t)),
        lambda i: (i == 1) | (F.element_at(t, i)["role"] != F.element_at(t, F.greatest(i - 1, F.lit(1)))["role"]),
    )
    s = F.col("starts")
    blocks = F.transform(
        s,
        lambda a, n: F.struct(
            F.element_at(t, a)["role"].alias("role"),
            F.transform(
                F.slice(t, a, F.coalesce(F.get(s, n + 1), F.size(t) + 1) - a), lambda x: escape(x["text"])
            ).alias("texts"),
        ),
    )
    plain = lambda c: F.struct(c.alias("text"), F.lit(False).alias("loss"))
    pieces = F.flatten(
        F.transform(
            F.col("blocks"),
            lambda b: F.concat(
                F.array(plain(F.concat(F.lit(HEAD), escape(b["role"], role=True), F.lit(COLON)))),
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda x, n: F.concat(
                            F.when(n > 0, F.array(plain(F.lit(JOIN)))).otherwise(F.slice(F.array(plain(F.lit(""))), 1, 0)),
                            F.array(F.struct(x.alias("text"), b["role"].isin(*loss_roles).alias("loss"))),
                        ),
                    )
                ),
                F.array(plain(F.lit(END))),
            ),
        )
    )
    return (
        sorted_turns.withColumn("starts", starts)
        .withColumn("blocks", blocks)
        .select("conv_id", pieces.alias("segments"))
        .select("conv_id", F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"), "segments")
    )


def read_back(formatted: Column) -> Column:
    """``array<struct<role, text>>``: the turns a formatted text was made from."""
    blocks = F.filter(F.split(formatted, "</turn>\n"), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring(b, F.instr(b, COLON) + len(COLON), F.length(b)), r"<\+>"),
                lambda x: F.struct(
                    unescape(F.substring(b, F.lit(len(HEAD) + 1), F.instr(b, COLON) - len(HEAD) - 1)).alias("role"),
                    unescape(x).alias("text"),
                ),
            ),
        )
    )


def format_digest(formatted: DataFrame) -> DataFrame:
    """What the output holds, read back from it: counts and digests per conversation."""
    turns, loss = F.col("turns"), F.col("loss")
    said = F.filter("segments", lambda x: x["loss"])
    return (
        formatted.withColumn("turns", read_back(F.col("formatted")))
        .withColumn("loss", F.array_join(F.transform(said, lambda x: unescape(x["text"])), ""))
        .select(
            "conv_id",
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256
            ).alias("turns_sha256"),
            F.length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss, 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
